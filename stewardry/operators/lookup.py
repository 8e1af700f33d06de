"""Name, owner and path lookups as joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW = "_row"


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def first_match(
    dimension: DataFrame, keys: list[Column], values: dict[str, str], order: str = ROW
) -> DataFrame:
    """One row per key: ``values`` of the key's first row in ``order``.

    An aggregation, so the rows of a hot key shrink to one per map task before
    the exchange. Rows with a null key are left out, since they match nothing.
    Inside, fields have fixed names, so that lookups of the same values under
    different names share one exchange.
    """
    known = dimension.where(all_of([k.isNotNull() for k in keys]))
    if set(values) == {order}:  # A number's least is kept in a hash map, a struct's is sorted for.
        least = known.groupBy(*keys).agg(F.min(order).alias("_first"))
        names = [c for c in least.columns if c != "_first"]
        return least.select(*names, *[F.col("_first").alias(out) for out in values.values()])
    fields = {f"v{i}": (column, name) for i, (column, name) in enumerate(values.items())}
    first = F.min_by(F.struct(*[F.col(c).alias(v) for v, (c, _) in fields.items()]), F.col(order))
    firsts = known.groupBy(*keys).agg(first.alias("_first"))
    names = [c for c in firsts.columns if c != "_first"]
    return firsts.select(*names, *[F.col(f"_first.{v}").alias(out) for v, (_, out) in fields.items()])


def left_lookup(rows: DataFrame, side: DataFrame, on: dict[str, str]) -> DataFrame:
    """Left join text keys to a side that has one row per key.

    Rows with a null key match nothing, yet a plain join sends all that agree
    on their other keys to one partition. They get a first key made of their
    row number instead, which spreads them; the null tests keep that key from
    ever matching.
    """
    conditions = [F.col(mine) == F.col(key) for mine, key in on.items()]
    if ROW in rows.columns:
        complete = all_of([F.col(mine).isNotNull() for mine in on])
        mine, key = next(iter(on.items()))
        own = F.concat(F.lit("\u0000"), F.col(ROW).cast("string"))
        conditions[0] = F.when(complete, F.col(mine)).otherwise(own) == F.col(key)
        conditions.append(complete)
    return rows.join(side, all_of(conditions), "left")


def resolve(
    rows: DataFrame,
    dimension: DataFrame,
    on: dict[str, str],
    take: dict[str, str],
    order: str = ROW,
) -> DataFrame:
    """Add columns of the first dimension row whose keys equal the row's.

    ``on`` maps row columns to dimension columns, ``take`` maps dimension
    columns to their new names. No row is lost or repeated. Nothing is
    broadcast by hint; adaptive execution does so when the size it reads off
    the exchange is small, and otherwise splits hot keys of ``rows``, which is
    safe as the other side has one row per key.
    """
    keys = [f"_key{i}" for i in range(len(on))]
    first = first_match(
        dimension, [F.col(c).alias(k) for c, k in zip(on.values(), keys)], take, order
    )
    return left_lookup(rows, first, dict(zip(on, keys))).drop(*keys)


def resolve_cells(cells: DataFrame, cell: str, users: DataFrame) -> DataFrame:
    """Owner ids of every distinct comma list: ``cell, ids, unknown``.

    ``ids`` keeps the order and the repeats of the list; ``unknown`` holds the
    addresses no user has. Working on distinct cells instead of rows means that
    a team named on a third of all rows is looked up once.
    """
    distinct = cells.where(F.col(cell).isNotNull()).select(cell).distinct()
    parts = distinct.select(cell, F.posexplode(F.split(cell, ",", -1)).alias("_pos", "_mail"))
    found = resolve(parts, users, {"_mail": "mail"}, {"id": "_user"}, order=users_order(users))
    by_place = F.sort_array(F.collect_list(F.struct("_pos", "_mail", "_user")))
    return (
        found.groupBy(cell)
        .agg(by_place.alias("_parts"))
        .select(
            cell,
            F.transform(F.filter("_parts", lambda p: p["_user"].isNotNull()), lambda p: p["_user"]).alias("ids"),
            F.transform(F.filter("_parts", lambda p: p["_user"].isNull()), lambda p: p["_mail"]).alias("unknown"),
        )
    )


def users_order(users: DataFrame) -> str:
    """A directory without a list order is taken in id order."""
    return ROW if ROW in users.columns else "id"


def resolve_owners(
    rows: DataFrame,
    users: DataFrame,
    roles: dict[str, str],
    unknown: str | None = None,
    cells: DataFrame | None = None,
) -> DataFrame:
    """Add a list of owner ids for each comma-list column of ``roles``.

    ``roles`` maps list columns to new columns. With ``unknown``, the addresses
    of the first role that no user has are added under that name. The lists of
    all roles are looked up together; ``cells`` names where to read them when
    that is cheaper than ``rows``, such as the file the rows come from.
    """
    source = rows if cells is None else cells
    each = F.explode(F.array(*roles)) if len(roles) > 1 else F.col(next(iter(roles)))
    lists = source.select(each.alias("_cell"))
    known = resolve_cells(lists, "_cell", users)
    none = F.array().cast("array<string>")
    out = rows
    for place, (column, name) in enumerate(roles.items()):
        mine = known.select(
            F.col("_cell").alias("_owner_cell"),
            F.col("ids").alias("_found_ids"),
            F.col("unknown").alias("_not_found"),
        )
        out = left_lookup(out, mine, {column: "_owner_cell"})
        out = out.withColumn(name, F.coalesce("_found_ids", none))
        if unknown and place == 0:
            out = out.withColumn(unknown, F.coalesce("_not_found", none))
        out = out.drop("_owner_cell", "_found_ids", "_not_found")
    return out


def not_in(rows: DataFrame, catalog: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows whose key the catalog does not hold; null keys are never held."""
    return _against(rows, catalog, on, "left_anti")


def already_in(rows: DataFrame, catalog: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows whose key the catalog holds."""
    return _against(rows, catalog, on, "left_semi")


def _against(rows: DataFrame, catalog: DataFrame, on: dict[str, str], how: str) -> DataFrame:
    keys = [f"_key{i}" for i in range(len(on))]
    held = catalog.select(*[F.col(c).alias(k) for c, k in zip(on.values(), keys)]).distinct()
    condition = all_of([F.col(mine) == F.col(key) for mine, key in zip(on, keys)])
    return rows.join(held, condition, how)


