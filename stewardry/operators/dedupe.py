"""Keeping the first of several rows, and telling repeats within one load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stewardry.operators.lookup import ROW, all_of


def keep_first(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``; null keys form a key of their own.

    The rank filter lets Spark prune each map task to one row per key ahead of
    the exchange (window group limit), so a hot key stays small.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def mark_repeats(
    rows: DataFrame, keys: list[str], name: str, eligible: Column | None = None, order: str = ROW
) -> DataFrame:
    """Add a flag: an earlier eligible row of this load has the same key.

    Only rows that would be created count as earlier. The first row per key
    comes from an aggregation joined back, not from a window over the group,
    so the rows of a hot key may be spread over many tasks.
    """
    eligible = F.lit(True) if eligible is None else eligible
    grouped = [F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]
    firsts = (
        rows.where(eligible).groupBy(*grouped).agg(F.min(order).alias("_first_row"))
    )
    condition = all_of([F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)])
    joined = rows.join(firsts, condition, "left")
    repeat = F.coalesce(F.col(order) > F.col("_first_row"), F.lit(False))
    return joined.withColumn(name, repeat).drop("_first_row", *[f"_key{i}" for i in range(len(keys))])
