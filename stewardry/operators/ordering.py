"""Positions, running totals, pages and explicit orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stewardry.operators.lookup import all_of
from stewardry.session import stage


def running_total(
    rows: DataFrame, group: list[str], order: list[Column], value: Column, name: str
) -> DataFrame:
    """Add the sum of ``value`` over all earlier rows of the same group.

    ``order`` must be total within a group. A group is never gathered in one
    task: rows are range-partitioned by (group, order), each chunk is summed,
    and only the chunk sums are accumulated across chunks. The chunks are
    staged first, since range bounds are sampled and must not move between the
    two passes.
    """
    chunked = stage(
        rows.repartitionByRange(*[F.col(g) for g in group], *order).withColumn(
            "_chunk", F.spark_partition_id()
        )
    )
    sums = chunked.groupBy(*group, "_chunk").agg(F.sum(value).alias("_chunk_sum"))
    earlier_chunks = (
        Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    bases = sums.select(
        *[F.col(g).alias(f"_base_{g}") for g in group],
        F.col("_chunk").alias("_base_chunk"),
        F.coalesce(F.sum("_chunk_sum").over(earlier_chunks), F.lit(0)).alias("_base"),
    )
    earlier_rows = (
        Window.partitionBy(*group, "_chunk")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    within = chunked.withColumn(
        "_within", F.coalesce(F.sum(value).over(earlier_rows), F.lit(0))
    )
    same = [F.col(g).eqNullSafe(F.col(f"_base_{g}")) for g in group]
    joined = within.join(bases, all_of([*same, F.col("_chunk") == F.col("_base_chunk")]))
    total = (F.col("_base") + F.col("_within")).cast("long")
    return joined.withColumn(name, total).drop(
        "_chunk", "_base_chunk", "_base", "_within", *[f"_base_{g}" for g in group]
    )


def positions(rows: DataFrame, order: list[Column], name: str, group: list[str] | None = None) -> DataFrame:
    """Add each row's place (from 1) in ``order``, over all rows or per group."""
    counted = running_total(rows, group or [], order, F.lit(1), name)
    return counted.withColumn(name, F.col(name) + 1)


def page(
    rows: DataFrame, group: list[str], order: list[Column], tie: str, skip: int, top: int
) -> DataFrame:
    """Rows ``skip + 1`` to ``skip + top`` of each group, with their ``position``.

    ``tie`` names a column that differs between all rows of a group, so that the
    order is total. Positions are distributed, whatever the page.
    """
    placed = positions(rows, [*order, F.col(tie)], "position", group)
    return placed.where((F.col("position") > skip) & (F.col("position") <= skip + top))


def reorder_by_list(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows as an explicit list of keys names them, once for each naming.

    ``wanted`` has ``position`` and ``key``. A key that no row has keeps its
    position, with nulls in place of a row. Output order is (position, row).
    """
    named = wanted.select(F.col("key").alias("_wanted"), "position")
    return named.join(rows, F.col("_wanted") == F.col(key), "left").drop("_wanted")
