"""Positions and running totals over narrow staged rows, without gathering a group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stewardry.llm.staging import staged


def same(left: list[str], right: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)], F.lit(True))


def totals_before(rows: DataFrame, group: list[str], order: list[Column], value: Column, name: str) -> DataFrame:
    """Add the sum of ``value`` over the earlier rows of the same group.

    ``rows`` are read twice, once for the bounds of the ranges, so they should be
    staged and narrow. Each range is summed by itself; one row per range and group
    is accumulated.
    """
    chunk, base = "_chunk", [f"_of_{g}" for g in group]
    dealt = rows.repartitionByRange(*[F.col(g) for g in group], *order).withColumn(chunk, F.spark_partition_id())
    dealt = staged(dealt, "ranges")
    earlier = Window.partitionBy(*group).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy(*group, chunk).agg(F.sum(value).alias("_sum"))
    bases = sums.select(
        *[F.col(g).alias(b) for g, b in zip(group, base)],
        F.col(chunk).alias("_of_chunk"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"),
    )
    inside = Window.partitionBy(*group, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = placed.join(bases, same([*group, chunk], [*base, "_of_chunk"]))
    total = (F.col("_base") + F.col("_inside")).cast("long")
    return joined.withColumn(name, total).drop(chunk, "_of_chunk", "_base", "_inside", *base)
