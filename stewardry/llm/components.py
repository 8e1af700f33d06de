"""Connected components of a graph of edges, in rounds of Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stewardry.llm.staging import staged


def components(edges: DataFrame, name: str = "edges") -> DataFrame:
    """``node, component``: the least node that each node of an edge can reach.

    ``edges`` has columns ``a, b``. Large-star and small-star steps take turns:
    each joins every node to the least of its neighbours, first the neighbours
    above it, then those below, until all edges point to the least node of their
    component. A node of many neighbours is reduced in its map tasks, and its
    edges are joined in slices.
    """
    edges = staged(_pointing_down(edges), name)
    mark = _mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _joined_to_least(both).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        down = _pointing_down(large)
        small = _joined_to_least(down)
        small = small.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            small.select("a", F.col("least").alias("b"))
        )
        edges = staged(_pointing_down(small), name)
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _pointing_down(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _joined_to_least(edges: DataFrame) -> DataFrame:
    """Each edge with the least of ``a`` and all its ``b``."""
    least = edges.groupBy(F.col("a").alias("_a")).agg(F.min("b").alias("_b"))
    joined = edges.join(least, F.col("a") == F.col("_a"))
    return joined.select("a", "b", F.least("a", "_b").alias("least"))


def _mark(edges: DataFrame) -> tuple:
    """A mark that changes with the set of edges: one row, whatever their number."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
