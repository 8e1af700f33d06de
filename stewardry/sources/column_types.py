"""Types that the cells of text columns would have, and where they disagree.

Concept files are read as text; this tells what else a column could be. Types form
a lattice: whole numbers are numbers, dates are timestamps, and any two that have
nothing else in common are text. All columns of all rows are reduced in one
aggregation, in which a task keeps a few values per column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stewardry.operators.lookup import ROW

WHOLE, NUMBER, BOOLEAN, DATE, TIMESTAMP, TEXT = "whole", "number", "boolean", "date", "timestamp", "text"
# Types with a common one beside text, the more general one last.
FAMILIES = {"numeric": (WHOLE, NUMBER), "logical": (BOOLEAN,), "temporal": (DATE, TIMESTAMP), "textual": (TEXT,)}

# How cells of each type are written.
WHOLE_CELL = r"^[+-]?[0-9]{1,18}$"
NUMBER_CELL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?$"
DATE_CELL = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIMESTAMP_CELL = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?$"


def cell_type(cell: Column) -> Column:
    """The least type of a cell; null for a null cell."""
    return (
        F.when(cell.isNull(), None)
        .when(cell.rlike(WHOLE_CELL), WHOLE)
        .when(cell.rlike(NUMBER_CELL), NUMBER)
        .when(F.lower(cell).isin("true", "false"), BOOLEAN)
        .when(cell.rlike(DATE_CELL) & cell.try_cast("date").isNotNull(), DATE)
        .when(cell.rlike(TIMESTAMP_CELL) & cell.try_cast("timestamp").isNotNull(), TIMESTAMP)
        .otherwise(TEXT)
    )


def column_types(rows: DataFrame, columns: list[str] | None = None, order: str = ROW) -> DataFrame:
    """``column, type, cells, conflict_row, conflict`` of every text column.

    ``cells`` counts those that aren't null; a column without any has no type. A
    column of types with nothing in common is text: ``conflict_row`` is the first
    row whose cell doesn't go with the column's first cell, ``conflict`` that cell.
    A column whose first cell is text has no conflict, as text takes all. Rows with
    one number are taken in the order of their cells.
    """
    names = [c for c in rows.columns if c != order] if columns is None else columns
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("cell")) for c in names]))
    cells = rows.select(F.col(order).alias("at"), each.alias("_one")).select("at", "_one.*").withColumn("type", cell_type(F.col("cell")))
    family = reduce(
        lambda done, one: done.when(F.col("type").isin(*one[1]), one[0]), FAMILIES.items(), F.when(F.lit(False), F.lit(None).cast("string"))
    )
    cells = cells.withColumn("family", family)
    firsts = [F.min(F.when(F.col("family") == f, F.struct("at", "cell", "family"))).alias(f"first_{f}") for f in FAMILIES]
    general = [F.bool_or(F.col("type") == types[-1]).alias(f"general_{f}") for f, types in FAMILIES.items()]
    facts = cells.groupBy("column").agg(F.count("cell").alias("cells"), *firsts, *general)
    first = F.least(*[F.col(f"first_{f}") for f in FAMILIES])
    facts = facts.withColumn("first", first)
    others = [F.when(F.col("first.family") != f, F.col(f"first_{f}")) for f in FAMILIES]
    facts = facts.withColumn("other", F.when(F.col("first.family") != "textual", F.least(*others)))
    alone = reduce(
        lambda done, one: done.when(
            F.col("first.family") == one[0], F.when(F.col(f"general_{one[0]}"), one[1][-1]).otherwise(one[1][0])
        ),
        FAMILIES.items(),
        F.when(F.col("other").isNotNull(), TEXT),
    )
    return facts.select(
        "column", alone.alias("type"), "cells", F.col("other.at").alias("conflict_row"), F.col("other.cell").alias("conflict")
    )
