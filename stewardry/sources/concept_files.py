"""Reading and writing concept files (CSV with a header)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stewardry.operators.lookup import ROW
from stewardry.schemas import COLUMN_SPELLINGS, CONCEPT_FILES
from stewardry.session import stage
from stewardry.sources.split_csv import parse_records, read_records

CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}


class MissingColumns(ValueError):
    """A concept file lacks columns its kind requires."""


def read_concepts(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """Scan the concept file or folder of files of one kind.

    Every column is text, as a name made of digits is still a name, and an
    empty cell is null; the files of a folder must have the same header. ``_row``
    numbers the rows in the order of their file. Cells may hold line breaks, and a
    large file is still read by many tasks. Lines end in a line feed, with or
    without a carriage return before it. Rows are staged with their numbers: a plan
    that reads them twice must see the same ones.
    """
    names = spark.read.options(**CSV_OPTIONS).csv(path).columns
    rows = parse_records(read_records(spark, path), names, {**CSV_OPTIONS, "header": "false"})
    return stage(as_concepts(rows.withColumnRenamed("line", ROW), kind))


def as_concepts(raw: DataFrame, kind: str) -> DataFrame:
    """Check required columns, add absent optional ones as null, fix the order."""
    contract = CONCEPT_FILES[kind]
    named = contract.required + contract.optional
    named += tuple(c for c in contract.derived if c in raw.columns)
    source = {name: _spelling(name, raw.columns) for name in named}
    missing = [name for name in contract.required if source[name] is None]
    if missing:
        raise MissingColumns(f"{kind}: no column {', '.join(missing)}")
    kept = [c for c in (ROW,) if c in raw.columns]
    return raw.select(
        *[
            (F.col(f"`{source[name]}`") if source[name] else F.lit(None)).cast("string").alias(name)
            for name in named
        ],
        *kept,
    )


def _spelling(name: str, present: list[str]) -> str | None:
    if name in present:
        return name
    pattern = COLUMN_SPELLINGS.get(name)
    return next((c for c in present if pattern and re.fullmatch(pattern, c)), None)


def write_concepts(rows: DataFrame, path: str) -> None:
    """Write rows as concept files of the form ``read_concepts`` takes."""
    rows.write.options(
        header="true",
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false",
    ).csv(path)
