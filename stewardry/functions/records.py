"""Column expressions that build ids and nested record parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_id(kind: str, *parts: Column) -> Column:
    """An id shaped as a uuid that depends on the concept's key only.

    Running a load again gives the same ids, and a child can name its parent's
    id before either is written. Parts carry their length, so two keys never
    run into one text. A null part gives no id.
    """
    text = F.concat(
        F.lit(kind),
        *[F.concat(F.lit("/"), F.length(p).cast("string"), F.lit(":"), p) for p in parts],
    )
    digest = F.md5(text)
    pieces = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    shaped = F.concat_ws("-", *[F.substring(digest, start, size) for start, size in pieces])
    return F.when(digest.isNotNull(), shaped)


def id_structs(ids: Column) -> Column:
    """``[a, b]`` as ``[{id: a}, {id: b}]``; null as an empty list."""
    known = F.coalesce(ids, F.array().cast("array<string>"))
    return F.transform(known, lambda one: F.struct(one.alias("id")))


def one_or_none(cell: Column) -> Column:
    """A list holding the cell, empty when the cell is null."""
    return F.when(cell.isNotNull(), F.array(cell)).otherwise(F.array().cast("array<string>"))


def or_empty(cell: Column) -> Column:
    return F.coalesce(cell, F.lit(""))


def type_names(classifications: Column) -> Column:
    """Classification names; an absent list gives an empty one."""
    names = F.transform(classifications, lambda one: one["typeName"])
    return F.coalesce(names, F.array().cast("array<string>"))


def json_text(value: Column) -> Column:
    """JSON text with null fields left out."""
    return F.to_json(value)


def full_json_text(value: Column) -> Column:
    """JSON text that spells null fields out."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def json_or_null_word(text: Column) -> Column:
    """Text of a nested part; the word ``null`` when the key is absent."""
    return F.coalesce(text, F.lit("null"))
