"""Catalog snapshots: list documents with a ``value`` array, as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stewardry.functions.records import json_or_null_word
from stewardry.operators.lookup import ROW
from stewardry import schemas
from stewardry.schemas import ASSET_COLUMN, CATALOG_LISTS

# Nested parts handed on as JSON text, which say "null" when absent.
JSON_PARTS = {
    "domains": ("domains",),
    "data_assets": ("domains",),
    "data_products": ("domains",),
    "terms_full": ("contacts",),
}


def page_number(path: Column) -> Column:
    """The last number in a file's name; a file without one fails the read."""
    name = F.regexp_extract(path, r"([0-9]+)[^0-9/]*$", 1)
    unplaced = F.raise_error(F.concat(F.lit("no page number in "), path))
    return F.when(name == "", unplaced).otherwise(name).cast("long")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per JSON document file under ``path``: ``document``, ``page``.

    ``page`` is the number of a folder ``page=…`` or else the last number in the
    file's name, so page 10 comes after page 2. A file without a number has no
    place in the list and fails the read.
    """
    files = spark.read.text(path, wholetext=True)
    page = F.col("page").cast("long") if "page" in files.columns else page_number(F.col("_metadata.file_path"))
    return files.select(F.col("value").alias("document"), page.alias("page"))


def catalog_list(pages: DataFrame, kind: str, document: str = "document") -> DataFrame:
    """Objects of the list documents, as the fixed columns of their kind.

    An absent key is null. Columns of ``pages`` besides the document are kept,
    so that the caller can number rows across pages.
    """
    array = "values" if kind == "policies" else "value"
    schema = CATALOG_LISTS[kind]
    objects = _objects(pages, document, array, schema)
    nested = JSON_PARTS.get(kind, ())
    columns = [
        (json_or_null_word(F.col(f"_one.{c}")) if c in nested else F.col(f"_one.{c}")).alias(c)
        for c in schema.names
    ]
    return objects.select(*columns, *[c for c in pages.columns if c != document], "_pos")


def _objects(pages: DataFrame, document: str, array: str, schema: T.StructType) -> DataFrame:
    parsed = F.from_json(document, T.StructType([T.StructField(array, T.ArrayType(schema))]))
    others = [c for c in pages.columns if c != document]
    return pages.select(*others, F.posexplode(parsed[array]).alias("_pos", "_one"))


def terms_of(terms: DataFrame, domain_id: str | None = None) -> DataFrame:
    """Catalog terms of one domain; of all domains when none is named."""
    return terms.where(F.col("domain") == domain_id) if domain_id else terms


def full_terms(pages: DataFrame, document: str = "document") -> DataFrame:
    """Terms with contacts, under the column names of the first loader."""
    spelled = {
        "id": "ID",
        "name": "Name",
        "domain": "Domain",
        "description": "Description",
        "contacts": "Contacts",
        "status": "Status",
    }
    return catalog_list(pages, "terms_full", document).withColumnsRenamed(spelled)


def asset_details(
    documents: DataFrame, document: str = "document", facts: tuple[str, ...] = tuple(ASSET_COLUMN.names)
) -> DataFrame:
    """Asset detail documents as ``id, name, schema``, with these facts of columns."""
    return documents.select(F.from_json(document, schemas.asset_details(facts)).alias("_one")).select("_one.*")


def asset_columns(details: DataFrame) -> DataFrame:
    """One row per schema column of the assets."""
    one = F.col("_one")
    return details.select(
        F.col("id").alias("asset_id"),
        F.col("name").alias("asset_name"),
        F.posexplode("schema").alias("_pos", "_one"),
    ).select(
        "asset_id",
        "asset_name",
        F.col("_pos").cast("long").alias("position"),
        *[one[c].alias(f"column_{c}") for c in ("name", "description", "classifications", "type")],
    )


def searchable(hits: DataFrame, excluded: str) -> DataFrame:
    """Search hits but for one object type; a hit without a type stays."""
    return hits.where(~F.col("objectType").eqNullSafe(F.lit(excluded)))


def numbered(rows: DataFrame, *order: Column) -> DataFrame:
    """Add ``_row`` for list order, such as page and place on it."""
    return rows.withColumn(ROW, F.struct(*order))
