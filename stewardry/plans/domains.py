"""Business domains: parents, records, outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stewardry.functions.records import full_json_text, stable_id
from stewardry.operators.dedupe import mark_repeats
from stewardry.operators.lookup import ROW, resolve
from stewardry.plans.outcomes import CREATED, EXISTING, FAILED, NO_KEY

NAME, PARENT, PARENT_ID = (
    "business_domain_name",
    "business_domain_parent",
    "business_domain_parent_guid",
)


def domain_id(rows: DataFrame, domains: DataFrame, column: str, name: str) -> DataFrame:
    """Add the id of the domain named in ``column``; null when there is none."""
    return resolve(rows, domains, {column: "name"}, {"id": name})


def with_parent(
    file: DataFrame, catalog: DataFrame, strict: bool = False, batch: DataFrame | None = None
) -> DataFrame:
    """Add each row's parent id unless the file brings one.

    A parent is looked for in the catalog, then among the domains of earlier
    rows of the file (or ``batch``), so no domain becomes its own parent, over
    however many steps. ``strict`` leaves the second out, as when parents must
    have been there before the load.
    """
    if PARENT_ID in file.columns:
        return file
    found = resolve(file, catalog, {PARENT: "name"}, {"id": PARENT_ID})
    if strict:
        return found
    named = (file if batch is None else batch).select(NAME, ROW)
    both = resolve(found, named, {PARENT: NAME}, {ROW: "_parent_row"})
    new_id = F.when(F.col("_parent_row") < F.col(ROW), stable_id("domain", F.col(PARENT)))
    return both.withColumn(PARENT_ID, F.coalesce(PARENT_ID, new_id)).drop("_parent_row")


def parent_rows(file: DataFrame, catalog: DataFrame) -> DataFrame:
    """All catalog rows named as a parent, once for each file row that does."""
    wanted = file.select(F.col(PARENT).alias("_wanted"), F.col(ROW).alias("file_row"))
    return wanted.join(catalog, F.col("_wanted") == F.col("name")).drop("_wanted")


def in_catalog(file: DataFrame, catalog: DataFrame) -> DataFrame:
    """Catalog domains with the file rows of the same name."""
    return catalog.join(file.drop(*(set(file.columns) & set(catalog.columns))), F.col("name") == F.col(NAME))


def plan_domains(file: DataFrame, catalog: DataFrame, strict: bool = False) -> DataFrame:
    """Every file row with ``id, outcome, error, record``.

    A name already in the catalog, or on an earlier row of the file, is
    existing; a row without a name fails. ``record`` is the new domain's JSON;
    other rows have none.
    """
    rows = resolve(file, catalog, {NAME: "name"}, {"id": "existing_id"})
    named = F.col(NAME).isNotNull()
    is_new = named & F.col("existing_id").isNull()
    rows = mark_repeats(rows, [NAME], "_repeat", is_new)
    rows = with_parent(rows, catalog, strict, batch=file)
    creates = is_new & ~F.col("_repeat")
    record = full_json_text(
        F.struct(
            F.col(NAME).alias("name"),
            F.col("business_domain_email_owners").alias("owners"),
            F.col("business_domain_status").alias("status"),
            F.col("business_domain_type").alias("type"),
            F.col("business_domain_description").alias("description"),
            F.col(PARENT_ID).alias("parentId"),
        )
    )
    return rows.select(
        ROW,
        F.coalesce("existing_id", stable_id("domain", F.col(NAME))).alias("id"),
        F.col(NAME).alias("name"),
        F.col("business_domain_type").alias("type"),
        F.col(PARENT_ID).alias("parent_id"),
        F.when(~named, FAILED).when(creates, CREATED).otherwise(EXISTING).alias("outcome"),
        F.when(~named, NO_KEY).alias("error"),
        F.when(creates, record).alias("record"),
    )
