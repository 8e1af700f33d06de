"""Glossary terms: repeats, ids, parents, records, and both loaders' lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stewardry.functions.records import id_structs, json_text, one_or_none, stable_id
from stewardry.operators.dedupe import keep_first
from stewardry.operators.hierarchy import CYCLE, climb, grow
from stewardry.operators.lookup import ROW, left_lookup, resolve, resolve_owners
from stewardry.plans.domains import domain_id
from stewardry.plans.outcomes import BAD_DOMAIN, CREATED, EXISTING, FAILED, NO_KEY
from stewardry.session import stage

NAME, DOMAIN, PARENT = "glossary_term_name", "business_domain_name", "glossary_term_parent_term"
DOMAIN_ID = "glossary_term_business_domain_uuid"
ROLES = {
    "glossary_term_owner": "owner",
    "glossary_term_expert": "expert",
    "glossary_term_database_admin": "database_admin",
}


# The first loader's lookups: the named column, and the column of its id.
BY_NAME = {
    NAME: "glossary_term_name_id",
    PARENT: "glossary_term_parent_term_id",
    "glossary_term_synonyms": "glossary_term_synonyms_id",
    "glossary_term_related": "glossary_term_related_id",
}


def dedupe(file: DataFrame) -> DataFrame:
    """One row per (term, domain): a root row if any, else the greatest parent."""
    return keep_first(file, [NAME, DOMAIN], [F.col(PARENT).desc_nulls_first(), F.col(ROW)])


def term_id(rows: DataFrame, terms: DataFrame, name: str, domain: str, out: str) -> DataFrame:
    """Add the id of the term named in one column within the domain id of another."""
    return resolve(rows, terms, {name: "name", domain: "domain"}, {"id": out})


def term_facts(rows: DataFrame, terms: DataFrame, name: str) -> DataFrame:
    """Add id, domain and parent of the first term of a name, in any domain."""
    take = {"id": "term_id", "domain": "term_domain", "parentId": "term_parent_id"}
    return resolve(rows, terms, {name: "name"}, take)


def resolve_ids(rows: DataFrame, domains: DataFrame, terms: DataFrame) -> DataFrame:
    """Add ids of domain, parent, synonym, related term and the term itself.

    Synonym and related term are looked for in domains of their own. All four
    lookups run as one, over narrow rows of a name and a domain's name each; the
    ids come back to the wide row in one join. Nameless domains match nothing.
    """
    lookups = {
        "parent_term": (PARENT, DOMAIN),
        "synonyms": ("glossary_term_synonyms", "glossary_term_synonyms_domain"),
        "related": ("glossary_term_related", "glossary_term_related_domain"),
        "name": (NAME, DOMAIN),
    }
    each = [
        F.struct(F.lit(role).alias("role"), F.col(name).alias("name"), F.col(domain).alias("domain_name"))
        for role, (name, domain) in lookups.items()
    ]
    narrow = rows.select(ROW, F.explode(F.array(*each)).alias("_one")).select(ROW, "_one.*")
    narrow = domain_id(narrow.where("domain_name IS NOT NULL"), domains, "domain_name", "domain_id")
    found = term_id(narrow, terms, "name", "domain_id", "term_id")
    ids = found.groupBy(F.col(ROW).alias("_of")).agg(
        F.max(F.when(F.col("role") == "name", F.col("domain_id"))).alias(DOMAIN_ID),
        *[
            F.max(F.when(F.col("role") == role, F.col("term_id"))).alias(f"glossary_term_{role}_uuid")
            for role in lookups
        ],
    )
    return rows.join(ids, F.col(ROW) == F.col("_of"), "left").drop("_of")


def with_product(rows: DataFrame, products: DataFrame) -> DataFrame:
    """Each term with every data product of the name it gives; null for none."""
    named = products.select(F.col("name").alias("_product"), F.col("id").alias("data_product_uuid"))
    return left_lookup(rows, named, {"glossary_term_data_product": "_product"}).drop("_product")


def resolve_by_name(rows: DataFrame, full_terms: DataFrame) -> DataFrame:
    """The first loader's lookup: by name in all domains, one row per match.

    The names of parent, synonym and related term give way to ids, and nulls to
    empty text.
    """
    known = full_terms.select(F.col("Name").cast("string"), "ID")
    for column, new in BY_NAME.items():
        side = known.withColumnsRenamed({"Name": "_name", "ID": new})
        rows = left_lookup(rows, side, {column: "_name"}).drop("_name", *[column] * (column != NAME))
    return rows.na.fill("")


def dedupe_by_parent_id(rows: DataFrame) -> DataFrame:
    """The first loader's repeats: one row per name, the least parent id first."""
    parent = F.nullif(F.col("glossary_term_parent_term_id"), F.lit(""))
    ties = [ROW, "glossary_term_name_id", "glossary_term_synonyms_id", "glossary_term_related_id"]
    return keep_first(rows, [NAME], [parent.asc_nulls_last(), *[F.col(c) for c in ties]])


def first_by_name(rows: DataFrame, full_terms: DataFrame) -> DataFrame:
    """What :func:`dedupe_by_parent_id` keeps of :func:`resolve_by_name`.

    The matches of a row's four names are combined freely, so the first combination
    holds the first id of each name by itself: the least, and for a parent the least
    that isn't empty. Each lookup takes that one id, and a name held in any number
    of domains never makes more than one row of a row.
    """
    known = full_terms.select(F.col("Name").cast("string").alias("_name"), F.coalesce("ID", F.lit("")).alias("_id"))
    least = known.where(F.col("_name").isNotNull()).groupBy("_name").agg(
        F.min("_id").alias("_any"), F.min(F.nullif(F.col("_id"), F.lit(""))).alias("_parent")
    )
    for column, new in BY_NAME.items():
        side = least.select("_name", F.col("_parent" if column == PARENT else "_any").alias(new))
        rows = left_lookup(rows, side, {column: "_name"}).drop("_name", *[column] * (column != NAME))
    return dedupe_by_parent_id(rows.na.fill(""))


def parent_ids(rows: DataFrame, terms: DataFrame, statuses: DataFrame | None = None) -> DataFrame:
    """Add ``parent_id`` and ``parent_missing`` to rows that have a domain id.

    A parent is looked for in the catalog, then among the rows themselves. A
    row that hangs on a cycle takes a parent from the rows only if that one
    stands before it, so that no cycle is written; it loads as a root otherwise.
    ``statuses`` has the hierarchy's ``_row, status, depth``; without it no row
    counts as hanging on a cycle.
    """
    found = term_id(rows, terms, PARENT, DOMAIN_ID, "_catalog_parent")
    batch = rows.where(F.col(DOMAIN_ID).isNotNull()).select(NAME, DOMAIN_ID, F.col(ROW).alias("_at"))
    found = resolve(
        found, batch, {PARENT: NAME, DOMAIN_ID: DOMAIN_ID}, {"_at": "_parent_row"}, order="_at"
    )
    usable = F.col("_parent_row").isNotNull()
    if statuses is not None:
        known = statuses.select(F.col(ROW).alias("_of"), F.col("status").alias("_status"), "depth")
        found = found.join(known, F.col(ROW) == F.col("_of"), "left").drop("_of")
        usable = usable & ((F.col("_status") != CYCLE) | (F.col("_parent_row") < F.col(ROW)))
    in_batch = F.when(usable, stable_id("term", F.col(DOMAIN_ID), F.col(PARENT)))
    parent = F.coalesce("_catalog_parent", in_batch)
    return (
        found.withColumn("parent_id", parent)
        .withColumn("parent_missing", F.col(PARENT).isNotNull() & F.col("parent_id").isNull())
        .drop("_catalog_parent", "_parent_row", "_status")
    )


def catalog_forest(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """``id, origin, name, domain, parent_id, root_id, depth, status`` of every term of
    the catalog as it will be: those it holds, and the rows that are new to it.

    ``rows`` are a load's terms, unique by name and domain id. Catalog terms name
    their parent by id. A new row names it: a term of its domain that the catalog
    holds, else one that is new as well. Status and depth so hold for both together;
    a parent that is nowhere makes an orphan of a term and of all below it.
    """
    held = terms.select("id", F.lit("catalog").alias("origin"), "name", "domain", F.col("parentId").alias("_named"), "parentId")
    new = rows.where(F.col(DOMAIN_ID).isNotNull() & F.col(NAME).isNotNull())
    new = term_id(new, terms, NAME, DOMAIN_ID, "_held").where("_held IS NULL")
    new = stage(new.select(ROW, NAME, DOMAIN_ID, PARENT, stable_id("term", F.col(DOMAIN_ID), F.col(NAME)).alias("id")))
    found = term_id(new, terms, PARENT, DOMAIN_ID, "_catalog_parent")
    found = resolve(found, new, {PARENT: NAME, DOMAIN_ID: DOMAIN_ID}, {"id": "_new_parent"})
    added = found.select(
        "id",
        F.lit("load").alias("origin"),
        F.col(NAME).alias("name"),
        F.col(DOMAIN_ID).alias("domain"),
        F.col(PARENT).alias("_named"),
        F.coalesce("_catalog_parent", "_new_parent").alias("parentId"),
    )
    nodes = stage(held.unionByName(added))
    there = nodes.select(F.col("id").alias("_there")).distinct()
    # Roots look themselves up, so that they stay spread.
    linked = nodes.join(there, F.coalesce("parentId", "id") == F.col("_there"), "left")
    parent = F.when(F.col("parentId").isNotNull(), F.col("_there"))
    linked = linked.select(F.col("id").alias(ROW), parent.alias("parent_row"), F.col("_named").isNull().alias("is_root"))
    facts = climb(linked).nodes.select(F.col(ROW).alias("_of"), "parent_row", "root_row", "depth", "status")
    return nodes.join(facts, F.col("id") == F.col("_of")).select(
        "id", "origin", "name", "domain", F.col("parent_row").alias("parent_id"), F.col("root_row").alias("root_id"), "depth", "status"
    )


def plan_terms(file: DataFrame, domains: DataFrame, terms: DataFrame, users: DataFrame) -> DataFrame:
    """One row per (term, domain) with ``id, outcome, error, record``.

    Parents inside the load get their ids before anything is written, so rows
    may be applied in any order; a store that wants parents first applies them
    by ``depth``, with unreached terms (null) last.
    """
    # Read by the hierarchy, the parents and the owners.
    rows = stage(domain_id(dedupe(file), domains, DOMAIN, DOMAIN_ID))
    facts = grow(rows, NAME, PARENT, DOMAIN).nodes
    planned = parent_ids(rows, terms, facts)
    planned = term_id(planned, terms, NAME, DOMAIN_ID, "existing_id")
    roles = {column: f"_{role}" for column, role in ROLES.items()}
    planned = resolve_owners(planned, users, roles, cells=rows)
    contacts = F.struct(*[id_structs(F.col(f"_{role}")).alias(role) for role in ROLES.values()])
    record = json_text(
        F.struct(
            F.col(NAME).alias("name"),
            F.col("glossary_term_description").alias("description"),
            F.col("glossary_term_status").alias("status"),
            contacts.alias("contacts"),
            one_or_none(F.col("glossary_term_acronyms")).alias("acronyms"),
            F.col(DOMAIN_ID).alias("domain"),
            F.col("parent_id").alias("parentId"),
        )
    )
    gate = F.when(F.col(DOMAIN_ID).isNull(), BAD_DOMAIN).when(F.col(NAME).isNull(), NO_KEY)
    outcome = (
        F.when(F.col("error").isNotNull(), FAILED)
        .when(F.col("existing_id").isNotNull(), EXISTING)
        .otherwise(CREATED)
    )
    return (
        planned.withColumn("error", gate)
        .withColumn("outcome", outcome)
        .select(
            ROW,
            F.coalesce("existing_id", stable_id("term", F.col(DOMAIN_ID), F.col(NAME))).alias("id"),
            F.col(NAME).alias("name"),
            F.col(DOMAIN_ID).alias("domain"),
            "parent_id",
            "parent_missing",
            "depth",
            "outcome",
            "error",
            F.when(F.col("outcome") == CREATED, record).alias("record"),
        )
    )
