"""One query per operator, over inputs derived from the driver's tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stewardry.functions import records, text
from stewardry.operators import dedupe, hierarchy, lookup, ordering
from stewardry.operators.lookup import ROW
from stewardry.plans import (
    apply,
    assets,
    cdes,
    domains,
    edges,
    okrs,
    outcomes,
    policies,
    products,
    terms,
)
from stewardry.queries import inputs
from stewardry.queries.inputs import load
from stewardry.schemas import LAKEHOUSE_TABLE, RESOURCE_SET, SQL_TABLE
from stewardry.session import shared_folder, stage, stage_table, tune
from stewardry.sources import concept_files, documents, snapshots
from stewardry.sources import page_manifest as manifest
from stewardry.sources.column_types import column_types

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(tune(spark), sf_dir)

    QUERIES[run.__name__] = tuned
    return run


def joined(column: str) -> F.Column:
    return F.array_join(F.col(column), ",").alias(column)


# Scans


def _scanned(spark, sf, kind, name):
    path = f"{shared_folder(spark)}/concepts-{uuid.uuid4()}"
    concept_files.write_concepts(load(spark, sf, name).drop(ROW), path)
    return concept_files.read_concepts(spark, kind, path).drop(ROW)


@query
def scan_concepts(spark, sf):
    return _scanned(spark, sf, "glossary_terms", "term_file")


@query
def scan_domains(spark, sf):
    return _scanned(spark, sf, "business_domains", "domain_file")


@query
def scan_products(spark, sf):
    return _scanned(spark, sf, "data_product", "product_file")


@query
def scan_assets(spark, sf):
    return _scanned(spark, sf, "data_assets", "asset_file")


@query
def scan_okrs(spark, sf):
    return _scanned(spark, sf, "okr", "okr_file")


@query
def scan_cdes(spark, sf):
    return _scanned(spark, sf, "cde", "cde_file")


_FILES = ["domain_file", "term_file", "product_file", "asset_file", "okr_file", "cde_file", "typed_file"]


@query
def concept_column_types(spark, sf):
    """What the columns of each file could be but for text."""
    told = [column_types(load(spark, sf, name)).select(F.lit(name).alias("file"), "*") for name in _FILES]
    return reduce(DataFrame.unionByName, told)


def _listed_in_files(spark, rows, kind, array="value"):
    """Rows written as list documents, a file each, and read back in list order."""
    path = f"{shared_folder(spark)}/lists-{uuid.uuid4()}"
    pages = inputs.list_pages(rows, ROW, array).select("page", "document")
    pages.write.partitionBy("page").text(path)
    listed = snapshots.catalog_list(snapshots.read_documents(spark, path), kind)
    numbered = snapshots.numbered(listed, F.col("page"), F.col("_pos"))
    return numbered.select(*rows.drop(ROW).columns, "page", F.col(f"{ROW}._pos").cast("long").alias("place"))


@query
def list_policies(spark, sf):
    number = F.substring_index("id", "-", -1).cast("long")
    rows = load(spark, sf, "policies").select(number.alias(ROW), "id", "name")
    return _listed_in_files(spark, rows, "policies", "values")


def _policy_pages(spark, sf):
    """Policies written as list documents, a file each, on every second page number."""
    number = F.substring_index("id", "-", -1).cast("long")
    pages = inputs.list_pages(load(spark, sf, "policies").select(number.alias(ROW), "id", "name"), ROW, "values")
    path = f"{shared_folder(spark)}/lists-{uuid.uuid4()}"
    pages.select((F.col("page") * 2).alias("page"), "document").write.partitionBy("page").text(path)
    return path


@query
def page_manifest(spark, sf):
    told = manifest.manifest(spark, _policy_pages(spark, sf), inputs.PAGE_TASK_BYTES)
    return told.select("page", "bytes", "task", "status")


@query
def list_policies_packed(spark, sf):
    packed = manifest.pack(spark, _policy_pages(spark, sf), f"{shared_folder(spark)}/packed-{uuid.uuid4()}", inputs.PAGE_TASK_BYTES)
    listed = snapshots.catalog_list(packed, "policies")
    return listed.select("id", "name", "page", F.col("_pos").cast("long").alias("place"))


@query
def list_users(spark, sf):
    return _listed_in_files(spark, load(spark, sf, "users").select(ROW, "mail", "id"), "users")


@query
def list_hits(spark, sf):
    return _list(spark, sf, "hits", "search_hits", ["id", "qualifiedName", "objectType", "account"]).select(
        "id", "qualifiedName", "objectType", "account"
    )


@query
def list_okrs(spark, sf):
    return _list(spark, sf, "okrs", "okrs", ["id", "definition", "status", "domain"]).select(
        "id", "definition", "status", "domain"
    )


def _list(spark, sf, name, kind, fields):
    rows = load(spark, sf, name).select(ROW, *fields)
    return snapshots.catalog_list(inputs.list_pages(rows, ROW), kind)


def _some_domains():
    ids = F.array(F.struct(F.concat(F.lit("of-"), "id").alias("id")))
    return F.when(F.col(ROW) % 2 == 0, ids).alias("domains")


@query
def catalog_domains(spark, sf):
    rows = _list(spark, sf, "domains", "domains", ["id", "name", "type", _some_domains()])
    return rows.select("id", "name", "type", "domains")


@query
def catalog_assets(spark, sf):
    rows = _list(spark, sf, "assets", "data_assets", ["id", "name", "type", _some_domains()])
    return rows.select("id", "name", "type", "domains")


@query
def catalog_products(spark, sf):
    rows = _list(spark, sf, "products", "data_products", ["id", "name", "type", _some_domains()])
    return rows.select("id", "name", "type", "domains")


@query
def catalog_terms(spark, sf):
    listed = _list(spark, sf, "terms", "terms", ["id", "name", "domain", "parentId"])
    listed = listed.select("id", "name", "domain", "parentId")
    every = snapshots.terms_of(listed).withColumn("listed", F.lit("all"))
    one = snapshots.terms_of(listed, "dom-Brand#1").withColumn("listed", F.lit("one domain"))
    return every.unionByName(one)


@query
def catalog_terms_full(spark, sf):
    owner = F.struct(F.array(F.struct(F.concat(F.lit("u-"), "id").alias("id"))).alias("owner"))
    extra = [
        F.concat(F.lit("About "), "name").alias("description"),
        F.when(F.col(ROW) % 3 == 0, owner).alias("contacts"),
        F.lit("Draft").alias("status"),
    ]
    rows = load(spark, sf, "terms").select(ROW, "id", "name", "domain", *extra)
    pages = inputs.list_pages(rows, ROW)
    return snapshots.full_terms(pages).select("ID", "Name", "Domain", "Description", "Contacts", "Status")


@query
def catalog_cdes(spark, sf):
    listed = _list(spark, sf, "cdes", "cdes", ["name", "domain", "dataType", "status", "id"])
    wanted = load(spark, sf, "wanted_domains")
    return cdes.cdes_of(listed, wanted).select("name", "domain", "dataType", "status", "id")


@query
def okr_page(spark, sf):
    page = okrs.okr_page(load(spark, sf, "okrs"))
    return page.select("domain", "position", "id", "definition", "status")


@query
def asset_columns(spark, sf):
    details = snapshots.asset_details(inputs.detail_documents(spark, sf))
    wanted = load(spark, sf, "assets").where("description IS NOT NULL").select("id")
    columns = snapshots.asset_columns(lookup.already_in(details, wanted, {"id": "id"}))
    return columns.withColumn("column_classifications", joined("column_classifications"))


@query
def asset_documents(spark, sf):
    parsed = documents.parse_assets(inputs.entity_documents(spark, sf))
    lineage = documents.parse_lineage(inputs.lineage_documents(spark, sf)).withColumnRenamed("guid", "of")
    rows = parsed.join(lineage, F.col("guid") == F.col("of"), "left")
    attached = F.get("entity.relationshipAttributes.attachedSchema", F.lit(0))["guid"]
    columns = F.col("entity.relationshipAttributes.columns")
    return rows.select(
        "guid",
        F.col("entity.typeName").alias("type_name"),
        F.col("entity.attributes.displayName").alias("display_name"),
        F.col("entity.attributes.name").alias("name"),
        F.array_join(records.type_names(F.col("entity.classifications")), ",").alias("classifications"),
        F.coalesce(F.size(columns), F.lit(0)).cast("long").alias("columns"),
        F.coalesce(F.size("referred"), F.lit(0)).cast("long").alias("referred"),
        attached.alias("schema_guid"),
        "metastore_guid",
    )


# Lookups and joins


@query
def domain_lookup(spark, sf):
    rows = domains.domain_id(load(spark, sf, "okr_file"), load(spark, sf, "domains"), "domain", "domain_id")
    return rows.select(ROW, "domain", "domain_id")


@query
def term_lookup(spark, sf):
    rows = terms.term_facts(load(spark, sf, "term_file"), load(spark, sf, "terms"), "glossary_term_synonyms")
    return rows.select(ROW, "glossary_term_synonyms", "term_id", "term_domain", "term_parent_id")


@query
def domain_parent(spark, sf):
    file, catalog = load(spark, sf, "domain_file"), load(spark, sf, "domains")
    strict = domains.with_parent(file, catalog, strict=True).withColumn("lookup", F.lit("catalog"))
    both = domains.with_parent(file, catalog).withColumn("lookup", F.lit("catalog and file"))
    return strict.unionByName(both).select(ROW, "lookup", "business_domain_name", "business_domain_parent_guid")


@query
def domain_parent_rows(spark, sf):
    rows = domains.parent_rows(load(spark, sf, "domain_file"), load(spark, sf, "domains"))
    return rows.select("file_row", "id", "name", "type")


def _loaded(spark, sf):
    return domains.in_catalog(load(spark, sf, "domain_file"), load(spark, sf, "domains").drop(ROW))


@query
def domains_joined(spark, sf):
    return _loaded(spark, sf).select(ROW, "id", "name", "type", "business_domain_email_owners")


@query
def assets_joined(spark, sf):
    rows = edges.with_products(load(spark, sf, "asset_file"), load(spark, sf, "products"))
    return rows.select(ROW, "dp_name", "data_asset_fqn", "product_id")


def _deduped(spark, sf):
    return terms.dedupe(load(spark, sf, "term_file"))


def _resolved(spark, sf):
    return terms.resolve_ids(_deduped(spark, sf), load(spark, sf, "domains"), load(spark, sf, "terms"))


@query
def glossary_resolve(spark, sf):
    return _resolved(spark, sf).select(
        "glossary_term_name",
        "business_domain_name",
        "glossary_term_business_domain_uuid",
        "glossary_term_parent_term_uuid",
        "glossary_term_synonyms_uuid",
        "glossary_term_related_uuid",
        "glossary_term_name_uuid",
    )


_BY_NAME = [
    ROW,
    "glossary_term_name",
    "glossary_term_name_id",
    "glossary_term_parent_term_id",
    "glossary_term_synonyms_id",
    "glossary_term_related_id",
    "glossary_term_acronyms",
]


def _resolved_by_name(spark, sf):
    return terms.resolve_by_name(load(spark, sf, "term_file"), load(spark, sf, "terms_by_name"))


@query
def glossary_v1_resolve(spark, sf):
    return _resolved_by_name(spark, sf).select(*_BY_NAME)


@query
def glossary_product(spark, sf):
    rows = terms.with_product(load(spark, sf, "term_file"), load(spark, sf, "products"))
    return rows.select(ROW, "glossary_term_name", "data_product_uuid")


def _owned(spark, sf):
    return lookup.resolve_owners(
        load(spark, sf, "okr_file"), load(spark, sf, "users"), {"owner": "ids"}, unknown="unknown"
    )


@query
def owner_resolve(spark, sf):
    return _owned(spark, sf).select(ROW, "owner", joined("ids"), joined("unknown"))


@query
def owner_failures(spark, sf):
    return outcomes.owner_failures(_plan_okrs(spark, sf), "okr", "definition", "unknown_owners")


@query
def owner_struct(spark, sf):
    return _owned(spark, sf).select(ROW, records.json_text(records.id_structs(F.col("ids"))).alias("contacts"))


@query
def asset_resolve(spark, sf):
    rows = assets.resolve_guids(load(spark, sf, "asset_file"), load(spark, sf, "hits"), "data_asset_fqn", "data_asset_account")
    return rows.select(ROW, "data_asset_fqn", "guid")


@query
def policy_targets(spark, sf):
    return policies.policy_targets(load(spark, sf, "domains"), load(spark, sf, "policies")).select(
        "domain_id", "prefix", "policy_id"
    )


@query
def cde_column_match(spark, sf):
    file = load(spark, sf, "cde_file").withColumn("account", F.lit(inputs.CDE_ACCOUNT))
    found = assets.resolve_guids(file, load(spark, sf, "hits"), "cde_fqdn", "account")
    rows = assets.with_existing(found, load(spark, sf, "assets")).where(F.col("action") == assets.REUSE)
    rows = rows.select(ROW, "asset_id", F.col("cde_column_name").alias("column_name"))
    details = snapshots.asset_details(inputs.detail_documents(spark, sf))
    matched = cdes.match_columns(rows, details)
    return matched.withColumn("matched_classifications", joined("matched_classifications"))


# New and existing


@query
def domains_new(spark, sf):
    keys = {"business_domain_name": "name"}
    rows = lookup.not_in(load(spark, sf, "domain_file"), load(spark, sf, "domains"), keys)
    return rows.select(ROW, "business_domain_name")


@query
def domains_existing(spark, sf):
    keys = {"business_domain_name": "name"}
    rows = lookup.already_in(load(spark, sf, "domain_file"), load(spark, sf, "domains"), keys)
    return rows.select(ROW, "business_domain_name")


@query
def terms_new(spark, sf):
    rows = domains.domain_id(_deduped(spark, sf), load(spark, sf, "domains"), terms.DOMAIN, terms.DOMAIN_ID)
    keys = {terms.NAME: "name", terms.DOMAIN_ID: "domain"}
    return lookup.not_in(rows, load(spark, sf, "terms"), keys).select(ROW, terms.NAME, terms.DOMAIN_ID)


@query
def okrs_new(spark, sf):
    rows = domains.domain_id(load(spark, sf, "okr_file"), load(spark, sf, "domains"), "domain", "domain_id")
    keys = {"definition": "definition", "domain_id": "domain"}
    return lookup.not_in(rows, load(spark, sf, "okrs"), keys).select(ROW, "definition", "domain_id")


@query
def batch_repeats(spark, sf):
    file = load(spark, sf, "product_file")
    rows = domains.domain_id(file, load(spark, sf, "domains"), "business_domain_name", "domain_id")
    rows = dedupe.mark_repeats(rows, ["dp_name"], "repeat", F.col("domain_id").isNotNull())
    return rows.select(ROW, "dp_name", "repeat")


def _plan_cdes(spark, sf):
    return cdes.plan_cdes(*[load(spark, sf, n) for n in ("cde_file", "domains", "cdes", "users")])


@query
def cde_upsert(spark, sf):
    return _plan_cdes(spark, sf).select(ROW, "id", "name", "domain", "action", "error", "record")


@query
def asset_search(spark, sf):
    file = load(spark, sf, "asset_file")
    found = assets.search(file, load(spark, sf, "hits"), "data_asset_fqn", "data_asset_account")
    return found.select("qualifiedName", "account", "id", ROW)


@query
def asset_upsert(spark, sf):
    file = load(spark, sf, "asset_file")
    rows = assets.resolve_guids(file, load(spark, sf, "hits"), "data_asset_fqn", "data_asset_account")
    rows = assets.with_existing(rows, load(spark, sf, "assets"))
    return rows.select(ROW, "guid", "action", "asset_id", "description")


# Repeats and order


@query
def terms_dedup(spark, sf):
    return _deduped(spark, sf).select(ROW, terms.NAME, terms.DOMAIN, terms.PARENT)


@query
def terms_dedup_v1(spark, sf):
    return terms.first_by_name(load(spark, sf, "term_file"), load(spark, sf, "terms_by_name")).select(*_BY_NAME)


@query
def terms_sorted(spark, sf):
    rows = load(spark, sf, "term_file").select(ROW, terms.NAME, terms.PARENT)
    order = [F.col(terms.PARENT).desc_nulls_last(), F.col(ROW)]
    return ordering.positions(rows, order, "position")


@query
def reorder_by_list(spark, sf):
    rows = load(spark, sf, "term_file").select(ROW, terms.NAME)
    return ordering.reorder_by_list(rows, terms.NAME, load(spark, sf, "wanted"))


# Hierarchy


def _forest(spark, sf):
    return hierarchy.grow(_deduped(spark, sf), terms.NAME, terms.PARENT, terms.DOMAIN)


def _named(spark, sf, facts):
    names = _deduped(spark, sf).select(F.col(ROW).alias("_of"), terms.NAME, terms.DOMAIN)
    return names.join(facts, F.col("_of") == F.col(ROW), "left").drop("_of")


@query
def term_hierarchy(spark, sf):
    order = hierarchy.preorder(_forest(spark, sf))
    return _named(spark, sf, order).select(terms.NAME, terms.DOMAIN, "position")


@query
def term_levels(spark, sf):
    facts = _forest(spark, sf).nodes.where(F.col("status") == hierarchy.REACHED)
    order = [F.col("root_row"), F.col("depth"), F.col(ROW)]
    placed = ordering.positions(facts.select(ROW, "root_row", "depth"), order, "position")
    return placed.select(ROW, "root_row", "depth", "position")


@query
def term_parent_ids(spark, sf):
    rows = domains.domain_id(_deduped(spark, sf), load(spark, sf, "domains"), terms.DOMAIN, terms.DOMAIN_ID)
    statuses = _forest(spark, sf).nodes
    rows = terms.parent_ids(rows, load(spark, sf, "terms"), statuses)
    return rows.select(ROW, terms.NAME, terms.DOMAIN_ID, "parent_id", "parent_missing")


@query
def term_unreached(spark, sf):
    nodes = _forest(spark, sf).nodes
    return nodes.where(F.col("status") != hierarchy.REACHED).select(ROW, "status")


@query
def term_forest(spark, sf):
    """Terms of the catalog and new ones of the file, as one forest."""
    rows = domains.domain_id(_deduped(spark, sf), load(spark, sf, "domains"), terms.DOMAIN, terms.DOMAIN_ID)
    return terms.catalog_forest(rows, load(spark, sf, "terms"))


# Scalars


@query
def html_strip(spark, sf):
    rows = load(spark, sf, "html")
    return rows.select("kind", "key", text.strip_tags(F.col("body")).alias("body"))


@query
def html_wrap(spark, sf):
    return load(spark, sf, "html").select("kind", "key", text.wrap_div(F.col("body")).alias("body"))


@query
def fqn_table_parts(spark, sf):
    parts = text.table_path_parts(F.col("fqn"))
    return load(spark, sf, "paths").select("kind", "key", *[v.alias(k) for k, v in parts.items()])


@query
def fqn_path_parts(spark, sf):
    parts = text.storage_path_parts(F.col("fqn"))
    return load(spark, sf, "paths").select("kind", "key", *[v.alias(k) for k, v in parts.items()])


@query
def okr_target_date(spark, sf):
    rows = load(spark, sf, "okr_file")
    return rows.select(ROW, "targetDate", text.target_date_text(F.col("targetDate")).alias("target_date"))


# Assets


def _records(spark, sf, wanted=None):
    return assets.build_records(
        load(spark, sf, "all_assets") if wanted is None else wanted,
        inputs.entity_documents(spark, sf),
        inputs.schema_documents(spark, sf),
        inputs.lineage_documents(spark, sf),
        inputs.metastore_documents(spark, sf),
    )


def _documents_of(spark, sf, all_documents, *kinds):
    """Documents of some asset types, picked ahead of parsing."""
    wanted = load(spark, sf, "entities").where(F.col("asset_type").isin(*kinds))
    key = "schema_guid" if RESOURCE_SET in kinds else "guid"
    return lookup.already_in(all_documents, wanted, {"guid": key})


@query
def asset_schema(spark, sf):
    wanted = _documents_of(spark, sf, inputs.entity_documents(spark, sf), SQL_TABLE, LAKEHOUSE_TABLE)
    parsed = documents.parse_assets(wanted)
    columns, referred = F.col("entity.relationshipAttributes.columns"), F.col("referred")
    kind = F.col("entity.typeName")
    listed = F.when(kind == SQL_TABLE, documents.listed_columns(columns, referred, "data_type")).otherwise(
        documents.listed_columns(columns, referred, "dataType")
    )
    return parsed.select("guid", kind.alias("kind"), records.full_json_text(listed).alias("schema"))


@query
def asset_schema_files(spark, sf):
    wanted = _documents_of(spark, sf, inputs.schema_documents(spark, sf), RESOURCE_SET)
    listed = documents.referred_columns(F.col("referred"), "type")
    return documents.parse_assets(wanted).select("guid", records.full_json_text(listed).alias("schema"))


@query
def asset_metastore(spark, sf):
    rows = load(spark, sf, "entities").where(F.col("asset_type") == LAKEHOUSE_TABLE).select("guid")
    found = assets.with_metastore(
        rows, inputs.lineage_documents(spark, sf), inputs.metastore_documents(spark, sf)
    )
    return found.select("guid", "metastore_guid", "workspace_url")


@query
def asset_records(spark, sf):
    return _records(spark, sf).select(
        "guid",
        "asset_type",
        "name",
        "description_stripped",
        joined("classifications"),
        "type",
        "workspace_url",
        "outcome",
        "error",
        "record",
    )


# Plans


def _plan_domains(spark, sf):
    return domains.plan_domains(load(spark, sf, "domain_file"), load(spark, sf, "domains"))


@query
def plan_domains(spark, sf):
    return _plan_domains(spark, sf).select(ROW, "id", "name", "parent_id", "outcome", "record")


def _plan_terms(spark, sf):
    return terms.plan_terms(*[load(spark, sf, n) for n in ("term_file", "domains", "terms", "users")])


@query
def plan_terms(spark, sf):
    return _plan_terms(spark, sf)


def _plan_products(spark, sf):
    return products.plan_products(
        *[load(spark, sf, n) for n in ("product_file", "domains", "products", "users")]
    )


@query
def plan_products(spark, sf):
    return _plan_products(spark, sf).select(ROW, "id", "name", "domain", "outcome", "error", "record")


def _plan_okrs(spark, sf):
    return okrs.plan_okrs(*[load(spark, sf, n) for n in ("okr_file", "domains", "okrs", "users")])


@query
def plan_okrs(spark, sf):
    plan = _plan_okrs(spark, sf)
    return plan.select(ROW, "id", "definition", "domain", "outcome", "error", joined("unknown_owners"), "record")


def _plan_paths(spark, sf, paths, *parts, lines=None):
    return assets.plan_paths(
        paths,
        load(spark, sf, "hits"),
        load(spark, sf, "assets"),
        inputs.entity_documents(spark, sf, lines),
        inputs.schema_documents(spark, sf, lines),
        inputs.lineage_documents(spark, sf),
        inputs.metastore_documents(spark, sf),
        parts=parts,
    )


def _cde_paths(spark, sf):
    return load(spark, sf, "cde_file").select(ROW, F.col("cde_fqdn").alias("fqn"), F.lit(inputs.CDE_ACCOUNT).alias("account"))


def _asset_paths(spark, sf):
    return load(spark, sf, "asset_file").withColumnsRenamed({"data_asset_fqn": "fqn", "data_asset_account": "account"})


def _cde_columns(spark, sf, elements, planned_paths):
    details = snapshots.asset_details(inputs.detail_documents(spark, sf))
    return cdes.cde_columns(elements, assets.with_details(planned_paths, details))


@query
def cde_columns(spark, sf):
    return _cde_columns(spark, sf, _plan_cdes(spark, sf), _plan_paths(spark, sf, _cde_paths(spark, sf), assets.SCHEMA))


# Edges


def _edges(rows):
    return rows.select(*edges.EDGE, "outcome")


@query
def edges_synonym(spark, sf):
    return _edges(edges.synonym_edges(_resolved(spark, sf)))


@query
def edges_related(spark, sf):
    return _edges(edges.related_edges(_resolved(spark, sf)))


@query
def edges_product(spark, sf):
    rows = terms.with_product(_resolved(spark, sf), load(spark, sf, "products"))
    return _edges(edges.product_edges(rows))


@query
def edges_cde(spark, sf):
    paths = _plan_paths(spark, sf, _cde_paths(spark, sf), assets.SCHEMA)
    return edges.planned(edges.cde_edges(_cde_columns(spark, sf, _plan_cdes(spark, sf), paths)))


@query
def edges_asset(spark, sf):
    file = _asset_paths(spark, sf)
    planned = assets.plan_assets(file, _plan_paths(spark, sf, file))
    return _edges(edges.asset_edges(edges.with_products(planned, load(spark, sf, "products"))))


# Policies, outcomes, snapshots


@query
def policy_merge(spark, sf):
    return policies.merge_members(
        _loaded(spark, sf),
        load(spark, sf, "policies"),
        inputs.policy_documents(spark, sf),
        load(spark, sf, "users"),
    )


@query
def classify_outcomes(spark, sf):
    return outcomes.classify(load(spark, sf, "answers")).select("event_id", "operation", "code", "outcome")


def _main_outcomes(spark, sf):
    return [
        outcomes.outcomes(_plan_domains(spark, sf), "domain", "name"),
        outcomes.outcomes(_plan_products(spark, sf), "product", "name"),
        outcomes.outcomes_and_owners(_plan_okrs(spark, sf), "okr", "definition", "unknown_owners"),
    ]


@query
def load_report(spark, sf):
    return outcomes.report(*_main_outcomes(spark, sf))


def _planned_load(spark, sf):
    """File rows of assets and of elements with what becomes of them, the planned paths
    of the elements, and the lines documents are made of. A path of both files is planned
    once, from one reading of the documents; as several tables need the plans, they are
    staged, and so are the lines. Edges need no more of columns than their names."""
    lines = stage_table(inputs.line_pairs(spark, sf))
    file = _asset_paths(spark, sf)
    both = file.select(ROW, "fqn", "account").unionByName(_cde_paths(spark, sf))
    planned = stage_table(_plan_paths(spark, sf, both, assets.COLUMN_NAMES, lines=lines).drop("type"))
    elements = stage_table(_plan_cdes(spark, sf).drop("record", "dataType", "status"))
    planned_assets = stage_table(assets.plan_assets(file, planned))
    return planned_assets, elements, planned.where(F.col("account") == inputs.CDE_ACCOUNT), lines


def _edge_tables(spark, sf, planned_assets, elements, element_paths, lines):
    """Every kind of edge a load plans, with outcomes."""
    resolved = stage_table(_resolved(spark, sf))
    details = snapshots.asset_details(inputs.detail_documents(spark, sf, lines), facts=("name",))
    columns = cdes.cde_columns(elements, assets.with_details(element_paths, details), record=False)
    with_product = terms.with_product(resolved, load(spark, sf, "products"))
    return {
        "synonym": edges.synonym_edges(resolved),
        "related": edges.related_edges(resolved),
        "term_product": edges.product_edges(with_product),
        "element_column": edges.cde_edges(columns),
        "product_asset": edges.asset_edges(edges.with_products(planned_assets, load(spark, sf, "products"))),
    }


@query
def load_report_full(spark, sf):
    """All concepts of a load, the owners it doesn't know, and its edges."""
    terms_file = [load(spark, sf, n) for n in ("term_file", "domains", "terms", "users")]
    planned, elements, *paths_and_lines = _planned_load(spark, sf)
    tables = _edge_tables(spark, sf, planned, elements, *paths_and_lines)
    return outcomes.report(
        *_main_outcomes(spark, sf),
        outcomes.outcomes(terms.plan_terms(*terms_file), "term", "name"),
        outcomes.outcomes_and_owners(elements.withColumnRenamed("action", "outcome"), "cde", "name", "unknown_owners"),
        outcomes.outcomes(planned, "asset", "fqn"),
        *[t.withColumn("concept", F.lit(name)) for name, t in tables.items()],
    )


@query
def outcome_names(spark, sf):
    told = outcomes.outcomes(_plan_products(spark, sf), "product", "name")
    return outcomes.names(told, "product", outcomes.CREATED)


@query
def next_snapshot(spark, sf):
    catalog = load(spark, sf, "products").select("id", "name", "type")
    new = apply.created(_plan_products(spark, sf), {"id": "id", "name": "name", "type": "type"})
    return apply.next_snapshot(catalog, new, ["name"])


# The shape of each concept's list, from the columns of its plan.
_LISTED = {
    "domains": {"id": "id", "name": "name", "type": "type"},
    "terms": {"id": "id", "name": "name", "domain": "domain", "parent_id": "parentId"},
    "products": {"id": "id", "name": "name", "type": "type"},
    "okrs": {"id": "id", "definition": "definition", "status": "status", "domain": "domain"},
    "cdes": {"id": "id", "name": "name", "domain": "domain", "dataType": "dataType", "status": "status"},
}
_KEYS = {"domains": ["name"], "terms": ["name", "domain"], "products": ["name"], "okrs": ["definition", "domain"], "cdes": ["name", "domain"]}


def _listed(spark, sf, name):
    return load(spark, sf, name).select(*_LISTED[name].values())


def _inserted(spark, sf, name, plan, outcome=outcomes.CREATED):
    new = apply.created(plan, {ROW: ROW, **_LISTED[name]}, outcome)
    return apply.merge(_listed(spark, sf, name), _KEYS[name], new)


@query
def next_snapshot_domains(spark, sf):
    return _inserted(spark, sf, "domains", _plan_domains(spark, sf))


@query
def next_snapshot_terms(spark, sf):
    return _inserted(spark, sf, "terms", _plan_terms(spark, sf))


@query
def next_snapshot_okrs(spark, sf):
    return _inserted(spark, sf, "okrs", _plan_okrs(spark, sf))


@query
def next_snapshot_cdes(spark, sf):
    plan = _plan_cdes(spark, sf).withColumnRenamed("action", "outcome")
    return _inserted(spark, sf, "cdes", plan, cdes.CREATE)


@query
def next_snapshot_assets(spark, sf):
    columns = ["id", "name", "type", "dataMapAssetId", "description"]
    built = _plan_paths(spark, sf, _asset_paths(spark, sf)).where(F.col("outcome") == assets.CREATE)
    new = built.select(
        F.col("asset_id").alias("id"), F.col("asset_name").alias("name"), "type", F.col("guid").alias("dataMapAssetId"), "description", "fqn"
    )
    held = load(spark, sf, "assets").select(*columns)
    return apply.merge(held, ["id"], new, order=F.col("fqn")).select(*columns)


@query
def next_snapshot_edges(spark, sf):
    tables = _edge_tables(spark, sf, *_planned_load(spark, sf)).values()
    new = reduce(DataFrame.unionByName, [edges.planned(t) for t in tables])
    key = [c for c in edges.EDGE if c != "description"]
    return apply.merge(load(spark, sf, "edges"), key, new, order=F.col("description"))


@query
def next_snapshot_policies(spark, sf):
    changed = policies.merge_members(
        _loaded(spark, sf), load(spark, sf, "policies"), inputs.policy_documents(spark, sf), load(spark, sf, "users")
    )
    return apply.merge(inputs.policy_documents(spark, sf), ["id"], replaces=changed, order=F.col("document"))


@query
def published_load(spark, sf):
    """Products and objectives before a load, after it, and after the same load again,
    read back from a store that holds each as one version."""
    store = apply.Store(spark, f"{shared_folder(spark)}/store-{uuid.uuid4()}")
    plans = {
        "products": lambda held: products.plan_products(
            load(spark, sf, "product_file"), load(spark, sf, "domains"), held["products"], load(spark, sf, "users")
        ),
        "okrs": lambda held: okrs.plan_okrs(load(spark, sf, "okr_file"), load(spark, sf, "domains"), held["okrs"], load(spark, sf, "users")),
    }
    store.publish({name: _listed(spark, sf, name) for name in plans})
    for _ in range(2):
        held = {name: store.read(name) for name in plans}
        numbered = {name: rows.withColumn(ROW, F.col("id")) for name, rows in held.items()}
        after = {}
        for name, plan in plans.items():
            new = apply.created(plan(numbered), {ROW: ROW, **_LISTED[name]})
            after[name] = apply.merge(held[name], _KEYS[name], new)
        store.publish(after)
    parts = [
        store.read(name, version).select(F.lit(version).alias("version"), F.lit(name).alias("concept"), "id", F.col(_KEYS[name][0]).alias("name"))
        for version in store.versions()
        for name in plans
    ]
    return reduce(DataFrame.unionByName, parts)


# Answers to a load


def _reconciled(spark, sf):
    return outcomes.reconcile(_plan_terms(spark, sf), load(spark, sf, "term_answers"), ["name", "domain"])


@query
def answers_reconciled(spark, sf):
    return _reconciled(spark, sf)


@query
def next_snapshot_confirmed(spark, sf):
    plan = stage(_plan_terms(spark, sf))
    told = outcomes.reconcile(plan, load(spark, sf, "term_answers"), ["name", "domain"])
    return _inserted(spark, sf, "terms", outcomes.confirmed(plan, told))


@query
def edges_released(spark, sf):
    resolved = _resolved(spark, sf)
    planned = edges.synonym_edges(resolved).unionByName(edges.related_edges(resolved))
    return _edges(outcomes.release(planned, _reconciled(spark, sf)))
