"""Input contracts: concept files, catalog lists and nested documents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class ConceptFile:
    """Columns of one kind of concept file; every column is text."""

    required: tuple[str, ...]
    # Added as null when a file lacks them.
    optional: tuple[str, ...] = ()
    # Kept when a file has them, otherwise worked out by the load.
    derived: tuple[str, ...] = ()


# The column names of the concept files.
CONCEPT_FILES = {
    "business_domains": ConceptFile(
        required=(
            "business_domain_name",
            "business_domain_parent",
            "business_domain_email_owners",
            "business_domain_status",
            "business_domain_type",
            "business_domain_description",
        ),
        derived=("business_domain_parent_guid",),
    ),
    "glossary_terms": ConceptFile(
        required=(
            "glossary_term_name",
            "business_domain_name",
            "glossary_term_parent_term",
            "glossary_term_description",
            "glossary_term_status",
            "glossary_term_owner",
            "glossary_term_expert",
            "glossary_term_database_admin",
            "glossary_term_acronyms",
            "glossary_term_synonyms",
            "glossary_term_related",
        ),
        optional=(
            "glossary_term_synonyms_domain",
            "glossary_term_related_domain",
            "glossary_term_data_product",
        ),
    ),
    "data_product": ConceptFile(
        required=(
            "dp_name",
            "business_domain_name",
            "dp_status",
            "dp_type",
            "dp_description",
            "dp_businessUse",
            "dp_owners",
            "dp_updateFrequency",
        ),
    ),
    "data_assets": ConceptFile(
        required=("dp_name", "data_asset_fqn", "data_asset_account"),
    ),
    "okr": ConceptFile(
        required=("definition", "domain", "targetDate", "owner", "status"),
    ),
    "cde": ConceptFile(
        required=(
            "cde_name",
            "business_domain_name",
            "cde_dataType",
            "cde_owner",
            "cde_description",
            "cde_status",
            "cde_fqdn",
            "cde_column_name",
        ),
    ),
}

# A file may spell a column with the catalog product's name inside it.
COLUMN_SPELLINGS = {"data_asset_account": r"data_asset_\w+_account"}


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TEXT = T.StringType()


def _texts(*names: str) -> T.StructType:
    return _struct(**{name: TEXT for name in names})


# One object of a catalog list. Nested parts are read as text: a text field
# keeps the JSON of whatever lies under the key.
CATALOG_LISTS = {
    "domains": _texts("id", "name", "type", "domains"),
    "data_assets": _texts("id", "name", "type", "domains"),
    "data_products": _texts("id", "name", "type", "domains"),
    "terms": _texts("id", "name", "domain", "parentId"),
    "terms_full": _texts("id", "name", "domain", "description", "contacts", "status"),
    "cdes": _texts("name", "domain", "dataType", "status", "id"),
    "okrs": _texts("id", "definition", "status", "domain"),
    "search_hits": _texts("id", "qualifiedName", "objectType", "account"),
    "policies": _texts("id", "name"),
    "users": _texts("mail", "id"),
}

ASSET_COLUMN = _struct(
    name=TEXT,
    description=TEXT,
    classifications=T.ArrayType(TEXT),
    type=TEXT,
)

_CLASSIFICATIONS = T.ArrayType(_texts("typeName"))
_GUIDS = T.ArrayType(_texts("guid"))

ENTITY = _struct(
    typeName=TEXT,
    attributes=_texts("displayName", "name", "userDescription"),
    classifications=_CLASSIFICATIONS,
    relationshipAttributes=_struct(
        columns=_GUIDS,
        attachedSchema=_GUIDS,
        workspaces=T.ArrayType(_texts("displayText")),
    ),
)
REFERRED_ENTITY = _struct(
    attributes=_texts("name", "data_type", "dataType", "type", "userDescription"),
    classifications=_CLASSIFICATIONS,
)


def asset_details(facts: tuple[str, ...]) -> T.StructType:
    """Details of a catalog asset, with these facts of its columns."""
    column = T.StructType([field for field in ASSET_COLUMN if field.name in facts])
    return _struct(id=TEXT, name=TEXT, schema=T.ArrayType(column))


def asset_document(facts: tuple[str, ...]) -> T.StructType:
    """An asset's document, with what these facts of columns take from referred entities."""
    attributes = {"name": ("name",), "description": ("userDescription",), "type": ("data_type", "dataType", "type")}
    wanted = {name for fact in facts for name in attributes.get(fact, ())}
    known = REFERRED_ENTITY["attributes"].dataType
    parts = {"attributes": T.StructType([field for field in known if field.name in wanted])}
    if "classifications" in facts:
        parts["classifications"] = _CLASSIFICATIONS
    return _struct(entities=T.ArrayType(ENTITY), referredEntities=T.MapType(TEXT, _struct(**parts)))


LINEAGE_DOCUMENT = _struct(guidEntityMap=T.MapType(TEXT, _texts("guid", "typeName")))

# Asset types the loader can build a record for.
SQL_TABLE = "azure_sql_table"
RESOURCE_SET = "azure_datalake_gen2_resource_set"
LAKEHOUSE_TABLE = "databricks_table"
REPORT = "powerbi_report"
METASTORE = "databricks_metastore"

# Policy name prefixes, put before the domain id.
DOMAIN_POLICY = "dgpolicy_businessdomain_"
QUALITY_POLICY = "dgpolicy_dgdataqualityscope_"

# Fixed value: object type the asset search leaves out.
TERM_OBJECT = "Glossary terms"
