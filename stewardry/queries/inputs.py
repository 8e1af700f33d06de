"""Load inputs derived from the driver's tables.

Each flat input is a union of selects whose expressions mean the same in Spark
SQL and in DuckDB, so both sides start from equal rows; everything after that is
written twice. Documents are built here with Spark from the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stewardry.schemas import (
    DOMAIN_POLICY,
    LAKEHOUSE_TABLE,
    METASTORE,
    QUALITY_POLICY,
    REPORT,
    RESOURCE_SET,
    SQL_TABLE,
)


@dataclass(frozen=True)
class Branch:
    table: str
    columns: dict[str, str]
    where: str = "true"
    distinct: bool = False


def text(number: str) -> str:
    return f"cast({number} as string)"


def whole(number: str) -> str:
    return f"cast(floor({number}) as bigint)"


def numbered(prefix: str, number: str) -> str:
    return f"('{prefix}#' || lpad({text(number)}, 9, '0'))"


def mail(number: str) -> str:
    return f"({numbered('Supplier', number)} || '@example.org')"


# Keys of each table that share an owner: half as many owners again as there are
# people, so that the pool grows with the tables and some stay unknown.
PER_OWNER = {"c_custkey": 10, "o_orderkey": 400, "p_partkey": 13}


def owner_cell(key: str) -> str:
    """One, two or three addresses: with a blank, an empty part, a repeat,
    unknown people, or nothing at all."""
    per = PER_OWNER[key.split(" ")[0]]
    a, b = mail(whole(f"({key}) / {per}")), mail(whole(f"({key}) / {3 * per}"))
    return (
        f"CASE ({key}) % 6 WHEN 0 THEN {a} WHEN 1 THEN {a} || ',' || {b} "
        f"WHEN 2 THEN {a} || ', ' || {b} WHEN 3 THEN {a} || ',,' || {b} "
        f"WHEN 5 THEN {a} || ',' || {b} || ',' || {a} END"
    )


def only_some(condition: str, name: str) -> str:
    """A name that the files use where ``condition`` holds, and elsewhere one
    that they don't, so that a catalog is scanned whole and still lacks some."""
    return f"CASE WHEN {condition} THEN {name} ELSE 'Only here ' || {name} END"


def fqn(key: str) -> str:
    k = text(key)
    return (
        f"CASE ({key}) % 5 "
        f"WHEN 0 THEN CASE WHEN ({key}) % 35 = 0 THEN 'short/o' || {k} "
        f"ELSE 'mssql://srv' || {text(f'({key}) % 50')} || '/db' || {text(f'({key}) % 9')} || '/dbo/o' || {k} END "
        f"WHEN 1 THEN 'https://acct' || {text(f'({key}) % 20')} || '.dfs.example.net/box' || {text(f'({key}) % 6')} "
        f"|| '/raw/o' || {k} || '/{{part}}.csv' "
        f"WHEN 2 THEN 'databricks://ws/catalogs/main/schemas/s' || {text(f'({key}) % 12')} || '/tables/o' || {k} "
        f"WHEN 3 THEN 'https://bi.example.net/groups/g' || {text(f'({key}) % 30')} || '/reports/o' || {k} "
        f"ELSE 'hive://h/o' || {k} END"
    )


NO_TEXT = "cast(null as string)"
# Row keys of tables whose one file is worth more than one task.
KEYS = {"orders": "o_orderkey"}
K, O, P, S = "c_custkey", "o_orderkey", "p_partkey", "s_suppkey"
CUSTOMER_NAME = numbered("Customer", "o_custkey")
# Domains of orders: those of customers, of whom some are in the catalog, and brands.
_OF_CUSTOMER = "o_custkey % 4 = 0"
ORDER_DOMAIN = f"CASE WHEN {_OF_CUSTOMER} THEN {numbered('Customer', 'o_custkey')} ELSE 'Brand#' || {text('o_custkey % 26')} END"
ORDER_DOMAIN_ID = f"'dom-' || CASE WHEN {_OF_CUSTOMER} THEN {text('o_custkey')} ELSE 'Brand#' || {text('o_custkey % 26')} END"
BILLION = 1_000_000_000
# Bytes of list documents that one task takes.
PAGE_TASK_BYTES = 20_000
# Element files name no account; a load of them has one.
CDE_ACCOUNT = "acct-0"


def _tree(domain: str, name: str = "c_name") -> dict[str, str]:
    return {
        "glossary_term_name": name,
        "business_domain_name": f"'{domain}'",
        "glossary_term_parent_term": (
            f"CASE WHEN {K} < 10 THEN null WHEN {K} = 20 THEN {numbered('Customer', '21')} "
            f"WHEN {K} = 21 THEN {numbered('Customer', '20')} WHEN {K} % 97 = 0 THEN 'No such term' "
            f"ELSE {numbered('Customer', whole(f'{K} / 4'))} END"
        ),
        "glossary_term_description": "'About \"' || c_name || '\"' || chr(10) || '<b>' || c_mktsegment || '</b>'",
        "glossary_term_status": f"CASE WHEN {K} % 2 = 0 THEN 'Draft' ELSE 'Published' END",
        "glossary_term_owner": owner_cell(K),
        "glossary_term_expert": owner_cell(f"{K} + 1"),
        "glossary_term_database_admin": owner_cell(f"{K} + 2"),
        "glossary_term_acronyms": f"CASE WHEN {K} % 4 <> 0 THEN 'A' || {text(K)} END",
        "glossary_term_synonyms": f"CASE WHEN {K} % 5 <> 0 THEN {numbered('Customer', whole(f'{K} / 2'))} END",
        "glossary_term_synonyms_domain": f"CASE WHEN {K} % 3 = 0 THEN 'Brand#1' ELSE 'Brand#2' END",
        "glossary_term_related": f"CASE WHEN {K} % 6 <> 0 THEN {numbered('Customer', whole(f'{K} / 3'))} END",
        "glossary_term_related_domain": f"CASE WHEN {K} % 4 = 0 THEN 'Nowhere' ELSE 'Brand#1' END",
        "glossary_term_data_product": f"CASE WHEN {K} % 7 <> 0 THEN {numbered('Supplier', f'{K} % 150')} END",
    }


def _policy(prefix: str, of_domain: str) -> str:
    """A policy's name: some are of domains that are gone."""
    return f"'{prefix}' || CASE WHEN {of_domain} THEN 'dom-' ELSE 'gone-' END || {text(K)}"


INPUTS: dict[str, list[Branch]] = {
    "domains": [
        Branch("customer", {"id": f"'dom-' || {text(K)}", "name": only_some(f"{K} % 3 = 0", "c_name"), "type": "'FunctionalUnit'", "_row": K}),
        Branch(
            "customer",
            {"id": f"'dom-dup-' || {text(K)}", "name": "c_name", "type": "'LineOfBusiness'", "_row": f"{BILLION} + {K}"},
            f"{K} % 30 = 0",
        ),
        Branch(
            "part",
            {
                "id": "'dom-' || p_brand",
                "name": only_some("p_brand <> 'Brand#13'", "p_brand"),
                "type": "'DataDomain'",
                "_row": f"{2 * BILLION} + cast(substr(p_brand, 7) as bigint)",
            },
            distinct=True,
        ),
    ],
    "domain_file": [
        Branch(
            "orders",
            {
                "business_domain_name": CUSTOMER_NAME,
                "business_domain_parent": (
                    f"CASE WHEN {O} % 11 = 0 THEN null WHEN {O} % 7 = 0 THEN 'No such domain' "
                    # Its own parent, two that are each other's, and a chain of neighbours.
                    f"WHEN {O} % 13 = 0 THEN {CUSTOMER_NAME} WHEN o_custkey = 20 THEN {numbered('Customer', '21')} "
                    f"WHEN o_custkey = 21 THEN {numbered('Customer', '20')} "
                    f"WHEN o_custkey % 3 = 2 THEN {numbered('Customer', 'o_custkey - 1')} "
                    f"ELSE {numbered('Customer', whole('o_custkey / 4'))} END"
                ),
                "business_domain_email_owners": owner_cell(O),
                "business_domain_status": "o_orderstatus",
                "business_domain_type": "o_orderpriority",
                "business_domain_description": "'Area \"' || o_orderpriority || '\"'",
                "_row": O,
            },
        )
    ],
    "users": [
        Branch("supplier", {"mail": "s_name || '@example.org'", "id": "md5(s_name)", "_row": S}),
        Branch(
            "supplier",
            {"mail": "s_name || '@example.org'", "id": "md5(s_name || '-2')", "_row": f"{BILLION} + {S}"},
            f"{S} % 10 = 0",
        ),
    ],
    "term_file": [
        Branch("customer", {**_tree("Brand#1"), "_row": K}),
        Branch("customer", {**_tree("Brand#2", only_some(f"{K} % 5 <> 0", "c_name")), "_row": f"{BILLION} + {K}"}),
        Branch(
            "part",
            {
                "glossary_term_name": "p_name",
                "business_domain_name": "p_brand",
                "glossary_term_parent_term": f"CASE WHEN p_type = 'ECONOMY' AND {P} % 2 = 0 THEN null ELSE p_type END",
                "glossary_term_description": "'A ' || p_name",
                "glossary_term_status": "'Draft'",
                "glossary_term_owner": owner_cell(P),
                "glossary_term_expert": NO_TEXT,
                "glossary_term_database_admin": NO_TEXT,
                "glossary_term_acronyms": NO_TEXT,
                "glossary_term_synonyms": NO_TEXT,
                "glossary_term_synonyms_domain": NO_TEXT,
                "glossary_term_related": NO_TEXT,
                "glossary_term_related_domain": NO_TEXT,
                "glossary_term_data_product": NO_TEXT,
                "_row": f"{2 * BILLION} + {P}",
            },
        ),
    ],
    "terms": [
        Branch(
            "customer",
            {
                "id": f"'trm-1-' || {text(K)}",
                "name": only_some(f"{K} % 3 = 0", "c_name"),
                "domain": "'dom-Brand#1'",
                "parentId": f"CASE WHEN {K} >= 10 THEN 'trm-1-' || {text(whole(f'{K} / 4'))} END",
                "_row": K,
            },
        ),
        Branch(
            "customer",
            {
                "id": f"'trm-2-' || {text(K)}",
                "name": only_some(f"{K} % 6 = 0", "c_name"),
                "domain": "'dom-Brand#2'",
                "parentId": NO_TEXT,
                "_row": f"{BILLION} + {K}",
            },
        ),
        Branch(
            "part",
            {
                "id": f"'trm-p-' || {text(P)}",
                "name": only_some(f"{P} % 3 = 0", "p_name"),
                "domain": "'dom-' || p_brand",
                "parentId": NO_TEXT,
                "_row": f"{2 * BILLION} + {P}",
            },
        ),
    ],
    "terms_by_name": [
        Branch("customer", {"ID": f"'trm-1-' || {text(K)}", "Name": only_some(f"{K} % 3 = 0", "c_name")}),
        Branch("customer", {"ID": f"'trm-2-' || {text(K)}", "Name": only_some(f"{K} % 6 = 0", "c_name")}),
    ],
    "products": [
        Branch("supplier", {"id": f"'dp-' || {text(S)}", "name": "s_name", "type": "'Dataset'", "_row": S}),
        Branch("supplier", {"id": f"'dp-dup-' || {text(S)}", "name": "s_name", "type": "'Dataset'", "_row": f"{BILLION} + {S}"}, f"{S} % 25 = 0"),
    ],
    "product_file": [
        Branch(
            "part",
            {
                "dp_name": f"CASE WHEN {P} % 4 = 0 THEN {numbered('Supplier', f'{P} % 300')} ELSE 'Product ' || {text(whole(f'{P} / 3'))} END",
                "business_domain_name": "p_brand",
                "dp_status": "'Draft'",
                "dp_type": "p_type",
                "dp_description": "'The \"' || p_name || '\"'",
                "dp_businessUse": f"CASE WHEN {P} % 3 = 0 THEN null ELSE p_name END",
                "dp_owners": owner_cell(P),
                "dp_updateFrequency": f"CASE WHEN {P} % 2 = 0 THEN 'Daily' ELSE 'Weekly' END",
                "_row": P,
            },
        )
    ],
    "okr_file": [
        Branch(
            "orders",
            {
                "definition": f"o_orderpriority || '-' || {text(f'{O} - {O} % 3')}",
                "domain": ORDER_DOMAIN,
                "targetDate": (
                    f"CASE WHEN {O} % 100 = 50 THEN '13-45-2020' WHEN {O} % 100 = 0 THEN 'soon' "
                    f"WHEN {O} % 3 = 0 THEN {text('month(o_orderdate)')} || '-' || {text('day(o_orderdate)')} || '-' || {text('year(o_orderdate)')} "
                    f"ELSE lpad({text('month(o_orderdate)')}, 2, '0') || '-' || lpad({text('day(o_orderdate)')}, 2, '0') || '-' || {text('year(o_orderdate)')} END"
                ),
                "owner": owner_cell(O),
                "status": "o_orderstatus",
                "_row": O,
            },
        )
    ],
    "okrs": [
        Branch(
            "orders",
            {
                "id": f"'okr-' || {text(O)}",
                "definition": only_some(f"{O} % 4 = 0", f"o_orderpriority || '-' || {text(f'{O} - {O} % 3')}"),
                "status": "o_orderstatus",
                "domain": ORDER_DOMAIN_ID,
                "_row": O,
            },
        )
    ],
    "cde_file": [
        Branch(
            "orders",
            {
                "cde_name": f"'Element ' || {text(whole(f'{O} / 2'))}",
                "business_domain_name": ORDER_DOMAIN,
                "cde_dataType": "'Text'",
                "cde_owner": owner_cell(f"{O} + 3"),
                "cde_description": "'About ' || o_orderpriority",
                "cde_status": "o_orderstatus",
                "cde_fqdn": f"CASE WHEN {O} % 9 = 0 THEN 'mssql://nowhere' ELSE {fqn(O)} END",
                "cde_column_name": f"CASE WHEN {O} % 2 = 0 THEN 'COL_' ELSE 'col_' END || {text(f'{O} % 7 + 1')}",
                "_row": O,
            },
        )
    ],
    "cdes": [
        Branch(
            "orders",
            {
                "name": only_some(f"{O} % 6 = 0", f"'Element ' || {text(whole(f'{O} / 2'))}"),
                "domain": ORDER_DOMAIN_ID,
                "dataType": "'Text'",
                "status": "o_orderstatus",
                "id": f"'cde-' || {text(O)}",
                "_row": O,
            },
        )
    ],
    "hits": [
        Branch(
            "orders",
            {
                "id": f"'g-' || {text(O)}",
                "qualifiedName": fqn(O),
                "objectType": f"CASE WHEN {O} % 13 = 0 THEN 'Glossary terms' WHEN {O} % 17 = 0 THEN null ELSE 'Tables' END",
                "account": f"'acct-' || {text(f'{O} % 3')}",
                "_row": O,
            },
        ),
        Branch(
            "orders",
            {
                "id": f"'g-dup-' || {text(O)}",
                "qualifiedName": fqn(O),
                "objectType": "'Tables'",
                "account": f"'acct-' || {text(f'{O} % 3')}",
                "_row": f"{BILLION} + {O}",
            },
            f"{O} % 8 = 0",
        ),
        # The same path in another account is another asset of the same kind.
        Branch(
            "orders",
            {
                "id": f"'g-' || {text(f'{O} + 35')}",
                "qualifiedName": fqn(O),
                "objectType": "'Tables'",
                "account": f"'acct-' || {text(f'({O} + 1) % 3')}",
                "_row": f"{2 * BILLION} + {O}",
            },
            f"{O} % 2 = 0",
        ),
    ],
    "assets": [
        Branch(
            "orders",
            {
                "id": f"'ast-' || {text(O)}",
                "name": f"'Order ' || {text(O)}",
                "type": "'General'",
                "dataMapAssetId": only_some(f"{O} % 4 = 1", f"'g-' || {text(O)}"),
                "description": f"CASE WHEN {O} % 8 = 1 THEN null ELSE 'kept ' || {text(O)} END",
                "_row": O,
            },
        )
    ],
    "asset_file": [
        Branch(
            "orders",
            {
                "dp_name": numbered("Supplier", f"{O} % 150"),
                "data_asset_fqn": f"CASE WHEN {O} % 41 = 0 THEN 'mssql://nowhere' WHEN {O} % 4 = 0 THEN {fqn(f'{O} - {O} % 3')} ELSE {fqn(O)} END",
                "data_asset_account": f"'acct-' || {text(f'{O} % 3')}",
                "_row": O,
            },
        )
    ],
    "policies": [
        Branch("customer", {"id": f"'pol-d-' || {text(K)}", "name": _policy(DOMAIN_POLICY, f"{K} % 3 = 0 AND {K} % 9 <> 0")}),
        Branch("customer", {"id": f"'pol-q-' || {text(K)}", "name": _policy(QUALITY_POLICY, f"{K} % 6 = 0")}),
    ],
    "answers": [
        Branch(
            "events",
            {
                "event_id": "event_id",
                "operation": (
                    "CASE event_id % 7 WHEN 0 THEN 'domain' WHEN 1 THEN 'term' WHEN 2 THEN 'synonym' WHEN 3 THEN 'related' "
                    "WHEN 4 THEN 'term_product' WHEN 5 THEN 'product' ELSE 'okr' END"
                ),
                "code": (
                    "CASE event_type WHEN 'view' THEN 200 WHEN 'signup' THEN 201 WHEN 'purchase' THEN 400 "
                    "WHEN 'click' THEN 409 ELSE 500 END"
                ),
                "text": (
                    "CASE event_id % 3 WHEN 0 THEN 'Error converting value ' || props || ' at entityId' "
                    "WHEN 1 THEN 'Error converting value' ELSE props END"
                ),
                "status": "CASE WHEN event_id % 5 < 3 THEN 'Draft' END",
                "type": "CASE WHEN event_id % 5 < 2 THEN 'Dataset' END",
                "id": "CASE WHEN event_id % 5 < 1 THEN 'x' END",
            },
        )
    ],
}

# Cells of all types, and columns whose cells disagree.
INPUTS["typed_file"] = [
    Branch(
        "orders",
        {
            "_row": O,
            "whole": text(O),
            "number": f"CASE WHEN {O} % 5 = 0 THEN {text(O)} ELSE {text(O)} || '.25' END",
            "day": "cast(cast(o_orderdate as date) as string)",
            "moment": f"cast(cast(o_orderdate as date) as string) || CASE WHEN {O} % 3 = 0 THEN '' ELSE ' 10:20:30' END",
            "flag": f"CASE WHEN {O} % 7 = 0 THEN null WHEN {O} % 2 = 0 THEN 'TRUE' ELSE 'false' END",
            "mixed": f"CASE WHEN {O} % 1000 = 999 THEN 'n/a' WHEN {O} % 400 = 399 THEN 'true' ELSE {text(O)} END",
            "word_first": f"CASE WHEN {O} = 0 THEN 'none' ELSE {text(O)} END",
            "nothing": NO_TEXT,
            "no_day": f"CASE WHEN {O} % 900 = 899 THEN '2020-13-45' ELSE '2020-01-31' END",
        },
    )
]
# Edges the catalog holds already; some of them are planned again.
INPUTS["edges"] = [
    Branch(
        "customer",
        {
            "source_id": f"'trm-1-' || {text(K)}",
            "target_id": f"'trm-1-' || {text(whole(f'{K} / 2'))}",
            "entity_type": "'Term'",
            "relationship_type": "'Synonym'",
            "description": "'held'",
        },
    )
]
# Several answers to a term's creation, some to terms that no file names.
INPUTS["term_answers"] = [
    Branch(
        "events",
        {
            "_row": "event_id",
            "name": f"CASE WHEN {whole('event_id / 6')} % 10 = 0 THEN 'Never asked ' || {text('event_id')} ELSE {numbered('Customer', whole('event_id / 6'))} END",
            "domain": "CASE WHEN event_id % 2 = 0 THEN 'dom-Brand#1' ELSE 'dom-Brand#2' END",
            "operation": "'term'",
            "code": INPUTS["answers"][0].columns["code"],
            "text": "props",
            "status": NO_TEXT,
            "type": NO_TEXT,
            "id": NO_TEXT,
        },
    )
]
# A list of names to put rows in order by; some names are listed twice.
INPUTS["wanted"] = [
    Branch("customer", {"position": f"{BILLION} - {K}", "key": "c_name"}, f"{K} % 2 = 0"),
    Branch("customer", {"position": f"{2 * BILLION} - {K}", "key": "c_name"}, f"{K} % 10 = 0"),
    Branch("customer", {"position": f"{3 * BILLION} - {K}", "key": "'Not there ' || c_name"}, f"{K} % 20 = 0"),
]
# Paths of every asset, and page addresses with their odd shapes.
INPUTS["paths"] = [
    Branch("orders", {"kind": "'asset'", "key": O, "fqn": fqn(O)}),
    Branch("pages", {"kind": "'page'", "key": "page_id", "fqn": "url"}),
]
INPUTS["html"] = [
    Branch("pages", {"kind": "'page'", "key": "page_id", "body": "html"}),
    Branch("documents", {"kind": "'document'", "key": "doc_id", "body": "text"}),
    Branch("pages", {"kind": "'no text'", "key": "page_id", "body": NO_TEXT}),
]
INPUTS["all_assets"] = [
    Branch("orders", {"_row": O, "guid": f"'g-' || {text(O)}", "fqn": fqn(O), "account": f"'acct-' || {text(f'{O} % 3')}"}),
]
INPUTS["wanted_domains"] = [Branch("part", {"domain": "'dom-' || p_brand"}, "p_size <= 3")]

ASSET_TYPE = (
    f"CASE {O} % 5 WHEN 0 THEN '{SQL_TABLE}' WHEN 1 THEN '{RESOURCE_SET}' WHEN 2 THEN '{LAKEHOUSE_TABLE}' "
    f"WHEN 3 THEN '{REPORT}' ELSE 'hive_table' END"
)
# What the documents say, by asset; some are of assets that no path leads to, and
# leave one without a document.
INPUTS["entities"] = [
    Branch(
        "orders",
        {
            "guid": f"CASE WHEN {O} % 29 <> 0 THEN 'g-' ELSE 'gone-' END || {text(O)}",
            "asset_key": O,
            "asset_type": ASSET_TYPE,
            "display_name": f"'Order ' || {text(O)}",
            "short_name": f"'o' || {text(O)}",
            "user_description": f"CASE WHEN {O} % 3 = 0 THEN null ELSE '<div>Order <b>' || {text(O)} || '</b></div>' END",
            "classification": f"CASE WHEN {O} % 2 = 0 THEN 'C' || {text(f'{O} % 3')} END",
            "schema_guid": f"CASE WHEN {O} % 5 = 1 AND {O} % 31 <> 0 THEN 's-' || {text(O)} END",
        },
    )
]
# Stores an asset's lineage names, first to last; the last one counts.
INPUTS["lineages"] = [
    Branch(
        "orders",
        {
            "guid": f"CASE WHEN {O} % 5 = 2 OR {O} % 2 = 0 THEN 'g-' ELSE 'lone-' END || {text(O)}",
            "first_store": f"CASE WHEN {O} % 5 = 2 AND {O} % 4 > 1 THEN 'm-' || {text(f'{O} % 7')} END",
            "last_store": f"CASE WHEN {O} % 5 = 2 AND {O} % 4 > 0 THEN 'm-' || {text(f'{O} % 120')} END",
        },
    )
]
INPUTS["metastores"] = [
    Branch(
        "supplier",
        {"guid": f"'m-' || {text(S)}", "workspace": f"CASE WHEN {S} % 9 <> 0 THEN 'https://ws' || {text(S)} || '.example.net' END"},
    )
]
# Columns of an asset: one per line number of its order.
COLUMN_FACTS = {
    "column_guid": "'c-' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string)",
    "column_name": "'col_' || cast(l_linenumber as string)",
    "data_type": "CASE WHEN min(l_linestatus) = 'O' THEN 'varchar' ELSE 'int' END",
    "flag": "min(l_returnflag)",
    "column_description": "CASE WHEN l_linenumber % 2 = 0 THEN null ELSE 'Line ' || cast(l_linenumber as string) END",
    "is_referred": "(l_orderkey + l_linenumber) % 8 <> 0",
}


# Plans of inputs are kept per session: several queries start from the same one.
_kept = lru_cache(maxsize=256)


@_kept
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; the schema is read once per session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_kept
def _spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = table(spark, sf_dir, name)
    return rows.repartition(F.col(KEYS[name])) if name in KEYS else rows


@_kept
def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A flat input as a DataFrame."""
    parts = []
    for branch in INPUTS[name]:
        rows = _spread_table(spark, sf_dir, branch.table).where(branch.where)
        rows = rows.selectExpr(*[f"{e} AS `{c}`" for c, e in branch.columns.items()])
        parts.append(rows.distinct() if branch.distinct else rows)
    return reduce(DataFrame.unionByName, parts)


def as_sql(name: str) -> str:
    """The same input as SQL for DuckDB."""
    selects = []
    for branch in INPUTS[name]:
        columns = ", ".join(f'{e} AS "{c}"' for c, e in branch.columns.items())
        word = "SELECT DISTINCT" if branch.distinct else "SELECT"
        selects.append(f"{word} {columns} FROM {branch.table} WHERE {branch.where}")
    return " UNION ALL ".join(selects)


def _first_of_lines(one: str) -> Column:
    """Of a sorted array column, the first element of every line."""
    return F.filter(one, lambda x, i: (i == 0) | ~x["line"].eqNullSafe(F.get(F.col(one), i - 1)["line"]))


@_kept
def line_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``l_orderkey, _pairs``: an array of the line and the two values its facts come from.

    One exchange of narrow rows by order, which repeated lines leave once per map task.
    """
    found = F.struct(
        F.col("l_linenumber").alias("line"), F.col("l_linestatus").alias("status"), F.col("l_returnflag").alias("flag")
    )
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set(found).alias("_found"))
    # The least of each that is not null, as min() has it. No element is null, so that
    # sort_array gives what array_sort does, without a comparison made of expressions.
    least = lambda name: F.sort_array(
        F.transform("_found", lambda x: F.struct(x["line"].alias("line"), x[name].isNull().alias("none"), x[name].alias("value")))
    )
    lines = F.transform("_found", lambda x: x["line"])
    # Lines that came once, as they are; else each line once, in which both least values meet.
    once = F.size(F.array_distinct(lines)) == F.size("_found")
    nothing = F.lit(None)
    rows = rows.select(
        "l_orderkey",
        F.when(once, F.sort_array("_found")).alias("_once"),
        F.when(once, nothing).otherwise(least("status")).alias("_status"),
        F.when(once, nothing).otherwise(least("flag")).alias("_flag"),
    )
    pairs = F.zip_with(
        _first_of_lines("_status"),
        _first_of_lines("_flag"),
        lambda a, b: F.struct(a["line"].alias("line"), a["value"].alias("status"), b["value"].alias("flag")),
    )
    return rows.select("l_orderkey", F.coalesce("_once", pairs).alias("_pairs"))


def _pairs_by_order(spark: SparkSession, sf_dir: str, staged: DataFrame | None) -> DataFrame:
    """Rows of :func:`line_pairs`, by order, so that joins by order need no other exchange.

    ``staged`` has them for a query that reads lines several times; they are dealt by
    order again before anything is made of them.
    """
    return line_pairs(spark, sf_dir) if staged is None else staged.repartition("l_orderkey")


def _by_pair(made: dict[str, str], pairs: str = "_pairs") -> Column:
    """``made`` of every pair, as expressions over :data:`COLUMN_FACTS`: what isn't asked
    for isn't made, and no row between lies in memory."""
    return F.expr(f"transform({pairs}, one -> {_struct_sql(made)})")


def _struct_sql(made: dict[str, str]) -> str:
    return f"named_struct({', '.join(f"'{c}', {e}" for c, e in made.items())})"


# The column facts over one pair, and the classes of its flag.
_PAIR = {"min(l_linestatus)": "one.status", "min(l_returnflag)": "one.flag", "l_linenumber": "one.line"}
FACT = {c: f"({reduce(lambda e, n: e.replace(*n), _PAIR.items(), e)})" for c, e in COLUMN_FACTS.items()}


def _classes(one: str, otherwise: str) -> str:
    """Class names of the flag, each as ``one`` has it; all of it constants."""
    names = {"R": ("PII",), "A": ("PII", "FIN")}
    listed = {flag: ", ".join(one.format(f"'{c}'") for c in classes) for flag, classes in names.items()}
    return f"CASE {FACT['flag']} {' '.join(f"WHEN '{flag}' THEN array({made})" for flag, made in listed.items())} ELSE {otherwise} END"


def lines_by_asset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``l_orderkey, lines``: an array of the line and all its column facts, by line."""
    return _pairs_by_order(spark, sf_dir, None).select("l_orderkey", _by_pair({"line": "one.line", **FACT}).alias("lines"))


def lines_sql() -> str:
    columns = ", ".join(f"{e} AS {c}" for c, e in COLUMN_FACTS.items())
    return f"SELECT l_orderkey AS asset_key, l_linenumber AS line, {columns} FROM lineitem GROUP BY l_orderkey, l_linenumber"


def list_pages(rows: DataFrame, key: str, array: str = "value") -> DataFrame:
    """Catalog rows as list documents of one page for every 50 keys."""
    fields = [c for c in rows.columns if c != key]
    paged = rows.withColumn("page", F.floor(F.col(key) / 50))
    members = F.array_sort(F.collect_list(F.struct(F.col(key).alias("_order"), F.struct(*fields).alias("_one"))))
    return paged.groupBy("page").agg(
        F.to_json(F.struct(F.transform(members, lambda m: m["_one"]).alias(array))).alias("document")
    )


def _columns_by_asset(spark: SparkSession, sf_dir: str, staged: DataFrame | None) -> DataFrame:
    """Column lists and referred entities; an order has few line numbers."""
    attributes = {
        "name": FACT["column_name"],
        "data_type": FACT["data_type"],
        "dataType": f"upper({FACT['data_type']})",
        "type": f"'t_' || {FACT['data_type']}",
        "userDescription": FACT["column_description"],
    }
    entity = {"attributes": _struct_sql(attributes), "classifications": _classes("named_struct('typeName', {})", "null")}
    rows = _pairs_by_order(spark, sf_dir, staged).withColumn("_named", F.expr(f"filter(_pairs, one -> {FACT['is_referred']})"))
    return rows.select(
        F.col("l_orderkey").alias("_asset_key"),
        _by_pair({"guid": FACT["column_guid"]}).alias("_columns"),
        F.map_from_arrays(F.expr(f"transform(_named, one -> {FACT['column_guid']})"), _by_pair(entity, "_named")).alias("_referred"),
    )


@_kept
def _with_columns(spark: SparkSession, sf_dir: str, staged: DataFrame | None) -> DataFrame:
    entities = load(spark, sf_dir, "entities")
    columns = _columns_by_asset(spark, sf_dir, staged)
    return entities.join(columns, F.col("asset_key") == F.col("_asset_key"), "left")


@_kept
def entity_documents(spark: SparkSession, sf_dir: str, staged: DataFrame | None = None) -> DataFrame:
    """``guid, document`` with columns and referred entities."""
    rows = _with_columns(spark, sf_dir, staged)
    entity = F.struct(
        F.col("asset_type").alias("typeName"),
        F.struct(
            F.col("display_name").alias("displayName"),
            F.col("short_name").alias("name"),
            F.col("user_description").alias("userDescription"),
        ).alias("attributes"),
        F.when(
            F.col("classification").isNotNull(),
            F.array(F.struct(F.col("classification").alias("typeName"))),
        ).alias("classifications"),
        F.struct(
            F.col("_columns").alias("columns"),
            F.when(
                F.col("schema_guid").isNotNull(), F.array(F.struct(F.col("schema_guid").alias("guid")))
            ).alias("attachedSchema"),
        ).alias("relationshipAttributes"),
    )
    document = F.struct(F.array(entity).alias("entities"), F.col("_referred").alias("referredEntities"))
    return rows.select("guid", F.to_json(document).alias("document"))


@_kept
def schema_documents(spark: SparkSession, sf_dir: str, staged: DataFrame | None = None) -> DataFrame:
    rows = _with_columns(spark, sf_dir, staged).where("schema_guid IS NOT NULL")
    document = F.struct(F.col("_referred").alias("referredEntities"))
    return rows.select(F.col("schema_guid").alias("guid"), F.to_json(document).alias("document"))


@_kept
def lineage_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    def entry(guid: Column, kind: str) -> Column:
        return F.struct(guid.alias("guid"), F.lit(kind).alias("typeName"))

    rows = load(spark, sf_dir, "lineages")
    entries = F.map_filter(
        F.create_map(
            F.lit("e1"), entry(F.col("first_store"), METASTORE),
            F.lit("e2"), entry(F.col("guid"), LAKEHOUSE_TABLE),
            F.lit("e3"), entry(F.col("last_store"), METASTORE),
        ),
        lambda _, one: one["guid"].isNotNull(),
    )
    document = F.struct(entries.alias("guidEntityMap"))
    return rows.select("guid", F.to_json(document).alias("document"))


@_kept
def metastore_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspaces = F.filter(
        F.array(F.struct(F.col("workspace").alias("displayText"))), lambda w: w["displayText"].isNotNull()
    )
    entity = F.struct(F.struct(workspaces.alias("workspaces")).alias("relationshipAttributes"))
    document = F.struct(F.array(entity).alias("entities"))
    return load(spark, sf_dir, "metastores").select("guid", F.to_json(document).alias("document"))


@_kept
def detail_documents(spark: SparkSession, sf_dir: str, staged: DataFrame | None = None) -> DataFrame:
    """Details of catalog assets, with the columns their order has."""
    rows = load(spark, sf_dir, "assets").withColumn("_key", F.col("_row"))
    column = {
        "name": FACT["column_name"],
        "description": f"coalesce({FACT['column_description']}, '')",
        "classifications": _classes("{}", "cast(array() AS array<string>)"),
        "type": FACT["data_type"],
    }
    joined = rows.join(_pairs_by_order(spark, sf_dir, staged), F.col("_key") == F.col("l_orderkey"), "left")
    schema = _by_pair(column)
    return joined.select(F.to_json(F.struct("id", "name", schema.alias("schema"))).alias("document"))


@_kept
def policy_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, document``: one member twice in every other policy, a steward rule
    in quality policies, and keys that no rewrite knows of."""
    rows = load(spark, sf_dir, "policies").withColumn(
        "_key", F.substring_index("id", "-", -1).cast("long")
    )
    member = F.expr(f"md5({numbered('Supplier', '_key % 120')})")
    members = F.when(F.col("_key") % 12 == 0, F.array(member, member)).when(
        F.col("_key") % 2 == 0, F.array(member)
    ).otherwise(F.array().cast("array<string>"))

    def rule(name: str, included: Column) -> Column:
        first = F.struct(
            F.lit("principal.id").alias("attributeName"), included.alias("attributeValueIncludedIn")
        )
        second = F.struct(
            F.lit("principal.group").alias("attributeName"),
            F.array(F.lit("everyone")).alias("attributeValueIncludedIn"),
        )
        return F.struct(
            F.lit("attributerule").alias("kind"),
            F.lit(name).alias("name"),
            F.array(F.array(first, second)).alias("dnfCondition"),
        )

    nobody = F.array().cast("array<string>")
    rules = F.when(
        F.col("name").startswith(QUALITY_POLICY),
        F.array(rule("member", members), rule("reader", nobody), rule("steward", nobody)),
    ).otherwise(F.array(rule("member", members)))
    document = F.struct(
        "id",
        "name",
        F.lit(1).cast("long").alias("version"),
        F.struct(
            F.lit("policy").alias("description"),
            rules.alias("attributeRules"),
            # Keys no rewrite knows of.
            F.array(F.struct(F.lit("decisionrule").alias("kind"), F.lit("Permit").alias("effect"))).alias("decisionRules"),
            F.struct(F.lit("CollectionReference").alias("type"), F.col("_key").alias("number")).alias("collection"),
        ).alias("properties"),
    )
    return rows.select("id", F.to_json(document).alias("document"))
