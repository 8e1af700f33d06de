"""The queries of the catalog, as SQL for DuckDB on the same tables.

Written from the meaning of each operator, not from the Spark plan: windows and
recursive queries are fine here, as the tables of a check are small.
"""

from __future__ import annotations

from stewardry.queries.inputs import CDE_ACCOUNT, INPUTS, PAGE_TASK_BYTES, as_sql, lines_sql
from stewardry.sources.column_types import DATE_CELL, NUMBER_CELL, TIMESTAMP_CELL, WHOLE_CELL
from stewardry.schemas import DOMAIN_POLICY, LAKEHOUSE_TABLE, QUALITY_POLICY, REPORT, RESOURCE_SET, SQL_TABLE

NAME, DOMAIN, PARENT = "glossary_term_name", "business_domain_name", "glossary_term_parent_term"

# Named steps. A query lists the steps it needs; each step lists its own.
STEPS: dict[str, tuple[str, tuple[str, ...]]] = {
    f"x_{name}": (as_sql(name), ()) for name in INPUTS
}


def step(name: str, sql: str, *needs: str) -> None:
    STEPS[name] = (sql, needs)


def _closure(names: tuple[str, ...]) -> list[str]:
    out: list[str] = []

    def visit(name: str) -> None:
        for need in STEPS[name][1]:
            visit(need)
        if name not in out:
            out.append(name)

    for name in names:
        visit(name)
    return out


def build(body: str, *needs: str) -> str:
    parts = ", ".join(f"{name} AS ({STEPS[name][0]})" for name in _closure(needs))
    return f"WITH RECURSIVE {parts} {body}" if parts else body


def first(source: str, *keys: str) -> str:
    """First row per key, in list order."""
    tests = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    names = ", ".join(keys)
    return f"SELECT DISTINCT ON ({names}) * FROM {source} WHERE {tests} ORDER BY {names}, _row"


def new_id(kind: str, *parts: str) -> str:
    text = f"'{kind}'" + "".join(f" || '/' || cast(length({p}) AS varchar) || ':' || {p}" for p in parts)
    return (
        f"regexp_replace(md5({text}), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', "
        r"'\1-\2-\3-\4-\5')"
    )


def quoted(value: str) -> str:
    """A JSON string, or null spelled out."""
    return f"coalesce(cast(to_json({value}) AS varchar), 'null')"


def id_list(ids: str) -> str:
    return (
        "'[' || coalesce(array_to_string(list_transform("
        f"{ids}, lambda i: '{{\"id\":\"' || i || '\"}}'), ','), '') || ']'"
    )


def owners(source: str, *cells: str) -> str:
    """``cell, ids, bad`` for all distinct comma lists of some columns."""
    union = " UNION ".join(f"SELECT DISTINCT {c} AS cell FROM {source} WHERE {c} IS NOT NULL" for c in cells)
    return f"""
        SELECT p.cell,
          coalesce(list(u.id ORDER BY p.pos) FILTER (WHERE u.id IS NOT NULL), []) AS ids,
          coalesce(list(p.mail ORDER BY p.pos) FILTER (WHERE u.id IS NULL), []) AS bad
        FROM (
          SELECT cell, unnest(string_split(cell, ',')) AS mail,
            generate_subscripts(string_split(cell, ','), 1) AS pos
          FROM ({union})
        ) p LEFT JOIN f_users u ON u.mail = p.mail GROUP BY p.cell"""


step("f_users", first("x_users", "mail"), "x_users")
step("f_domains", first("x_domains", "name"), "x_domains")
step("f_terms", first("x_terms", "name", "domain"), "x_terms")
step("f_term_names", first("x_terms", "name"), "x_terms")
step("f_products", first("x_products", "name"), "x_products")
step("f_okrs", first("x_okrs", "domain", "definition"), "x_okrs")
step("f_cdes", first("x_cdes", "domain", "name"), "x_cdes")
step(
    "f_hits",
    "SELECT DISTINCT ON (qualifiedName, account) * FROM x_hits "
    "WHERE objectType IS DISTINCT FROM 'Glossary terms' ORDER BY qualifiedName, account, _row",
    "x_hits",
)
step("lines", lines_sql())

# Terms
step(
    "d_terms",
    f"SELECT * FROM x_term_file QUALIFY row_number() OVER "
    f"(PARTITION BY {NAME}, {DOMAIN} ORDER BY {PARENT} DESC NULLS FIRST, _row) = 1",
    "x_term_file",
)
step(
    "r_terms",
    f"""
    SELECT t.*, d.id AS domain_id, own.id AS own_id, par.id AS parent_uuid,
      syn.id AS synonyms_uuid, rel.id AS related_uuid
    FROM d_terms t
    LEFT JOIN f_domains d ON d.name = t.{DOMAIN}
    LEFT JOIN f_terms own ON own.name = t.{NAME} AND own.domain = d.id
    LEFT JOIN f_terms par ON par.name = t.{PARENT} AND par.domain = d.id
    LEFT JOIN f_domains sd ON sd.name = t.glossary_term_synonyms_domain
    LEFT JOIN f_terms syn ON syn.name = t.glossary_term_synonyms AND syn.domain = sd.id
    LEFT JOIN f_domains rd ON rd.name = t.glossary_term_related_domain
    LEFT JOIN f_terms rel ON rel.name = t.glossary_term_related AND rel.domain = rd.id""",
    "d_terms", "f_domains", "f_terms",
)
step(
    "tree",
    f"""
    SELECT _row, {NAME} AS name, {DOMAIN} AS dom, [_row] AS path, _row AS root_row, cast(0 AS bigint) AS depth
    FROM d_terms WHERE {PARENT} IS NULL
    UNION ALL
    SELECT c._row, c.{NAME}, c.{DOMAIN}, list_append(t.path, -c._row), t.root_row, t.depth + 1
    FROM d_terms c JOIN tree t ON c.{PARENT} = t.name AND c.{DOMAIN} = t.dom""",
    "d_terms",
)
step(
    "orphans",
    f"""
    SELECT c._row, c.{NAME} AS name, c.{DOMAIN} AS dom FROM d_terms c
    WHERE c.{PARENT} IS NOT NULL AND NOT EXISTS (
      SELECT 1 FROM d_terms p WHERE p.{NAME} = c.{PARENT} AND p.{DOMAIN} = c.{DOMAIN})
    UNION ALL
    SELECT c._row, c.{NAME}, c.{DOMAIN}
    FROM d_terms c JOIN orphans t ON c.{PARENT} = t.name AND c.{DOMAIN} = t.dom""",
    "d_terms",
)
step(
    "statuses",
    """
    SELECT d._row, CASE WHEN t._row IS NOT NULL THEN 'reached' WHEN o._row IS NOT NULL THEN 'orphan'
      ELSE 'cycle' END AS status, t.root_row, t.depth
    FROM d_terms d LEFT JOIN tree t ON t._row = d._row LEFT JOIN orphans o ON o._row = d._row""",
    "d_terms", "tree", "orphans",
)
step(
    "p_terms",
    f"""
    SELECT r.*, s.depth,
      coalesce(r.parent_uuid, CASE WHEN s.status <> 'cycle' OR p._row < r._row
        THEN {new_id('term', 'p.domain_id', f'p.{NAME}')} END) AS parent_id
    FROM r_terms r JOIN statuses s ON s._row = r._row
    LEFT JOIN r_terms p ON p.domain_id = r.domain_id AND p.{NAME} = r.{PARENT}""",
    "r_terms", "statuses",
)
step(
    "o_terms",
    owners("d_terms", "glossary_term_owner", "glossary_term_expert", "glossary_term_database_admin"),
    "d_terms", "f_users",
)
step(
    "n_terms",
    " UNION ALL ".join(
        f"SELECT t._row, '{role}' AS role, k.ID AS id FROM x_term_file t JOIN x_terms_by_name k ON k.Name = t.{column}"
        for role, column in (
            ("name", NAME),
            ("parent", PARENT),
            ("syn", "glossary_term_synonyms"),
            ("rel", "glossary_term_related"),
        )
    ),
    "x_term_file", "x_terms_by_name",
)
step(
    "v1_terms",
    f"""
    SELECT t._row, t.{NAME}, coalesce(a.id, '') AS glossary_term_name_id,
      coalesce(b.id, '') AS glossary_term_parent_term_id,
      coalesce(c.id, '') AS glossary_term_synonyms_id,
      coalesce(d.id, '') AS glossary_term_related_id,
      coalesce(t.glossary_term_acronyms, '') AS glossary_term_acronyms
    FROM x_term_file t
    LEFT JOIN n_terms a ON a._row = t._row AND a.role = 'name'
    LEFT JOIN n_terms b ON b._row = t._row AND b.role = 'parent'
    LEFT JOIN n_terms c ON c._row = t._row AND c.role = 'syn'
    LEFT JOIN n_terms d ON d._row = t._row AND d.role = 'rel'""",
    "x_term_file", "n_terms",
)

# Domains
BATCH_DOMAIN = new_id("domain", "f.business_domain_parent")
step("domain_names", f"SELECT {DOMAIN} AS name, min(_row) AS first_row FROM x_domain_file GROUP BY ALL", "x_domain_file")
step(
    "r_domains",
    f"""
    SELECT f.*, own.id AS own_id, par.id AS strict_parent,
      coalesce(par.id, CASE WHEN b.name IS NOT NULL THEN {BATCH_DOMAIN} END) AS parent_id,
      CASE WHEN own.id IS NULL AND f._row = min(f._row) OVER (PARTITION BY f.{DOMAIN})
        THEN 'created' ELSE 'existing' END AS outcome
    FROM x_domain_file f
    LEFT JOIN f_domains own ON own.name = f.{DOMAIN}
    LEFT JOIN f_domains par ON par.name = f.business_domain_parent
    LEFT JOIN domain_names b ON b.name = f.business_domain_parent AND b.first_row < f._row""",
    "x_domain_file", "f_domains", "domain_names",
)
step(
    "loaded",
    f"SELECT d.id, d.name, d.type, f.* EXCLUDE ({DOMAIN}) FROM (SELECT * EXCLUDE (_row) FROM x_domains) d "
    f"JOIN x_domain_file f ON f.{DOMAIN} = d.name",
    "x_domains", "x_domain_file",
)

# Products
step(
    "r_products",
    f"""
    SELECT f.*, d.id AS domain_id, p.id AS own_id,
      min(CASE WHEN d.id IS NOT NULL AND p.id IS NULL THEN f._row END) OVER (PARTITION BY f.dp_name) AS first_new,
      min(CASE WHEN d.id IS NOT NULL THEN f._row END) OVER (PARTITION BY f.dp_name) AS first_valid
    FROM x_product_file f LEFT JOIN f_domains d ON d.name = f.{DOMAIN}
    LEFT JOIN f_products p ON p.name = f.dp_name""",
    "x_product_file", "f_domains", "f_products",
)
step(
    "c_products",
    """
    SELECT *, CASE WHEN domain_id IS NULL THEN 'failed' WHEN own_id IS NOT NULL OR _row > first_new
      THEN 'existing' ELSE 'created' END AS outcome FROM r_products""",
    "r_products",
)
step("o_products", owners("x_product_file", "dp_owners"), "x_product_file", "f_users")

# Objectives
DATE = (
    "CASE WHEN regexp_matches(f.targetDate, '^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$') "
    "THEN strftime(try_strptime(f.targetDate, '%m-%d-%Y'), '%Y-%m-%dT%H:%M:%S.%fZ') END"
)
step(
    "g_okrs",
    f"""
    SELECT f.*, d.id AS domain_id, o.id AS own_id, {DATE} AS target_date
    FROM x_okr_file f LEFT JOIN f_domains d ON d.name = f.domain
    LEFT JOIN f_okrs o ON o.domain = d.id AND o.definition = f.definition""",
    "x_okr_file", "f_domains", "f_okrs",
)
step(
    "e_okrs",
    """
    SELECT *, CASE WHEN target_date IS NULL THEN 'Invalid target date'
      WHEN domain_id IS NULL THEN 'Invalid domain UUID' END AS error FROM g_okrs""",
    "g_okrs",
)
step(
    "r_okrs",
    """
    SELECT *, CASE WHEN error IS NOT NULL THEN 'failed' WHEN own_id IS NOT NULL OR _row > min(
        CASE WHEN error IS NULL AND own_id IS NULL THEN _row END) OVER (PARTITION BY domain_id, definition)
      THEN 'existing' ELSE 'created' END AS outcome FROM e_okrs""",
    "e_okrs",
)
step("o_okrs", owners("x_okr_file", "owner"), "x_okr_file", "f_users")

# Data elements
step(
    "g_cdes",
    f"""
    SELECT f.*, d.id AS domain_id, c.id AS own_id,
      coalesce(c.id, {new_id('cde', 'd.id', 'f.cde_name')}) AS cde_id
    FROM x_cde_file f LEFT JOIN f_domains d ON d.name = f.{DOMAIN}
    LEFT JOIN f_cdes c ON c.domain = d.id AND c.name = f.cde_name""",
    "x_cde_file", "f_domains", "f_cdes",
)
step(
    "r_cdes",
    """
    SELECT *, CASE WHEN domain_id IS NULL THEN 'failed' WHEN own_id IS NULL AND _row = min(
        CASE WHEN domain_id IS NOT NULL AND own_id IS NULL THEN _row END) OVER (PARTITION BY domain_id, cde_name)
      THEN 'create' ELSE 'update' END AS action FROM g_cdes""",
    "g_cdes",
)
step("o_cdes", owners("x_cde_file", "cde_owner"), "x_cde_file", "f_users")

# Asset columns, of catalog assets and of assets to build
CLASSES = "CASE flag WHEN 'R' THEN '[\"PII\"]' WHEN 'A' THEN '[\"PII\",\"FIN\"]' ELSE '[]' END"
CLASS_NAMES = "CASE flag WHEN 'R' THEN 'PII' WHEN 'A' THEN 'PII,FIN' ELSE '' END"
step(
    "kept_columns",
    """
    SELECT a.id AS asset_id, a.name AS asset_name, a._row AS asset_row, a.description AS asset_description,
      row_number() OVER (PARTITION BY a.id ORDER BY l.line) - 1 AS position,
      l.column_name AS name, coalesce(l.column_description, '') AS description, l.flag, l.data_type AS type
    FROM x_assets a JOIN lines l ON l.asset_key = a._row""",
    "x_assets", "lines",
)
step(
    "built_columns",
    f"""
    SELECT e.guid, e.asset_type,
      CASE WHEN e.asset_type = '{RESOURCE_SET}' THEN l.column_guid ELSE lpad(cast(l.line AS varchar), 9, '0') END AS ord,
      l.column_name AS name, l.flag,
      CASE WHEN e.asset_type = '{RESOURCE_SET}' THEN coalesce(l.column_description, '') ELSE '' END AS description,
      CASE e.asset_type WHEN '{SQL_TABLE}' THEN l.data_type WHEN '{LAKEHOUSE_TABLE}' THEN upper(l.data_type)
        ELSE 't_' || l.data_type END AS type
    FROM x_entities e JOIN lines l ON l.asset_key = e.asset_key
    WHERE l.is_referred AND (e.asset_type IN ('{SQL_TABLE}', '{LAKEHOUSE_TABLE}') OR e.schema_guid IS NOT NULL)""",
    "x_entities", "lines",
)
step(
    "schemas",
    f"""
    SELECT guid, '[' || string_agg('{{"name":"' || name || '","description":"' || description
      || '","classifications":' || {CLASSES} || ',"type":"' || type || '"}}', ',' ORDER BY ord) || ']' AS schema
    FROM built_columns GROUP BY guid""",
    "built_columns",
)
step("with_lines", "SELECT DISTINCT asset_key FROM lines", "lines")
PARTS = "string_split(a.fqn, '/')"
step(
    "b_assets",
    f"""
    SELECT a.*, e.asset_type, e.classification, e.schema_guid,
      CASE WHEN e.asset_type IN ('{SQL_TABLE}', '{RESOURCE_SET}', '{REPORT}') THEN e.display_name
        WHEN e.asset_type = '{LAKEHOUSE_TABLE}' THEN e.short_name END AS name,
      CASE WHEN e.asset_type <> 'hive_table' THEN coalesce(e.user_description, '') END AS description,
      CASE WHEN e.asset_type = '{SQL_TABLE}' THEN 'AzureSqlTable' WHEN e.asset_type = '{RESOURCE_SET}' THEN 'ADLSGen2Path'
        WHEN e.asset_type IN ('{LAKEHOUSE_TABLE}', '{REPORT}') THEN 'General' END AS type,
      CASE WHEN e.asset_type = '{LAKEHOUSE_TABLE}' THEN m.workspace END AS workspace_url,
      CASE WHEN e.guid IS NULL THEN 'Asset not found'
        WHEN e.asset_type = '{SQL_TABLE}' AND len({PARTS}) < 4 THEN 'FQN too short'
        WHEN e.asset_type = '{RESOURCE_SET}' AND e.schema_guid IS NULL THEN 'No Attached Schema'
        WHEN e.asset_type = '{RESOURCE_SET}' AND len({PARTS}) < 4 THEN 'FQN too short'
        WHEN e.asset_type = '{LAKEHOUSE_TABLE}' AND l.last_store IS NULL THEN 'No Metastore Found'
        WHEN e.asset_type = '{LAKEHOUSE_TABLE}' AND m.workspace IS NULL THEN 'No Workspace Found' END AS error,
      coalesce(s.schema, '[]') AS schema,
      CASE e.asset_type WHEN '{SQL_TABLE}' THEN '{{"format":"Table","serverEndpoint":' || {quoted(f'{PARTS}[-4]')}
          || ',"databaseName":' || {quoted(f'{PARTS}[-3]')} || ',"schemaName":' || {quoted(f'{PARTS}[-2]')}
          || ',"tableName":' || {quoted(f'{PARTS}[-1]')} || '}}'
        WHEN '{RESOURCE_SET}' THEN '{{"serverEndpoint":"' || {PARTS}[1] || '//' || {PARTS}[3] || '/","container":"'
          || {PARTS}[4] || '","folderPath":"' || string_split(array_to_string({PARTS}[5:], '/'), '{{')[1] || '"}}'
        ELSE '{{}}' END AS properties,
      CASE WHEN l.guid IS NOT NULL THEN '{{"guidEntityMap":{{'
        || CASE WHEN l.first_store IS NOT NULL THEN '"e1":{{"guid":"' || l.first_store || '","typeName":"databricks_metastore"}},' ELSE '' END
        || '"e2":{{"guid":"' || l.guid || '","typeName":"databricks_table"}}'
        || CASE WHEN l.last_store IS NOT NULL THEN ',"e3":{{"guid":"' || l.last_store || '","typeName":"databricks_metastore"}}' ELSE '' END
        || '}}}}' ELSE 'null' END AS lineage
    FROM x_all_assets a LEFT JOIN x_entities e ON e.guid = a.guid LEFT JOIN x_lineages l ON l.guid = a.guid
    LEFT JOIN x_metastores m ON m.guid = l.last_store LEFT JOIN schemas s ON s.guid = a.guid""",
    "x_all_assets", "x_entities", "x_lineages", "x_metastores", "schemas",
)
step(
    "r_assets",
    """
    SELECT *, CASE WHEN error IS NOT NULL THEN 'failed' WHEN asset_type = 'hive_table' THEN 'skipped_unsupported'
      ELSE 'create' END AS outcome FROM b_assets""",
    "b_assets",
)
EMPTY_CONTACTS = '"contacts":{"owner":[],"expert":[],"databaseAdmin":[]}'
step(
    "records",
    f"""
    SELECT *, CASE WHEN outcome = 'create' THEN
      '{{"' || CASE WHEN asset_type = '{LAKEHOUSE_TABLE}' THEN 'id' ELSE 'key' END || '":"' || guid || '","name":"' || name
      || '","description":' || {quoted('description')} || ',"descriptionStripped":'
      || {quoted("regexp_replace(description, '<.*?>', '', 'g')")}
      || ',"source":{{"type":"DataMap","fqn":"' || fqn || '","accountName":"' || account || '","assetId":"' || guid
      || '","assetType":"' || asset_type || '"'
      || CASE WHEN asset_type = '{LAKEHOUSE_TABLE}' THEN ',"AssetAttribute":{{"workspaceUrl":"' || workspace_url || '"}}' ELSE '' END
      || '}},{EMPTY_CONTACTS},"classifications":'
      || CASE WHEN classification IS NULL THEN '[]' ELSE '["' || classification || '"]' END
      || ',"schema":' || CASE WHEN asset_type = '{REPORT}' THEN '[]' ELSE schema END
      || ',"lineage":' || lineage || ',"type":"' || type || '","typeProperties":' || properties || '}}'
      END AS record FROM r_assets""",
    "r_assets",
)
# Assets as rows of a load see them: found, reused or built
step(
    "asset_by_path",
    f"""
    SELECT h.qualifiedName AS fqn, h.account, h.id AS guid, k.id AS kept_id, k.description AS kept_description,
      r.outcome AS built, r.description AS built_description, r.asset_type,
      {new_id('asset', 'h.id')} AS new_asset_id
    FROM f_hits h LEFT JOIN x_assets k ON k.dataMapAssetId = h.id LEFT JOIN r_assets r ON r.guid = h.id""",
    "f_hits", "x_assets", "r_assets",
)
step(
    "usable_assets",
    """
    SELECT fqn, account, guid, coalesce(kept_id, CASE WHEN built = 'create' THEN new_asset_id END) AS asset_id,
      CASE WHEN kept_id IS NOT NULL THEN kept_description WHEN built = 'create' THEN built_description END AS description
    FROM asset_by_path""",
    "asset_by_path",
)
step(
    "all_columns",
    f"""
    SELECT asset_id, asset_name, cast(position AS varchar) AS ord, name, description, flag, type FROM kept_columns
    UNION ALL
    SELECT {new_id('asset', 'r.guid')}, r.name, b.ord, b.name, b.description, b.flag, b.type
    FROM built_columns b JOIN r_assets r ON r.guid = b.guid AND r.outcome = 'create'""",
    "kept_columns", "built_columns", "r_assets",
)
step(
    "m_cdes",
    f"""
    SELECT DISTINCT ON (c.cde_id, c.domain_id, a.asset_id, lower(c.cde_column_name))
      c.cde_id, c.domain_id, a.asset_id, k.asset_name, k.name, k.description, k.flag, k.type
    FROM r_cdes c JOIN usable_assets a ON a.fqn = c.cde_fqdn AND a.account = '{CDE_ACCOUNT}'
    JOIN all_columns k ON k.asset_id = a.asset_id AND lower(k.name) = lower(c.cde_column_name)
    WHERE c.action <> 'failed' ORDER BY c.cde_id, c.domain_id, a.asset_id, lower(c.cde_column_name), k.ord""",
    "r_cdes", "usable_assets", "all_columns",
)
step(
    "k_cdes",
    f"SELECT *, {new_id('cde_column', 'asset_id', 'name', 'domain_id')} AS column_id FROM m_cdes",
    "m_cdes",
)

# Policies
step("o_domains", owners("(SELECT replace(business_domain_email_owners, ' ', '') AS cell_text FROM x_domain_file)", "cell_text"), "x_domain_file", "f_users")
step(
    "members",
    """
    SELECT id, list(member ORDER BY seen_row, place) AS members FROM (
      SELECT DISTINCT ON (id, member) id, member, seen_row, place FROM (
        SELECT l.id, l._row AS seen_row, unnest(o.ids) AS member, generate_subscripts(o.ids, 1) AS place
        FROM loaded l JOIN o_domains o ON o.cell = replace(l.business_domain_email_owners, ' ', ''))
      ORDER BY id, member, seen_row, place) GROUP BY id""",
    "loaded", "o_domains",
)
step(
    "held",
    """
    SELECT *, CASE WHEN k % 12 = 0 THEN [m, m] WHEN k % 2 = 0 THEN [m] ELSE [] END AS included FROM (
      SELECT *, md5('Supplier#' || lpad(cast(k % 120 AS varchar), 9, '0')) AS m FROM (
        SELECT *, cast(split_part(id, '-', 3) AS bigint) AS k FROM x_policies))""",
    "x_policies",
)

ORACLES: dict[str, str] = {}


def oracle(name: str, body: str, *needs: str) -> None:
    ORACLES[name] = build(body, *needs)


def some_domains(source: str) -> str:
    return (
        "SELECT id, name, type, CASE WHEN _row % 2 = 0 THEN '[{\"id\":\"of-' || id || '\"}]' ELSE 'null' END AS domains "
        f"FROM {source}"
    )


oracle("scan_concepts", "SELECT * EXCLUDE (_row) FROM x_term_file", "x_term_file")
for scan, file in {"domains": "domain", "products": "product", "assets": "asset", "okrs": "okr", "cdes": "cde"}.items():
    oracle(f"scan_{scan}", f"SELECT * EXCLUDE (_row) FROM x_{file}_file", f"x_{file}_file")


def listed(columns: str, source: str, key: str, order: str) -> str:
    """Rows with the page and the place on it that a list of 50 keys a page gives."""
    return (
        f"SELECT {columns}, cast(floor({key} / 50) AS bigint) AS page, "
        f"row_number() OVER (PARTITION BY floor({key} / 50) ORDER BY {key}, {order}) - 1 AS place FROM {source}"
    )


oracle("list_policies", listed("id, name", "x_policies", "cast(split_part(id, '-', 3) AS bigint)", "id"), "x_policies")
oracle("list_users", listed("mail, id", "x_users", "_row", "id"), "x_users")
oracle("list_hits", "SELECT id, qualifiedName, objectType, account FROM x_hits", "x_hits")
oracle("list_okrs", "SELECT id, definition, status, domain FROM x_okrs", "x_okrs")
oracle("catalog_domains", some_domains("x_domains"), "x_domains")
oracle("catalog_assets", some_domains("x_assets"), "x_assets")
oracle("catalog_products", some_domains("x_products"), "x_products")
oracle(
    "catalog_terms",
    "SELECT id, name, domain, parentId, 'all' AS listed FROM x_terms UNION ALL "
    "SELECT id, name, domain, parentId, 'one domain' FROM x_terms WHERE domain = 'dom-Brand#1'",
    "x_terms",
)
oracle(
    "catalog_terms_full",
    """SELECT id AS "ID", name AS "Name", domain AS "Domain", 'About ' || name AS "Description",
    CASE WHEN _row % 3 = 0 THEN '{"owner":[{"id":"u-' || id || '"}]}' ELSE 'null' END AS "Contacts",
    'Draft' AS "Status" FROM x_terms""",
    "x_terms",
)
oracle(
    "catalog_cdes",
    "SELECT name, domain, dataType, status, id FROM x_cdes WHERE domain IN (SELECT domain FROM x_wanted_domains)",
    "x_cdes", "x_wanted_domains",
)
oracle(
    "okr_page",
    "SELECT domain, row_number() OVER (PARTITION BY domain ORDER BY definition, id) AS position, id, definition, status "
    "FROM x_okrs QUALIFY position <= 25",
    "x_okrs",
)
oracle(
    "asset_columns",
    f"""SELECT asset_id, asset_name, position, name AS column_name, description AS column_description,
    {CLASS_NAMES} AS column_classifications, type AS column_type
    FROM kept_columns WHERE asset_description IS NOT NULL""",
    "kept_columns",
)
oracle(
    "asset_documents",
    """SELECT e.guid, e.asset_type AS type_name, e.display_name, e.short_name AS name,
    coalesce(e.classification, '') AS classifications,
    (SELECT count(*) FROM lines l WHERE l.asset_key = e.asset_key) AS columns,
    (SELECT count(*) FROM lines l WHERE l.asset_key = e.asset_key AND l.is_referred) AS referred,
    e.schema_guid, g.last_store AS metastore_guid
    FROM x_entities e LEFT JOIN x_lineages g ON g.guid = e.guid""",
    "x_entities", "x_lineages", "lines",
)

oracle(
    "domain_lookup",
    "SELECT f._row, f.domain, d.id AS domain_id FROM x_okr_file f LEFT JOIN f_domains d ON d.name = f.domain",
    "x_okr_file", "f_domains",
)
oracle(
    "term_lookup",
    """SELECT f._row, f.glossary_term_synonyms, t.id AS term_id, t.domain AS term_domain, t.parentId AS term_parent_id
    FROM x_term_file f LEFT JOIN f_term_names t ON t.name = f.glossary_term_synonyms""",
    "x_term_file", "f_term_names",
)
oracle(
    "domain_parent",
    f"""SELECT _row, 'catalog' AS lookup, {DOMAIN}, strict_parent AS business_domain_parent_guid FROM r_domains
    UNION ALL SELECT _row, 'catalog and file', {DOMAIN}, parent_id FROM r_domains""",
    "r_domains",
)
oracle(
    "domain_parent_rows",
    "SELECT f._row AS file_row, d.id, d.name, d.type FROM x_domain_file f JOIN x_domains d ON d.name = f.business_domain_parent",
    "x_domain_file", "x_domains",
)
oracle("domains_joined", "SELECT _row, id, name, type, business_domain_email_owners FROM loaded", "loaded")
oracle(
    "assets_joined",
    "SELECT f._row, f.dp_name, f.data_asset_fqn, p.id AS product_id FROM x_asset_file f JOIN x_products p ON p.name = f.dp_name",
    "x_asset_file", "x_products",
)
oracle(
    "glossary_resolve",
    f"""SELECT {NAME}, {DOMAIN}, domain_id AS glossary_term_business_domain_uuid,
    parent_uuid AS glossary_term_parent_term_uuid, synonyms_uuid AS glossary_term_synonyms_uuid,
    related_uuid AS glossary_term_related_uuid, own_id AS glossary_term_name_uuid FROM r_terms""",
    "r_terms",
)
oracle("glossary_v1_resolve", "SELECT * FROM v1_terms", "v1_terms")
oracle(
    "glossary_product",
    f"""SELECT f._row, f.{NAME}, p.id AS data_product_uuid FROM x_term_file f
    LEFT JOIN x_products p ON p.name = f.glossary_term_data_product""",
    "x_term_file", "x_products",
)
oracle(
    "owner_resolve",
    """SELECT f._row, f.owner, coalesce(array_to_string(o.ids, ','), '') AS ids,
    coalesce(array_to_string(o.bad, ','), '') AS unknown FROM x_okr_file f LEFT JOIN o_okrs o ON o.cell = f.owner""",
    "x_okr_file", "o_okrs",
)
oracle(
    "owner_failures",
    """SELECT 'okr' AS concept, r.definition AS key, 'failed' AS outcome, 'Invalid user ID' AS error, unnest(o.bad) AS mail
    FROM r_okrs r JOIN o_okrs o ON o.cell = r.owner WHERE r.error IS NULL""",
    "r_okrs", "o_okrs",
)
oracle(
    "owner_struct",
    f"SELECT f._row, {id_list('o.ids')} AS contacts FROM x_okr_file f LEFT JOIN o_okrs o ON o.cell = f.owner",
    "x_okr_file", "o_okrs",
)
oracle(
    "asset_search",
    """SELECT h.qualifiedName, h.account, h.id, h._row FROM x_hits h WHERE h.objectType IS DISTINCT FROM 'Glossary terms'
    AND (h.qualifiedName, h.account) IN (SELECT data_asset_fqn, data_asset_account FROM x_asset_file)
    QUALIFY row_number() OVER (PARTITION BY h.qualifiedName, h.account ORDER BY h._row) <= 10""",
    "x_hits", "x_asset_file",
)
oracle(
    "asset_resolve",
    "SELECT f._row, f.data_asset_fqn, h.id AS guid FROM x_asset_file f LEFT JOIN f_hits h "
    "ON h.qualifiedName = f.data_asset_fqn AND h.account = f.data_asset_account",
    "x_asset_file", "f_hits",
)
oracle(
    "policy_targets",
    f"""SELECT d.id AS domain_id, p.prefix, q.id AS policy_id FROM x_domains d
    CROSS JOIN (VALUES ('{DOMAIN_POLICY}'), ('{QUALITY_POLICY}')) p(prefix)
    JOIN x_policies q ON q.name = p.prefix || d.id""",
    "x_domains", "x_policies",
)
oracle(
    "cde_column_match",
    f"""SELECT f._row, a.id AS asset_id, f.cde_column_name AS column_name, k.asset_name, k.name AS matched_name,
    k.description AS matched_description, CASE WHEN k.name IS NOT NULL THEN {CLASS_NAMES} END AS matched_classifications,
    k.type AS matched_type
    FROM x_cde_file f JOIN f_hits h ON h.qualifiedName = f.cde_fqdn AND h.account = '{CDE_ACCOUNT}' JOIN x_assets a ON a.dataMapAssetId = h.id
    LEFT JOIN kept_columns k ON k.asset_id = a.id AND lower(k.name) = lower(f.cde_column_name)""",
    "x_cde_file", "f_hits", "kept_columns",
)

oracle("domains_new", f"SELECT _row, {DOMAIN} FROM x_domain_file WHERE {DOMAIN} NOT IN (SELECT name FROM x_domains)", "x_domain_file", "x_domains")
oracle("domains_existing", f"SELECT _row, {DOMAIN} FROM x_domain_file WHERE {DOMAIN} IN (SELECT name FROM x_domains)", "x_domain_file", "x_domains")
oracle(
    "terms_new",
    f"SELECT _row, {NAME}, domain_id AS glossary_term_business_domain_uuid FROM r_terms WHERE own_id IS NULL",
    "r_terms",
)
oracle("okrs_new", "SELECT _row, definition, domain_id FROM g_okrs WHERE own_id IS NULL", "g_okrs")
oracle("batch_repeats", "SELECT _row, dp_name, coalesce(_row > first_valid, false) AS repeat FROM r_products", "r_products")
oracle(
    "cde_upsert",
    f"""SELECT r._row, r.cde_id AS id, r.cde_name AS name, r.domain_id AS domain, r.action,
    CASE WHEN r.action = 'failed' THEN 'Invalid domain UUID' END AS error,
    CASE WHEN r.action = 'create' THEN '{{"name":' || {quoted('r.cde_name')} || ',"dataType":' || {quoted('r.cde_dataType')}
      || ',"status":' || {quoted('r.cde_status')} || ',"contacts":{{"owner":' || {id_list('o.ids')} || '}},"description":'
      || {quoted('r.cde_description')} || ',"domain":' || {quoted('r.domain_id')} || '}}' END AS record
    FROM r_cdes r LEFT JOIN o_cdes o ON o.cell = r.cde_owner""",
    "r_cdes", "o_cdes",
)
oracle(
    "asset_upsert",
    """SELECT f._row, a.guid, CASE WHEN a.kept_id IS NOT NULL THEN 'reuse' WHEN a.guid IS NOT NULL THEN 'create' END AS action,
    coalesce(a.kept_id, a.new_asset_id) AS asset_id, a.kept_description AS description
    FROM x_asset_file f LEFT JOIN asset_by_path a
    ON a.fqn = f.data_asset_fqn AND a.account = f.data_asset_account""",
    "x_asset_file", "asset_by_path",
)

oracle("terms_dedup", f"SELECT _row, {NAME}, {DOMAIN}, {PARENT} FROM d_terms", "d_terms")
oracle(
    "terms_dedup_v1",
    f"""SELECT * FROM v1_terms QUALIFY row_number() OVER (PARTITION BY {NAME} ORDER BY
    nullif(glossary_term_parent_term_id, '') ASC NULLS LAST, _row, glossary_term_name_id,
    glossary_term_synonyms_id, glossary_term_related_id) = 1""",
    "v1_terms",
)
oracle(
    "terms_sorted",
    f"SELECT _row, {NAME}, {PARENT}, row_number() OVER (ORDER BY {PARENT} DESC NULLS LAST, _row) AS position FROM x_term_file",
    "x_term_file",
)
oracle(
    "reorder_by_list",
    f"SELECT f._row, f.{NAME}, w.position FROM x_wanted w LEFT JOIN x_term_file f ON f.{NAME} = w.key",
    "x_term_file", "x_wanted",
)

oracle(
    "term_hierarchy",
    f"""SELECT d.{NAME}, d.{DOMAIN}, t.position FROM d_terms d LEFT JOIN
    (SELECT _row, row_number() OVER (ORDER BY path) - 1 AS position FROM tree) t ON t._row = d._row""",
    "d_terms", "tree",
)
oracle(
    "term_levels",
    "SELECT _row, root_row, depth, row_number() OVER (ORDER BY root_row, depth, _row) AS position FROM tree",
    "tree",
)
oracle(
    "term_parent_ids",
    f"""SELECT _row, {NAME}, domain_id AS glossary_term_business_domain_uuid, parent_id,
    {PARENT} IS NOT NULL AND parent_id IS NULL AS parent_missing FROM p_terms""",
    "p_terms",
)
oracle("term_unreached", "SELECT _row, status FROM statuses WHERE status <> 'reached'", "statuses")

oracle("html_strip", "SELECT kind, key, regexp_replace(body, '<.*?>', '', 'g') AS body FROM x_html", "x_html")
oracle("html_wrap", "SELECT kind, key, '<div>' || body || '</div>' AS body FROM x_html", "x_html")
SPLIT = "string_split(fqn, '/')"
oracle(
    "fqn_table_parts",
    f"""SELECT kind, key, {SPLIT}[-4] AS "serverEndpoint", {SPLIT}[-3] AS "databaseName", {SPLIT}[-2] AS "schemaName",
    {SPLIT}[-1] AS "tableName" FROM x_paths""",
    "x_paths",
)
oracle(
    "fqn_path_parts",
    f"""SELECT kind, key, {SPLIT}[1] || '//' || {SPLIT}[3] || '/' AS "serverEndpoint", {SPLIT}[4] AS container,
    coalesce(string_split(array_to_string({SPLIT}[5:], '/'), '{{')[1], '') AS "folderPath" FROM x_paths""",
    "x_paths",
)
oracle("okr_target_date", "SELECT _row, targetDate, target_date FROM g_okrs", "g_okrs")

oracle(
    "asset_schema",
    f"""SELECT e.guid, e.asset_type AS kind,
    CASE WHEN w.asset_key IS NOT NULL THEN coalesce(s.schema, '[]') END AS schema FROM x_entities e
    LEFT JOIN with_lines w ON w.asset_key = e.asset_key LEFT JOIN schemas s ON s.guid = e.guid
    WHERE e.asset_type IN ('{SQL_TABLE}', '{LAKEHOUSE_TABLE}')""",
    "x_entities", "with_lines", "schemas",
)
oracle(
    "asset_schema_files",
    """SELECT e.schema_guid AS guid, CASE WHEN w.asset_key IS NOT NULL THEN coalesce(s.schema, '[]') END AS schema
    FROM x_entities e LEFT JOIN with_lines w ON w.asset_key = e.asset_key LEFT JOIN schemas s ON s.guid = e.guid
    WHERE e.schema_guid IS NOT NULL""",
    "x_entities", "with_lines", "schemas",
)
oracle(
    "asset_metastore",
    f"""SELECT e.guid, l.last_store AS metastore_guid, m.workspace AS workspace_url FROM x_entities e
    LEFT JOIN x_lineages l ON l.guid = e.guid LEFT JOIN x_metastores m ON m.guid = l.last_store
    WHERE e.asset_type = '{LAKEHOUSE_TABLE}'""",
    "x_entities", "x_lineages", "x_metastores",
)
oracle(
    "asset_records",
    """SELECT guid, asset_type, name, regexp_replace(description, '<.*?>', '', 'g') AS description_stripped,
    coalesce(classification, '') AS classifications, type, workspace_url, outcome, error, record FROM records""",
    "records",
)

oracle(
    "plan_domains",
    f"""SELECT _row, coalesce(own_id, {new_id('domain', DOMAIN)}) AS id, {DOMAIN} AS name, parent_id, outcome,
    CASE WHEN outcome = 'created' THEN '{{"name":' || {quoted(DOMAIN)} || ',"owners":' || {quoted('business_domain_email_owners')}
      || ',"status":' || {quoted('business_domain_status')} || ',"type":' || {quoted('business_domain_type')}
      || ',"description":' || {quoted('business_domain_description')} || ',"parentId":' || {quoted('parent_id')} || '}}' END AS record
    FROM r_domains""",
    "r_domains",
)
oracle(
    "plan_terms",
    f"""SELECT _row, coalesce(own_id, {new_id('term', 'domain_id', NAME)}) AS id, {NAME} AS name, domain_id AS domain,
    parent_id, {PARENT} IS NOT NULL AND parent_id IS NULL AS parent_missing, depth, outcome,
    CASE WHEN outcome = 'failed' THEN 'Invalid domain UUID' END AS error,
    CASE WHEN outcome = 'created' THEN '{{"name":' || {quoted(NAME)} || ',"description":' || {quoted('glossary_term_description')}
      || ',"status":' || {quoted('glossary_term_status')} || ',"contacts":{{"owner":' || {id_list('owner_ids')}
      || ',"expert":' || {id_list('expert_ids')} || ',"database_admin":' || {id_list('admin_ids')} || '}},"acronyms":'
      || CASE WHEN glossary_term_acronyms IS NULL THEN '[]' ELSE '["' || glossary_term_acronyms || '"]' END
      || ',"domain":' || {quoted('domain_id')}
      || CASE WHEN parent_id IS NULL THEN '' ELSE ',"parentId":"' || parent_id || '"' END || '}}' END AS record
    FROM (SELECT p.*, a.ids AS owner_ids, b.ids AS expert_ids, c.ids AS admin_ids,
        CASE WHEN p.domain_id IS NULL THEN 'failed' WHEN p.own_id IS NOT NULL THEN 'existing' ELSE 'created' END AS outcome
      FROM p_terms p LEFT JOIN o_terms a ON a.cell = p.glossary_term_owner
      LEFT JOIN o_terms b ON b.cell = p.glossary_term_expert
      LEFT JOIN o_terms c ON c.cell = p.glossary_term_database_admin)""",
    "p_terms", "o_terms",
)
oracle(
    "plan_products",
    f"""SELECT r._row, coalesce(r.own_id, {new_id('product', 'r.dp_name')}) AS id, r.dp_name AS name, r.domain_id AS domain,
    r.outcome, CASE WHEN r.outcome = 'failed' THEN 'Invalid domain UUID' END AS error,
    CASE WHEN r.outcome = 'created' THEN '{{"name":' || {quoted('r.dp_name')} || ',"domain":' || {quoted('r.domain_id')}
      || ',"status":' || {quoted('r.dp_status')} || ',"type":' || {quoted('r.dp_type')} || ',"description":'
      || {quoted('r.dp_description')} || ',"businessUse":' || {quoted('r.dp_businessUse')} || ',"contacts":{{"owner":'
      || {id_list('o.ids')} || '}},"updateFrequency":' || {quoted('r.dp_updateFrequency')} || '}}' END AS record
    FROM c_products r LEFT JOIN o_products o ON o.cell = r.dp_owners""",
    "c_products", "o_products",
)
oracle(
    "plan_okrs",
    f"""SELECT r._row, coalesce(r.own_id, {new_id('okr', 'r.domain_id', 'r.definition')}) AS id, r.definition,
    r.domain_id AS domain, r.outcome, r.error,
    CASE WHEN r.error IS NULL THEN coalesce(array_to_string(o.bad, ','), '') ELSE '' END AS unknown_owners,
    CASE WHEN r.outcome = 'created' THEN '{{"definition":' || {quoted('r.definition')} || ',"domain":' || {quoted('r.domain_id')}
      || ',"targetDate":"' || r.target_date || '","contacts":{{"owner":' || {id_list('o.ids')} || '}},"status":'
      || {quoted('r.status')} || '}}' END AS record
    FROM r_okrs r LEFT JOIN o_okrs o ON o.cell = r.owner""",
    "r_okrs", "o_okrs",
)
oracle(
    "cde_columns",
    f"""SELECT DISTINCT cde_id, column_id, asset_id, name AS column_name,
    '{{"name":"' || name || '","dataType":"' || type || '","description":"' || description || '","classifications":'
      || {CLASSES} || ',"assetName":"' || asset_name || '","assetId":"' || asset_id || '","domain":"' || domain_id || '"}}' AS record
    FROM k_cdes""",
    "k_cdes",
)


def edge_sql(source: str, target: str, entity: str, relation: str, rows: str, description: str = "''") -> str:
    return f"""SELECT {source} AS source_id, {target} AS target_id, '{entity}' AS entity_type,
    '{relation}' AS relationship_type, {description} AS description,
    CASE WHEN {target} IS NULL THEN 'skipped_no_target' WHEN {source} IS NULL THEN 'skipped_no_source' ELSE 'planned' END AS outcome
    FROM {rows}"""


TERM_ID = f"coalesce(own_id, {new_id('term', 'domain_id', NAME)})"
TERM_PRODUCTS = "(SELECT t.*, p.id AS product_id FROM r_terms t LEFT JOIN x_products p ON p.name = t.glossary_term_data_product)"
PRODUCT_ASSETS = """(SELECT p.id AS product_id, a.description, CASE WHEN a.description IS NOT NULL THEN a.asset_id END AS target
        FROM x_asset_file f JOIN x_products p ON p.name = f.dp_name LEFT JOIN usable_assets a
        ON a.fqn = f.data_asset_fqn AND a.account = f.data_asset_account)"""
oracle("edges_synonym", edge_sql(TERM_ID, "synonyms_uuid", "Term", "Synonym", "r_terms"), "r_terms")
oracle("edges_related", edge_sql(TERM_ID, "related_uuid", "Term", "related", "r_terms"), "r_terms")
oracle(
    "edges_product",
    edge_sql(
        TERM_ID, "product_id", "DataProduct", "related",
        TERM_PRODUCTS,
    ),
    "r_terms", "x_products",
)
oracle(
    "edges_cde",
    """SELECT DISTINCT source_id, column_id AS target_id, 'CriticalDataColumn' AS entity_type, 'Related' AS relationship_type,
    '' AS description FROM (SELECT cde_id AS source_id, column_id FROM k_cdes UNION ALL SELECT asset_id, column_id FROM k_cdes)""",
    "k_cdes",
)
oracle(
    "edges_asset",
    edge_sql(
        "product_id", "target", "DataAsset", "Related",
        PRODUCT_ASSETS,
        "description",
    ),
    "x_asset_file", "x_products", "usable_assets",
)
NEW = "list_filter(m.members, lambda x: NOT list_contains({0}, x))"


def text_list(items: str) -> str:
    return f"""CASE WHEN len({items}) = 0 THEN '[]' ELSE '["' || array_to_string({items}, '","') || '"]' END"""


def policy_rule(name: str, items: str) -> str:
    return (
        """'{"dnfCondition":[[{"attributeName":"principal.id","attributeValueIncludedIn":' || """
        + text_list(items)
        + """ || '},{"attributeName":"principal.group","attributeValueIncludedIn":["everyone"]}]],"""
        + f""""kind":"attributerule","name":"{name}"}}'"""
    )


MERGED = f"list_concat(h.included, {NEW.format('h.included')})"
NOBODY = "[]::VARCHAR[]"
MERGED_POLICIES = f"""SELECT h.id, '{{"id":"' || h.id || '","name":"' || h.name || '","properties":{{"attributeRules":[' ||
      {policy_rule('member', MERGED)} || CASE WHEN h.name LIKE '{QUALITY_POLICY}%' THEN ',' || {policy_rule('reader', NOBODY)}
        || ',' || {policy_rule('steward', 'm.members')} ELSE '' END ||
      '],"collection":{{"number":' || cast(h.k AS varchar) || ',"type":"CollectionReference"}},"decisionRules":[{{"effect":"Permit","kind":"decisionrule"}}],'
      || '"description":"policy"}},"version":1}}' AS document
    FROM held h JOIN members m ON h.name IN ('{DOMAIN_POLICY}' || m.id, '{QUALITY_POLICY}' || m.id)
    WHERE len({NEW.format('h.included')}) > 0 OR (h.name LIKE '{QUALITY_POLICY}%' AND len(m.members) > 0)"""
oracle("policy_merge", MERGED_POLICIES, "held", "members")
HAS_TEXTS = "contains(text, 'Error converting value') AND contains(text, 'entityId')"
oracle(
    "classify_outcomes",
    f"""SELECT event_id, operation, code, CASE
      WHEN operation IN ('domain', 'term') THEN CASE code WHEN 201 THEN 'created' WHEN 409 THEN 'existing' ELSE 'failed' END
      WHEN operation = 'synonym' THEN CASE WHEN code = 200 THEN 'updated' WHEN code = 409 THEN 'existing'
        WHEN code = 400 AND {HAS_TEXTS} THEN 'no_value' ELSE 'failed' END
      WHEN operation = 'related' THEN CASE WHEN code = 200 THEN 'updated' WHEN code = 400 AND {HAS_TEXTS} THEN 'no_value'
        WHEN code = 400 THEN 'failed' ELSE 'ignored' END
      WHEN operation = 'term_product' THEN CASE code WHEN 200 THEN 'updated' WHEN 400 THEN 'skipped' ELSE 'failed' END
      WHEN operation = 'product' AND status IS NOT NULL AND type IS NOT NULL AND id IS NOT NULL THEN 'succeeded'
      WHEN code IN (200, 201) THEN 'succeeded' ELSE 'failed' END AS outcome FROM x_answers""",
    "x_answers",
)
oracle(
    "load_report",
    """SELECT concept, outcome, count(*) AS rows FROM (
      SELECT 'domain' AS concept, outcome FROM r_domains UNION ALL SELECT 'product', outcome FROM c_products
      UNION ALL SELECT 'okr', outcome FROM r_okrs
      UNION ALL SELECT 'okr_owner', 'failed' FROM (
        SELECT unnest(o.bad) FROM r_okrs r JOIN o_okrs o ON o.cell = r.owner WHERE r.error IS NULL))
    GROUP BY concept, outcome""",
    "r_domains", "c_products", "r_okrs", "o_okrs",
)
ELEMENT_ENDS = "(SELECT cde_id AS source_id, column_id FROM k_cdes UNION ALL SELECT asset_id, column_id FROM k_cdes)"
EDGES = {
    "synonym": edge_sql(TERM_ID, "synonyms_uuid", "Term", "Synonym", "r_terms"),
    "related": edge_sql(TERM_ID, "related_uuid", "Term", "related", "r_terms"),
    "term_product": edge_sql(TERM_ID, "product_id", "DataProduct", "related", TERM_PRODUCTS),
    "element_column": edge_sql("source_id", "column_id", "CriticalDataColumn", "Related", ELEMENT_ENDS),
    "product_asset": edge_sql("product_id", "target", "DataAsset", "Related", PRODUCT_ASSETS, "description"),
}
EDGE_NEEDS = ("r_terms", "x_products", "k_cdes", "x_asset_file", "usable_assets")
oracle(
    "load_report_full",
    f"""SELECT concept, outcome, count(*) AS rows FROM (
      SELECT 'domain' AS concept, outcome FROM r_domains UNION ALL SELECT 'product', outcome FROM c_products
      UNION ALL SELECT 'okr', outcome FROM r_okrs
      UNION ALL SELECT 'okr_owner', 'failed' FROM (
        SELECT unnest(o.bad) FROM r_okrs r JOIN o_okrs o ON o.cell = r.owner WHERE r.error IS NULL)
      UNION ALL SELECT 'term', CASE WHEN domain_id IS NULL THEN 'failed' WHEN own_id IS NOT NULL THEN 'existing' ELSE 'created' END FROM p_terms
      UNION ALL SELECT 'cde', action FROM r_cdes
      UNION ALL SELECT 'cde_owner', 'failed' FROM (
        SELECT unnest(o.bad) FROM r_cdes r JOIN o_cdes o ON o.cell = r.cde_owner WHERE r.action <> 'failed')
      UNION ALL SELECT 'asset', CASE WHEN a.kept_id IS NOT NULL THEN 'reuse' WHEN a.guid IS NOT NULL THEN coalesce(a.built, 'failed') ELSE 'failed' END
        FROM x_asset_file f LEFT JOIN asset_by_path a ON a.fqn = f.data_asset_fqn AND a.account = f.data_asset_account
      {" ".join(f"UNION ALL SELECT '{name}', outcome FROM ({sql})" for name, sql in EDGES.items())})
    GROUP BY concept, outcome""",
    "r_domains", "c_products", "r_okrs", "o_okrs", "p_terms", "r_cdes", "o_cdes", "asset_by_path", *EDGE_NEEDS,
)
oracle("outcome_names", "SELECT dp_name AS key FROM c_products WHERE outcome = 'created'", "c_products")
oracle(
    "next_snapshot",
    f"""SELECT id, name, type FROM x_products UNION ALL
    SELECT {new_id('product', 'dp_name')}, dp_name, dp_type FROM c_products WHERE outcome = 'created'""",
    "x_products", "c_products",
)

NEXT = {
    "domains": f"""SELECT id, name, type FROM x_domains UNION ALL
    SELECT {new_id('domain', DOMAIN)}, {DOMAIN}, business_domain_type FROM r_domains WHERE outcome = 'created'""",
    "terms": f"""SELECT id, name, domain, parentId FROM x_terms UNION ALL
    SELECT {new_id('term', 'domain_id', NAME)}, {NAME}, domain_id, parent_id FROM p_terms WHERE domain_id IS NOT NULL AND own_id IS NULL""",
    "okrs": f"""SELECT id, definition, status, domain FROM x_okrs UNION ALL
    SELECT {new_id('okr', 'domain_id', 'definition')}, definition, status, domain_id FROM r_okrs WHERE outcome = 'created'""",
    "cdes": """SELECT id, name, domain, dataType, status FROM x_cdes UNION ALL
    SELECT cde_id, cde_name, domain_id, cde_dataType, cde_status FROM r_cdes WHERE action = 'create'""",
    "assets": """SELECT id, name, type, dataMapAssetId, description FROM x_assets UNION ALL
    SELECT DISTINCT a.new_asset_id, r.name, r.type, a.guid, r.description
    FROM x_asset_file f JOIN asset_by_path a ON a.fqn = f.data_asset_fqn AND a.account = f.data_asset_account
    JOIN r_assets r ON r.guid = a.guid WHERE a.kept_id IS NULL AND a.built = 'create'""",
}
NEXT_NEEDS = {
    "domains": ("x_domains", "r_domains"),
    "terms": ("x_terms", "p_terms"),
    "okrs": ("x_okrs", "r_okrs"),
    "cdes": ("x_cdes", "r_cdes"),
    "assets": ("x_assets", "x_asset_file", "asset_by_path", "r_assets"),
}
for concept, sql in NEXT.items():
    oracle(f"next_snapshot_{concept}", sql, *NEXT_NEEDS[concept])
ENDS = "source_id, target_id, entity_type, relationship_type"
oracle(
    "next_snapshot_edges",
    f"""SELECT {ENDS}, description FROM x_edges UNION ALL
    SELECT {ENDS}, min(description) FROM ({" UNION ALL ".join(f"SELECT * FROM ({sql})" for sql in EDGES.values())}) p
    WHERE outcome = 'planned' AND NOT EXISTS (SELECT 1 FROM x_edges e WHERE e.source_id = p.source_id AND e.target_id = p.target_id
      AND e.entity_type = p.entity_type AND e.relationship_type = p.relationship_type)
    GROUP BY {ENDS}""",
    "x_edges", *EDGE_NEEDS,
)


def given_rule(name: str, items: str) -> str:
    return (
        f"""'{{"kind":"attributerule","name":"{name}","dnfCondition":[[{{"attributeName":"principal.id","attributeValueIncludedIn":' || """
        + text_list(items)
        + """ || '},{"attributeName":"principal.group","attributeValueIncludedIn":["everyone"]}]]}'"""
    )


oracle(
    "next_snapshot_policies",
    f"""SELECT h.id, coalesce(c.document, '{{"id":"' || h.id || '","name":"' || h.name || '","version":1,"properties":{{"description":"policy","attributeRules":['
      || {given_rule('member', 'h.included')} || CASE WHEN h.name LIKE '{QUALITY_POLICY}%' THEN ',' || {given_rule('reader', NOBODY)}
        || ',' || {given_rule('steward', NOBODY)} ELSE '' END
      || '],"decisionRules":[{{"kind":"decisionrule","effect":"Permit"}}],"collection":{{"type":"CollectionReference","number":'
      || cast(h.k AS varchar) || '}}}}}}') AS document
    FROM held h LEFT JOIN ({MERGED_POLICIES}) c ON c.id = h.id""",
    "held", "members",
)
step(
    "after_load",
    f"""
    SELECT 'products' AS concept, id, name FROM x_products UNION ALL
    SELECT 'products', {new_id('product', 'dp_name')}, dp_name FROM c_products WHERE outcome = 'created' UNION ALL
    SELECT 'okrs', id, definition FROM ({NEXT['okrs']})""",
    "x_products", "c_products", *NEXT_NEEDS["okrs"],
)
oracle(
    "published_load",
    """SELECT 1 AS version, 'products' AS concept, id, name FROM x_products UNION ALL SELECT 1, 'okrs', id, definition FROM x_okrs
    UNION ALL SELECT v, concept, id, name FROM after_load, (VALUES (2), (3)) t(v)""",
    "after_load",
)
step(
    "told_terms",
    """
    SELECT name, domain, CASE arg_max(code, _row) WHEN 201 THEN 'created' WHEN 409 THEN 'existing' ELSE 'failed' END AS answer,
      count(*) AS answers FROM x_term_answers GROUP BY name, domain""",
    "x_term_answers",
)
step(
    "reconciled",
    f"""
    SELECT coalesce(p.{NAME}, t.name) AS name, coalesce(p.domain_id, t.domain) AS domain, p.id, t.answer,
      coalesce(t.answers, 0) AS answers, CASE WHEN p.{NAME} IS NULL THEN 'stray' WHEN t.answer IS NULL THEN 'missing'
        WHEN t.answer = 'created' THEN 'confirmed' ELSE 'refused' END AS status
    FROM (SELECT {NAME}, domain_id, {new_id('term', 'domain_id', NAME)} AS id FROM p_terms WHERE domain_id IS NOT NULL AND own_id IS NULL) p
    FULL JOIN told_terms t ON t.name = p.{NAME} AND t.domain = p.domain_id""",
    "p_terms", "told_terms",
)
step("waiting", "SELECT id FROM reconciled WHERE status IN ('missing', 'refused')", "reconciled")
oracle("answers_reconciled", "SELECT * FROM reconciled", "reconciled")
oracle(
    "next_snapshot_confirmed",
    """SELECT id, name, domain, parentId FROM x_terms UNION ALL
    SELECT r.id, r.name, r.domain, p.parent_id FROM reconciled r JOIN p_terms p ON p.glossary_term_name = r.name AND p.domain_id = r.domain
    WHERE r.status = 'confirmed'""",
    "x_terms", "reconciled", "p_terms",
)
oracle(
    "edges_released",
    f"""SELECT e.* EXCLUDE (outcome), CASE WHEN outcome = 'planned' AND (source_id IN (SELECT id FROM waiting) OR target_id IN (SELECT id FROM waiting))
      THEN 'held_back' ELSE outcome END AS outcome FROM ({EDGES['synonym']} UNION ALL {EDGES['related']}) e""",
    "r_terms", "waiting",
)


def cells_sql(name: str) -> str:
    """Every cell of a file, by column."""
    columns = [c for c in INPUTS[name][0].columns if c != "_row"]
    pick = ", ".join(f"{{'name': '{c}', 'cell': cast(\"{c}\" AS varchar)}}" for c in columns)
    return f"SELECT '{name}' AS file, spot, unnest(one, recursive := true) FROM (SELECT _row AS spot, unnest([{pick}]) AS one FROM x_{name})"


FILES = ("domain_file", "term_file", "product_file", "asset_file", "okr_file", "cde_file", "typed_file")
oracle(
    "concept_column_types",
    f"""SELECT file, name AS "column", CASE WHEN other IS NOT NULL OR first.family = 'textual' THEN 'text'
        WHEN first.family = 'numeric' THEN CASE WHEN numbers THEN 'number' ELSE 'whole' END
        WHEN first.family = 'temporal' THEN CASE WHEN moments THEN 'timestamp' ELSE 'date' END
        WHEN first.family = 'logical' THEN 'boolean' END AS type,
      cells, other.spot AS conflict_row, other.cell AS conflict
    FROM (
      SELECT file, name, min(lead) AS first, count(cell) AS cells, bool_or(type = 'number') AS numbers, bool_or(type = 'timestamp') AS moments,
        min(CASE WHEN family <> lead.family AND lead.family <> 'textual' THEN {{'spot': spot, 'cell': cell, 'family': family}} END) AS other
      FROM (
        SELECT *, min(CASE WHEN family IS NOT NULL THEN {{'spot': spot, 'cell': cell, 'family': family}} END) OVER (PARTITION BY file, name) AS lead
        FROM (
          SELECT *, CASE WHEN type IN ('whole', 'number') THEN 'numeric' WHEN type = 'boolean' THEN 'logical'
            WHEN type IN ('date', 'timestamp') THEN 'temporal' WHEN type = 'text' THEN 'textual' END AS family
          FROM (
            SELECT *, CASE WHEN cell IS NULL THEN NULL WHEN regexp_matches(cell, '{WHOLE_CELL}') THEN 'whole'
              WHEN regexp_matches(cell, '{NUMBER_CELL}') THEN 'number' WHEN lower(cell) IN ('true', 'false') THEN 'boolean'
              WHEN regexp_matches(cell, '{DATE_CELL}') AND try_cast(cell AS date) IS NOT NULL THEN 'date'
              WHEN regexp_matches(cell, '{TIMESTAMP_CELL}') AND try_cast(cell AS timestamp) IS NOT NULL THEN 'timestamp' ELSE 'text' END AS type
            FROM ({" UNION ALL ".join(cells_sql(f) for f in FILES)}))))
      GROUP BY file, name)""",
    *[f"x_{f}" for f in FILES],
)
step(
    "new_terms",
    f"SELECT r.*, {new_id('term', 'domain_id', NAME)} AS new_id FROM r_terms r WHERE domain_id IS NOT NULL AND own_id IS NULL AND {NAME} IS NOT NULL",
    "r_terms",
)
step(
    "forest_nodes",
    f"""
    SELECT id, 'catalog' AS origin, name, domain, parentId AS named, parentId AS parent FROM x_terms
    UNION ALL
    SELECT n.new_id, 'load', n.{NAME}, n.domain_id, n.{PARENT}, coalesce(n.parent_uuid, p.new_id)
    FROM new_terms n LEFT JOIN new_terms p ON p.{NAME} = n.{PARENT} AND p.domain_id = n.domain_id""",
    "x_terms", "new_terms",
)
step(
    "forest_reach",
    """
    SELECT id, id AS root_id, cast(0 AS bigint) AS depth FROM forest_nodes WHERE named IS NULL
    UNION ALL
    SELECT c.id, t.root_id, t.depth + 1 FROM forest_nodes c JOIN forest_reach t ON c.parent = t.id""",
    "forest_nodes",
)
step(
    "forest_lost",
    """
    SELECT id FROM forest_nodes n WHERE named IS NOT NULL AND NOT EXISTS (SELECT 1 FROM forest_nodes p WHERE p.id = n.parent)
    UNION ALL
    SELECT c.id FROM forest_nodes c JOIN forest_lost t ON c.parent = t.id""",
    "forest_nodes",
)
oracle(
    "term_forest",
    """SELECT n.id, n.origin, n.name, n.domain, CASE WHEN p.id IS NOT NULL THEN n.parent END AS parent_id, t.root_id, t.depth,
      CASE WHEN t.id IS NOT NULL THEN 'reached' WHEN l.id IS NOT NULL THEN 'orphan' ELSE 'cycle' END AS status
    FROM forest_nodes n LEFT JOIN (SELECT DISTINCT id FROM forest_nodes) p ON p.id = n.parent
    LEFT JOIN forest_reach t ON t.id = n.id LEFT JOIN forest_lost l ON l.id = n.id""",
    "forest_nodes", "forest_reach", "forest_lost",
)
POLICY_KEY = "cast(split_part(id, '-', 3) AS bigint)"
step(
    "policy_pages",
    """
    SELECT 2 * page AS page, cast(sum(strlen(cast(to_json({'id': id, 'name': name}) AS varchar)) + 1) AS bigint) + 13 AS bytes
    FROM (SELECT *, cast(floor(cast(split_part(id, '-', 3) AS bigint) / 50) AS bigint) AS page FROM x_policies) GROUP BY page""",
    "x_policies",
)
oracle(
    "page_manifest",
    f"""SELECT page, bytes, cast((sum(bytes) OVER (ORDER BY page) - bytes) // {PAGE_TASK_BYTES} AS bigint) AS task, 'held' AS status FROM policy_pages
    UNION ALL SELECT page + 1, NULL, NULL, 'missing' FROM policy_pages WHERE page < (SELECT max(page) FROM policy_pages)""",
    "policy_pages",
)
oracle(
    "list_policies_packed",
    f"SELECT id, name, 2 * page AS page, place FROM ({listed('id, name', 'x_policies', POLICY_KEY, 'id')})",
    "x_policies",
)
