import json

import pytest
from pyspark.sql import functions as F

from stewardry.plans import apply, cdes, domains, edges, okrs, outcomes, products, terms

USERS = [("a@x", "A"), ("b@x", "B")]


def frame(spark, columns, rows):
    kinds = ", ".join(f"{c} {'long' if c == '_row' else 'string'}" for c in columns.split())
    return spark.createDataFrame(rows, kinds)


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame(USERS, "mail string, id string")


@pytest.fixture(scope="module")
def catalog(spark):
    return frame(spark, "_row id name type", [(0, "d1", "Sales", "t"), (1, "d1b", "Sales", "t"), (2, "d2", "Ops", "t")])


def domain_file(spark):
    columns = (
        "_row business_domain_name business_domain_parent business_domain_email_owners "
        "business_domain_status business_domain_type business_domain_description"
    )
    rows = [
        (0, "Sales", None),
        (1, "EU", "Sales"),
        (2, "FR", "EU"),
        (3, "FR", "EU"),
        (4, "XX", "Nope"),
        (5, None, "Sales"),
    ]
    return frame(spark, columns, [(r, n, p, "a@x", "Draft", "T", 'say "x"') for r, n, p in rows])


def test_domain_plan(spark, catalog):
    plan = {r._row: r for r in domains.plan_domains(domain_file(spark), catalog).collect()}
    assert [plan[i].outcome for i in range(6)] == ["existing", "created", "created", "existing", "created", "failed"]
    assert plan[0].id == "d1" and plan[1].parent_id == "d1"
    assert plan[2].parent_id == plan[1].id and plan[2].id == plan[3].id
    assert json.loads(plan[4].record) == {
        "name": "XX", "owners": "a@x", "status": "Draft", "type": "T", "description": 'say "x"', "parentId": None,
    }


def test_strict_parents_come_from_the_catalog_only(spark, catalog):
    plan = {r._row: r.parent_id for r in domains.plan_domains(domain_file(spark), catalog, strict=True).collect()}
    assert plan == {0: None, 1: "d1", 2: None, 3: None, 4: None, 5: "d1"}
    given = domain_file(spark).withColumn("business_domain_parent_guid", F.lit("g"))
    assert {r.parent_id for r in domains.plan_domains(given, catalog).collect()} == {"g"}


def test_applying_a_plan_makes_the_next_load_create_nothing(spark, catalog):
    file = domain_file(spark)
    new = apply.created(domains.plan_domains(file, catalog), {"id": "id", "name": "name", "type": "type"})
    bigger = apply.next_snapshot(catalog.drop("_row"), new, ["name"])
    assert bigger.count() == 6
    assert apply.next_snapshot(bigger, new, ["name"]).count() == 6
    again = domains.plan_domains(file, bigger.withColumn("_row", F.monotonically_increasing_id()))
    assert {r.outcome for r in again.collect()} == {"existing", "failed"}


def test_versions_are_never_overwritten(spark, catalog, tmp_path):
    apply.write_version(catalog, str(tmp_path / "v1"))
    assert spark.read.parquet(str(tmp_path / "v1")).count() == 3
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        apply.write_version(catalog, str(tmp_path / "v1"))


TERM_COLUMNS = (
    "_row glossary_term_name business_domain_name glossary_term_parent_term glossary_term_description "
    "glossary_term_status glossary_term_owner glossary_term_expert glossary_term_database_admin "
    "glossary_term_acronyms glossary_term_synonyms glossary_term_synonyms_domain glossary_term_related "
    "glossary_term_related_domain glossary_term_data_product"
)


def term_file(spark):
    def row(i, name, domain, parent, acronym=None, synonym=None, related=None, product=None):
        return (i, name, domain, parent, "d", "Draft", "a@x,b@x", None, "who@x", acronym, synonym, "Ops", related, "Ops", product)

    rows = [
        row(0, "root", "Sales", None, acronym="R"),
        row(1, "child", "Sales", "root", synonym="held", related="nope", product="P"),
        row(2, "child", "Sales", "zzz"),
        row(3, "held", "Ops", None),
        row(4, "under", "Ops", "held"),
        row(5, "lost", "Ops", "gone"),
        row(6, "x", "Nowhere", None),
        row(7, "loop1", "Ops", "loop2"),
        row(8, "loop2", "Ops", "loop1"),
        row(9, "root", "Sales", None),
    ]
    return frame(spark, TERM_COLUMNS, rows)


@pytest.fixture(scope="module")
def term_catalog(spark):
    return frame(spark, "_row id name domain parentId", [(0, "t-held", "held", "d2", None)])


def test_term_plan(spark, catalog, term_catalog, users):
    plan = {r.name: r for r in terms.plan_terms(term_file(spark), catalog, term_catalog, users).collect()}
    assert {n: r.outcome for n, r in plan.items()} == {
        "root": "created", "child": "created", "held": "existing", "under": "created", "lost": "created",
        "x": "failed", "loop1": "created", "loop2": "created",
    }
    # The greatest parent name wins among repeats; it is not there.
    assert plan["child"]._row == 2 and plan["child"].parent_missing
    assert plan["under"].parent_id == "t-held"
    assert plan["lost"].parent_missing and plan["lost"].parent_id is None
    assert plan["x"].error == "Invalid domain UUID" and plan["x"].id is None
    # A cycle is broken at the row that stands first.
    assert plan["loop1"].parent_id is None and plan["loop2"].parent_id == plan["loop1"].id
    assert json.loads(plan["root"].record) == {
        "name": "root", "description": "d", "status": "Draft",
        "contacts": {"owner": [{"id": "A"}, {"id": "B"}], "expert": [], "database_admin": []},
        "acronyms": ["R"], "domain": "d1",
    }
    assert json.loads(plan["loop2"].record)["parentId"] == plan["loop1"].id


def test_created_terms_are_not_in_the_catalog(spark, catalog, term_catalog, users):
    plan = terms.plan_terms(term_file(spark), catalog, term_catalog, users)
    new = apply.created(plan, {"id": "id", "name": "name", "domain": "domain", "parent_id": "parentId"})
    assert new.join(term_catalog, ["name", "domain"]).count() == 0
    bigger = apply.next_snapshot(term_catalog.drop("_row"), new, ["name", "domain"])
    again = terms.plan_terms(term_file(spark), catalog, bigger.withColumn("_row", F.monotonically_increasing_id()), users)
    assert {r.outcome for r in again.collect()} == {"existing", "failed"}


def test_term_edges(spark, catalog, term_catalog):
    rows = terms.resolve_ids(term_file(spark).where("_row IN (1, 3, 6)"), catalog, term_catalog)
    synonyms = {r.source_id: r for r in edges.synonym_edges(rows).collect()}
    assert sorted(r.outcome for r in synonyms.values()) == ["planned"] + ["skipped_no_target"] * 2
    assert [r.outcome for r in edges.related_edges(rows).collect()] == ["skipped_no_target"] * 3
    known = frame(spark, "id name", [("p1", "P"), ("p2", "P")])
    linked = edges.planned(edges.product_edges(terms.with_product(rows, known))).collect()
    assert {r.target_id for r in linked} == {"p1", "p2"}
    assert {(r.entity_type, r.relationship_type, r.description) for r in linked} == {("DataProduct", "related", "")}


def test_first_loader_lookups(spark):
    known = frame(spark, "Name ID", [("root", "1"), ("root", "2"), ("held", "3")])
    file = term_file(spark).where("_row IN (0, 1, 3)")
    rows = terms.resolve_by_name(file, known)
    assert {"glossary_term_parent_term", "glossary_term_synonyms", "glossary_term_related"}.isdisjoint(rows.columns)
    got = sorted((r._row, r.glossary_term_name_id, r.glossary_term_parent_term_id, r.glossary_term_synonyms_id) for r in rows.collect())
    assert got == [(0, "1", "", ""), (0, "2", "", ""), (1, "", "1", "3"), (1, "", "2", "3"), (3, "3", "", "")]
    kept = {r._row: (r.glossary_term_name_id, r.glossary_term_parent_term_id) for r in terms.dedupe_by_parent_id(rows).collect()}
    assert kept == {0: ("1", ""), 1: ("", "1"), 3: ("3", "")}


def test_product_plan(spark, catalog, users):
    columns = "_row dp_name business_domain_name dp_status dp_type dp_description dp_businessUse dp_owners dp_updateFrequency"
    rows = [(0, "P", "Nope"), (1, "P", "Sales"), (2, "P", "Ops"), (3, "Old", "Ops"), (4, "Q", None), (5, None, "Ops")]
    file = frame(spark, columns, [(i, n, d, "s", "t", "d", None, "a@x,who@x", "Daily") for i, n, d in rows])
    held = frame(spark, "_row id name type", [(0, "old", "Old", "t")])
    plan = {r._row: r for r in products.plan_products(file, catalog, held, users).collect()}
    assert [plan[i].outcome for i in range(6)] == ["failed", "created", "existing", "existing", "failed", "failed"]
    assert [plan[i].error for i in (4, 5)] == ["Invalid domain UUID", "Missing name"]
    assert json.loads(plan[1].record) == {
        "name": "P", "domain": "d1", "status": "s", "type": "t", "description": "d", "businessUse": None,
        "contacts": {"owner": [{"id": "A"}]}, "updateFrequency": "Daily",
    }


def test_objective_plan(spark, catalog, users):
    rows = [
        (0, "o1", "Sales", "1-31-2024", "a@x,who@x", "s"),
        (1, "o1", "Sales", "01-31-2024", "a@x", "s"),
        (2, "o1", "Ops", "01-31-2024", None, "s"),
        (3, "o2", "Nope", "01-31-2024", "who@x", "s"),
        (4, "o3", "Ops", "31-01-2024", "who@x", "s"),
        (5, "old", "Ops", "01-31-2024", "who@x", "s"),
        (6, None, "Ops", "01-31-2024", None, "s"),
    ]
    file = frame(spark, "_row definition domain targetDate owner status", rows)
    held = frame(spark, "_row id definition status domain", [(0, "okr", "old", "s", "d2")])
    planned = okrs.plan_okrs(file, catalog, held, users)
    plan = {r._row: r for r in planned.collect()}
    assert [plan[i].outcome for i in range(6)] == ["created", "existing", "created", "failed", "failed", "existing"]
    assert [plan[i].error for i in (3, 4, 6)] == ["Invalid domain UUID", "Invalid target date", "Missing name"]
    assert json.loads(plan[0].record) == {
        "definition": "o1", "domain": "d1", "targetDate": "2024-01-31T00:00:00.000000Z",
        "contacts": {"owner": [{"id": "A"}]}, "status": "s",
    }
    failures = outcomes.owner_failures(planned, "okr", "definition", "unknown_owners")
    assert sorted((r.key, r.mail) for r in failures.collect()) == [("o1", "who@x"), ("old", "who@x")]
    counts = {(r.concept, r.outcome): r.rows for r in outcomes.report(outcomes.outcomes(planned, "okr", "definition"), failures).collect()}
    assert counts == {("okr", "created"): 2, ("okr", "existing"): 2, ("okr", "failed"): 5}
    names = outcomes.names(outcomes.outcomes(planned, "okr", "definition"), "okr", "failed")
    assert {r.key for r in names.collect()} == {"o2", "o3", None}


def test_objectives_beyond_the_first_page_still_exist(spark, catalog, users):
    held = frame(spark, "_row id definition status domain", [(i, f"i{i}", f"o{i:03}", "s", "d2") for i in range(60)])
    file = frame(spark, "_row definition domain targetDate owner status", [(0, "o050", "Ops", "01-01-2024", None, "s")])
    assert okrs.plan_okrs(file, catalog, held, users).first().outcome == "existing"
    assert [r.definition for r in okrs.okr_page(held).orderBy("position").collect()] == [f"o{i:03}" for i in range(25)]


def test_element_plan_and_columns(spark, catalog, users):
    columns = "_row cde_name business_domain_name cde_dataType cde_owner cde_description cde_status cde_fqdn cde_column_name"
    rows = [(0, "e", "Sales", "f1", "COL"), (1, "e", "Sales", "f1", "col"), (2, "old", "Ops", "f1", "no"), (3, "e", "Nope", "f1", "col"), (4, "e", "Ops", "f2", "col")]
    file = frame(spark, columns, [(i, n, d, "Text", "a@x,who@x", "d", "s", f, c) for i, n, d, f, c in rows])
    held = frame(spark, "_row name domain dataType status id", [(0, "old", "d2", "Text", "s", "c-old")])
    planned = cdes.plan_cdes(file, catalog, held, users)
    plan = {r._row: r for r in planned.collect()}
    assert [plan[i].action for i in range(5)] == ["create", "update", "update", "failed", "create"]
    assert plan[0].id == plan[1].id != plan[4].id and plan[2].id == "c-old"
    assert [plan[i].unknown_owners for i in range(5)] == [["who@x"]] * 3 + [[], ["who@x"]]
    paths = spark.createDataFrame(
        [("f1", "as1", "Asset", [("Col", "cd", ["P"], "int")]), ("f2", None, None, None)],
        "fqn string, asset_id string, asset_name string, "
        "schema array<struct<name string, description string, classifications array<string>, type string>>",
    )
    made = cdes.cde_columns(planned, paths).collect()
    assert len(made) == 1 and made[0].cde_id == plan[0].id
    assert json.loads(made[0].record) == {
        "name": "Col", "dataType": "int", "description": "cd", "classifications": ["P"],
        "assetName": "Asset", "assetId": "as1", "domain": "d1",
    }
    linked = edges.planned(edges.cde_edges(cdes.cde_columns(planned, paths))).collect()
    assert {(r.source_id, r.target_id) for r in linked} == {(plan[0].id, made[0].column_id), ("as1", made[0].column_id)}


def test_assets_without_a_description_get_no_edge(spark):
    file = frame(spark, "_row dp_name asset_id description", [(0, "P", "a1", ""), (1, "P", "a2", None), (2, "P", None, None), (3, "Z", "a1", "")])
    known = frame(spark, "id name", [("p1", "P"), ("p2", "P")])
    out = edges.asset_edges(edges.with_products(file, known)).collect()
    assert sorted((r.source_id, r.target_id, r.outcome) for r in out if r.target_id) == [
        ("p1", "a1", "planned"), ("p2", "a1", "planned"),
    ]
    assert len(out) == 6


def test_answers(spark):
    both = "Error converting value x at entityId"
    cases = [
        ("domain", 201, "", None, "created"), ("term", 409, "", None, "existing"), ("term", 500, "", None, "failed"),
        ("synonym", 200, "", None, "updated"), ("synonym", 409, "", None, "existing"), ("synonym", 400, both, None, "no_value"),
        ("synonym", 400, "entityId", None, "failed"), ("synonym", 500, both, None, "failed"), ("synonym", 400, None, None, "failed"),
        ("related", 409, "", None, "ignored"), ("related", 400, both, None, "no_value"), ("related", 400, "x", None, "failed"),
        ("term_product", 400, "x", None, "skipped"), ("term_product", 409, "x", None, "failed"),
        ("product", 500, "", "s", "succeeded"), ("product", 500, "", None, "failed"), ("product", 200, "", None, "succeeded"),
        ("okr", 201, "", None, "succeeded"), ("cde", 409, "", None, "failed"),
    ]
    rows = spark.createDataFrame(
        [(i, o, c, t, s, s, s) for i, (o, c, t, s, _) in enumerate(cases)],
        "i int, operation string, code int, text string, status string, type string, id string",
    )
    out = [r.outcome for r in outcomes.classify(rows).orderBy("i").collect()]
    assert out == [c[-1] for c in cases]


def test_answers_against_a_plan(spark):
    plan = frame(spark, "_row id name domain outcome", [
        (0, "i1", "a", "d", "created"), (1, "i2", "b", "d", "created"), (2, "i3", "c", "d", "created"),
        (3, "i4", "e", "d", "existing"), (4, "i5", "f", "d", "created"),
    ])
    told = [(0, "a", "d", 500), (1, "a", "d", 201), (2, "b", "d", 201), (3, "b", "d", 400), (4, "z", "d", 201), (5, None, "d", 201), (6, "f", "d", 409)]
    answers = spark.createDataFrame(
        [(i, n, d, "term", c, None, None, None, None) for i, n, d, c in told],
        "_row long, name string, domain string, operation string, code int, text string, status string, type string, id string",
    )
    found = outcomes.reconcile(plan, answers, ["name", "domain"])
    assert {r.name: (r.id, r.status, r.answer, r.answers) for r in found.collect()} == {
        "a": ("i1", "confirmed", "created", 2), "b": ("i2", "refused", "failed", 2), "c": ("i3", "missing", None, 0),
        "f": ("i5", "refused", "existing", 1), "z": (None, "stray", "created", 1),
    }
    assert [r.id for r in outcomes.confirmed(plan, found).collect()] == ["i1"]
    ends = frame(spark, "source_id target_id outcome", [("i1", "x", "planned"), ("i2", "x", "planned"), ("x", "i3", "planned"), ("i3", None, "skipped_no_target")])
    assert sorted((r.source_id, r.outcome) for r in outcomes.release(ends, found).collect()) == [
        ("i1", "planned"), ("i2", "held_back"), ("i3", "skipped_no_target"), ("x", "held_back"),
    ]


def test_first_loader_without_fan_out(spark):
    known = frame(spark, "Name ID", [("root", f"{i:04}") for i in range(1000)] + [("held", None), ("held", ""), ("held", "7"), ("child", None)])
    file = term_file(spark)
    kept = terms.first_by_name(file, known)
    wanted = terms.dedupe_by_parent_id(terms.resolve_by_name(file.where("_row NOT IN (0, 1, 2, 9)"), known))
    assert {tuple(r) for r in wanted.collect()} <= {tuple(r) for r in kept.select(*wanted.columns).collect()}
    rows = {r.glossary_term_name: r for r in kept.collect()}
    assert len(rows) == kept.count() and rows["root"].glossary_term_name_id == "0000"
    assert (rows["child"]._row, rows["child"].glossary_term_parent_term_id) == (1, "0000")
    assert (rows["under"].glossary_term_parent_term_id, rows["held"].glossary_term_name_id) == ("7", "")


def test_forest_of_catalog_and_load(spark, catalog):
    held = frame(spark, "_row id name domain parentId", [
        (0, "t1", "held", "d2", None), (1, "t2", "below", "d2", "t1"), (2, "t3", "lost", "d2", "gone"), (3, "t4", "turn", "d2", "t5"), (4, "t5", "round", "d2", "t4"),
    ])
    rows = [(0, "held", "d2", None), (1, "new", "d2", "below"), (2, "newer", "d2", "new"), (3, "root", "d1", None), (4, "stray", "d1", "held"),
            (5, "under stray", "d1", "stray"), (6, "a", "d1", "b"), (7, "b", "d1", "a"), (8, "x", None, "root"), (9, "on lost", "d2", "lost")]
    columns = f"_row {terms.NAME} {terms.DOMAIN_ID} {terms.PARENT}"
    found = terms.catalog_forest(frame(spark, columns, rows), held).collect()
    facts = {(r.origin, r.name): (r.status, r.depth) for r in found}
    assert len(found) == len(facts) == 13
    assert facts == {
        ("catalog", "held"): ("reached", 0), ("catalog", "below"): ("reached", 1), ("catalog", "lost"): ("orphan", None),
        ("catalog", "turn"): ("cycle", None), ("catalog", "round"): ("cycle", None), ("load", "new"): ("reached", 2), ("load", "newer"): ("reached", 3),
        ("load", "root"): ("reached", 0), ("load", "stray"): ("orphan", None), ("load", "under stray"): ("orphan", None),
        ("load", "a"): ("cycle", None), ("load", "b"): ("cycle", None), ("load", "on lost"): ("orphan", None),
    }
    by_name = {r.name: r for r in found}
    assert by_name["newer"].parent_id == by_name["new"].id and by_name["newer"].root_id == "t1"
    assert by_name["stray"].parent_id is None


def test_column_ids_need_no_more_than_names(spark):
    planned = frame(spark, "id domain fqn column_name action", [("e1", "d1", "f1", "COL", "create"), ("e2", "d1", "f1", "col", "update"), ("e3", "d1", "f1", "col", "failed")])
    known = "fqn string, asset_id string, asset_name string, schema array<struct<name string{}>>"
    whole = spark.createDataFrame(
        [("f1", "a", "A", [("Col", "d", ["P"], "int"), ("COL", "d", [], "text")])], known.format(", description string, classifications array<string>, type string")
    )
    names = spark.createDataFrame([("f1", "a", "A", [("Col",), ("COL",)])], known.format(""))
    ids = cdes.cde_columns(planned, names, record=False)
    assert ids.columns == ["cde_id", "column_id", "asset_id", "column_name"]
    assert sorted(ids.collect()) == sorted(cdes.cde_columns(planned, whole).drop("record").collect()) and ids.count() == 2


def test_owner_outcomes_are_counted_without_lists(spark):
    plan = spark.createDataFrame(
        [("a", "created", None, ["x@x", "y@x"]), ("b", "failed", "E", []), ("c", "created", None, None)],
        "name string, outcome string, error string, unknown array<string>",
    )
    out = outcomes.outcomes_and_owners(plan, "okr", "name", "unknown")
    assert sorted([tuple(r) for r in out.collect()], key=str) == [
        ("okr", "a", "created", None), ("okr", "b", "failed", "E"),
        ("okr_owner", "a", "failed", outcomes.BAD_USER), ("okr_owner", "a", "failed", outcomes.BAD_USER),
    ]
    text = outcomes.report(out)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in text and "struct" not in text
