import json

import pytest
from pyspark.sql import functions as F

from stewardry.schemas import TERM_OBJECT
from stewardry.sources import concept_files, snapshots


def write(folder, name, content):
    path = folder / name
    path.write_text(content, newline="")
    return str(path)


def test_cells_keep_quotes_line_breaks_digits_and_nulls(spark, tmp_path):
    path = write(
        tmp_path,
        "okr.csv",
        "status,definition,domain,targetDate,owner,extra\n"
        'Open,"Say ""hi"",\nthen go",007,01-02-2024,,x\n'
        "Closed,second,Sales,1-2-2024,a@x,y\n",
    )
    rows = concept_files.read_concepts(spark, "okr", path).orderBy("_row").collect()
    assert [r.asDict() for r in rows] == [
        {"definition": 'Say "hi",\nthen go', "domain": "007", "targetDate": "01-02-2024", "owner": None, "status": "Open", "_row": rows[0]._row},
        {"definition": "second", "domain": "Sales", "targetDate": "1-2-2024", "owner": "a@x", "status": "Closed", "_row": rows[1]._row},
    ]
    assert rows[0]._row < rows[1]._row


def test_missing_columns_are_named(spark, tmp_path):
    path = write(tmp_path, "okr.csv", "definition,domain\na,b\n")
    with pytest.raises(concept_files.MissingColumns, match="targetDate, owner, status"):
        concept_files.read_concepts(spark, "okr", path)


def test_account_column_may_carry_a_product_name(spark, tmp_path):
    path = write(tmp_path, "data_assets.csv", "dp_name,data_asset_fqn,data_asset_acme_account\np,f,acc\n")
    row = concept_files.read_concepts(spark, "data_assets", path).first()
    assert (row.dp_name, row.data_asset_fqn, row.data_asset_account) == ("p", "f", "acc")


def test_optional_columns_are_added_and_derived_ones_kept_only_when_there(spark, tmp_path):
    base = "business_domain_name,business_domain_parent,business_domain_email_owners,business_domain_status,business_domain_type,business_domain_description"
    plain = concept_files.read_concepts(spark, "business_domains", write(tmp_path, "a.csv", base + "\na,,,,,\n"))
    given = concept_files.read_concepts(
        spark, "business_domains", write(tmp_path, "b.csv", base + ",business_domain_parent_guid\na,,,,,,g\n")
    )
    assert "business_domain_parent_guid" not in plain.columns
    assert given.first().business_domain_parent_guid == "g"


def test_every_kind_can_be_written_and_read_back(spark, tmp_path):
    for kind, contract in concept_files.CONCEPT_FILES.items():
        columns = contract.required + contract.optional
        rows = [tuple([None, f'{c} "{i}"\nx', "", f"  a,b\\ {n} "][(i + n) % 4] for n, c in enumerate(columns)) for i in range(6)]
        frame = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
        path = str(tmp_path / kind)
        concept_files.write_concepts(frame, path)
        back = concept_files.read_concepts(spark, kind, path).drop("_row")
        assert back.columns == list(columns)
        # An empty cell reads as null.
        expected = frame.replace("", None)
        assert sorted(map(repr, back.collect())) == sorted(map(repr, expected.collect()))


def test_list_documents(spark, tmp_path):
    (tmp_path / "p1.json").write_text(
        json.dumps({"value": [{"id": "1", "name": "n", "domains": [{"id": "x", "k": {"a": 1}}]}, {"id": "2", "other": 5}]})
    )
    (tmp_path / "p2.json").write_text(json.dumps({"value": []}))
    pages = snapshots.read_documents(spark, str(tmp_path))
    out = snapshots.catalog_list(pages, "domains").orderBy("_pos").collect()
    assert [(r.id, r.name, r.type, r.domains) for r in out] == [
        ("1", "n", None, '[{"id":"x","k":{"a":1}}]'),
        ("2", None, None, "null"),
    ]


def test_policies_lie_under_another_key(spark):
    pages = spark.createDataFrame([('{"values": [{"id": "p", "name": "n"}]}',)], "document string")
    assert [(r.id, r.name) for r in snapshots.catalog_list(pages, "policies").collect()] == [("p", "n")]


def test_terms_of_one_domain_or_all(spark):
    terms = spark.createDataFrame([("1", "d"), ("2", "e")], "id string, domain string")
    assert snapshots.terms_of(terms).count() == 2
    assert [r.id for r in snapshots.terms_of(terms, "e").collect()] == ["2"]


def test_search_leaves_terms_out_and_keeps_untyped(spark):
    hits = spark.createDataFrame([("1", TERM_OBJECT), ("2", None), ("3", "Tables")], "id string, objectType string")
    assert {r.id for r in snapshots.searchable(hits, TERM_OBJECT).collect()} == {"2", "3"}


def test_asset_columns_in_schema_order(spark):
    detail = {"id": "a", "name": "A", "schema": [{"name": "x", "type": "int"}, {"name": "y", "classifications": ["P"]}]}
    docs = spark.createDataFrame([(json.dumps(detail),), ('{"id": "b"}',)], "document string")
    out = snapshots.asset_columns(snapshots.asset_details(docs)).orderBy("position").collect()
    assert [(r.asset_id, r.position, r.column_name, r.column_classifications, r.column_type) for r in out] == [
        ("a", 0, "x", None, "int"),
        ("a", 1, "y", ["P"], None),
    ]


def test_pages_come_in_the_order_of_their_numbers(spark, tmp_path):
    for n in (1, 2, 10):
        (tmp_path / f"page-{n}.json").write_text(json.dumps({"value": [{"id": str(n), "name": "same"}]}))
    pages = snapshots.read_documents(spark, str(tmp_path))
    rows = snapshots.numbered(snapshots.catalog_list(pages, "domains"), F.col("page"), F.col("_pos"))
    assert [r.id for r in rows.orderBy("_row").collect()] == ["1", "2", "10"]


def test_a_page_without_a_number_fails(spark, tmp_path):
    (tmp_path / "page.json").write_text("{}")
    with pytest.raises(Exception, match="no page number"):
        snapshots.read_documents(spark, str(tmp_path)).collect()
