"""Manifests of list documents, packed lists, and the types of file columns."""

import json

from pyspark.sql import functions as F

from stewardry.sources import column_types, page_manifest
from stewardry.sources.snapshots import catalog_list


def test_pages_sizes_and_gaps(spark, tmp_path):
    for page in [*range(40), 43, 45]:
        value = [{"id": f"{page}-{k}", "name": "n" * (page % 5)} for k in range(page % 7)]
        (tmp_path / f"list-{page}.json").write_text(json.dumps({"value": value}))
    (tmp_path / "again").mkdir()
    (tmp_path / "again" / "7.json").write_text('{"value": []}')
    told = page_manifest.manifest(spark, f"{tmp_path}/{{*.json,again/*.json}}", 300).collect()
    held = sorted((r for r in told if r.status != "missing"), key=lambda r: (r.page, r.path))
    assert sorted(r.page for r in told if r.status == "missing") == [40, 41, 42, 44]
    assert {r.page for r in held if r.status == "repeated"} == {7}
    before = 0
    for row in held:
        assert row.task == before // 300
        before += row.bytes


def test_packed_lists_keep_their_order(spark, tmp_path):
    (tmp_path / "pages").mkdir()
    for page in range(30):
        (tmp_path / "pages" / f"{page}.json").write_text(json.dumps({"value": [{"id": f"{page}-{k}"} for k in range(3)]}))
    packed = page_manifest.pack(spark, str(tmp_path / "pages"), str(tmp_path / "packed"), 200)
    files = packed.groupBy(F.input_file_name()).agg(F.sort_array(F.collect_list("page")).alias("pages")).collect()
    assert len(files) > 3 and all(r.pages == list(range(r.pages[0], r.pages[-1] + 1)) for r in files)
    rows = catalog_list(packed, "users").orderBy("page", "_pos").select("id").collect()
    assert [r.id for r in rows] == [f"{page}-{k}" for page in range(30) for k in range(3)]


def test_no_files(spark, tmp_path):
    (tmp_path / "pages").mkdir()
    assert page_manifest.manifest(spark, str(tmp_path / "pages")).count() == 0


CASES = {
    "whole": (["1", None, "-20", "+3"], ("whole", 3, None, None)),
    "number": (["1", "2.5", "1e3", ".5"], ("number", 4, None, None)),
    "boolean": (["TRUE", "false", None, None], ("boolean", 2, None, None)),
    "date": (["2020-01-31", "2021-12-01", None, None], ("date", 2, None, None)),
    "moment": (["2020-01-31", "2021-12-01 10:00:00", "2021-12-01T10:00:00.5", None], ("timestamp", 3, None, None)),
    "mixed": (["1", "2", "true", "x"], ("text", 4, 2, "true")),
    "text": (["x", "1", "2", "3"], ("text", 4, None, None)),
    "no_date": (["2020-01-31", "2020-13-31", "", "1"], ("text", 4, 1, "2020-13-31")),
    "nothing": ([None] * 4, (None, 0, None, None)),
}


def test_types_of_columns(spark):
    rows = [(i, *[cells[i] for cells, _ in CASES.values()]) for i in range(4)]
    given = spark.createDataFrame(rows, "_row long, " + ", ".join(f"{c} string" for c in CASES))
    told = {r.column: tuple(r)[1:] for r in column_types.column_types(given).collect()}
    assert told == {c: expected for c, (_, expected) in CASES.items()}
    assert {r.type for r in column_types.column_types(given.limit(0)).collect()} <= {None}
