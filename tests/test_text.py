import datetime
import re

import pytest
from pyspark.sql import functions as F

from stewardry.functions import records, text


def values(spark, cells, expression):
    frame = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    return [r.v for r in frame.select("i", expression(F.col("c")).alias("v")).orderBy("i").collect()]


def test_tags_go_but_not_over_line_breaks(spark):
    cells = ["<b>hi</b>", "a < b > c", "x<\n>y", "plain", None, "<a b>z", "<<i>>", ""]
    assert values(spark, cells, text.strip_tags) == [None if c is None else re.sub("<.*?>", "", c) for c in cells]
    assert values(spark, ["x", None], text.wrap_div) == ["<div>x</div>", None]


def test_table_parts(spark):
    parts = lambda c: F.array(*text.table_path_parts(c).values())
    assert values(spark, ["mssql://s/db/dbo/t", "a/b", None, "w/x/y/z"], parts) == [
        ["s", "db", "dbo", "t"],
        [None, None, "a", "b"],
        [None] * 4,
        ["w", "x", "y", "z"],
    ]


def test_storage_parts(spark):
    parts = lambda c: F.array(*text.storage_path_parts(c).values())
    cells = ["https://h/c/p/q/{N}.csv", "https://h/c", "https://h", "https://h/c/p{x}/r"]
    assert values(spark, cells, parts) == [
        ["https://h/", "c", "p/q/"],
        ["https://h/", "c", ""],
        ["https://h/", None, ""],
        ["https://h/", "c", "p"],
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Tokyo"])
def test_target_dates(spark, zone):
    cells = ["01-31-2024", "1-5-2024", "13-45-2020", "soon", None, "02-30-2024", "2024-01-02", "10-19-2008", "012-1-2024"]

    def parse(cell):
        try:
            return datetime.datetime.strptime(cell, "%m-%d-%Y").strftime("%Y-%m-%dT%H:%M:%S.%fZ")
        except (ValueError, TypeError):
            return None

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert values(spark, cells, text.target_date_text) == [parse(c) for c in cells]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_ids_depend_on_the_parts_not_on_their_text_run_together(spark):
    rows = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("a", None)], "x string, y string")
    ids = [r.i for r in rows.select(records.stable_id("k", F.col("x"), F.col("y")).alias("i")).collect()]
    assert ids[0] != ids[1] and ids[2] is None
    assert re.fullmatch(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", ids[0])
    assert values(spark, ["a b ", None], text.without_spaces) == ["ab", None]
