import random

from pyspark.sql import functions as F

from stewardry.operators.dedupe import keep_first, mark_repeats
from stewardry.operators.ordering import page, positions, reorder_by_list, running_total


def test_keep_first_takes_roots_then_greatest_parent(spark):
    rows = spark.createDataFrame(
        [(0, "t", "d", "b"), (1, "t", "d", None), (2, "t", "e", "a"), (3, "t", "e", "c"), (4, None, "d", "x"), (5, None, "d", "x")],
        "_row long, name string, dom string, parent string",
    )
    out = keep_first(rows, ["name", "dom"], [F.col("parent").desc_nulls_first(), F.col("_row")])
    assert {r._row for r in out.collect()} == {1, 3, 4}


def test_only_eligible_rows_make_later_ones_repeats(spark):
    rows = spark.createDataFrame(
        [(0, "a", False), (1, "a", True), (2, "a", True), (3, "b", True), (4, None, True), (5, None, True)],
        "_row long, name string, ok boolean",
    )
    out = mark_repeats(rows, ["name"], "again", F.col("ok")).orderBy("_row").collect()
    assert [r.again for r in out] == [False, False, True, False, False, True]


def _data(spark, n=2000):
    rng = random.Random(7)
    rows = [(i, "hot" if rng.random() < 0.4 else f"g{rng.randrange(5)}", rng.choice([None, "x", "y", "z"])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "_row long, grp string, key string").repartition(7)


def test_positions_over_all_rows(spark):
    rows, frame = _data(spark)
    out = positions(frame, [F.col("key").desc_nulls_last(), F.col("_row")], "place").collect()
    expected = sorted(rows, key=lambda r: (r[2] is None, [-ord(c) for c in r[2] or ""], r[0]))
    assert {r._row: r.place for r in out} == {r[0]: i + 1 for i, r in enumerate(expected)}


def test_positions_within_groups_and_totals(spark):
    rows, frame = _data(spark)
    out = positions(frame, [F.col("_row").desc()], "place", ["grp"]).collect()
    expected, seen = {}, {}
    for row, grp, _ in sorted(rows, reverse=True):
        seen[grp] = seen.get(grp, 0) + 1
        expected[row] = seen[grp]
    assert {r._row: r.place for r in out} == expected
    sums, total = {}, {}
    for row, grp, _ in rows:
        sums[row] = total.get(grp, 0)
        total[grp] = total.get(grp, 0) + row
    out = running_total(frame, ["grp"], [F.col("_row")], F.col("_row"), "before").collect()
    assert {r._row: r.before for r in out} == sums


def test_pages_early_and_late_agree_with_sorting(spark):
    rows, frame = _data(spark)
    for skip, top in ((0, 25), (10, 5), (600, 500)):
        out = page(frame, ["grp"], [F.lit(1)], "_row", skip, top).collect()
        expected = set()
        for grp in {r[1] for r in rows}:
            mine = sorted(r[0] for r in rows if r[1] == grp)[skip : skip + top]
            expected |= {(grp, row, skip + i + 1) for i, row in enumerate(mine)}
        assert {(r.grp, r._row, r.position) for r in out} == expected


def test_reorder_repeats_rows_as_listed(spark):
    rows = spark.createDataFrame([(0, "a"), (1, "b"), (2, "a")], "_row long, name string")
    wanted = spark.createDataFrame([(0, "b"), (1, "a"), (2, "b"), (3, "zz")], "position long, key string")
    out = reorder_by_list(rows, "name", wanted).orderBy("position", "_row").collect()
    assert [(r.position, r._row) for r in out] == [(0, 1), (1, 0), (1, 2), (2, 1), (3, None)]
