from pyspark.sql import functions as F

from stewardry.operators.lookup import already_in, first_match, not_in, resolve, resolve_owners


def test_first_row_wins_and_no_row_is_lost(spark):
    rows = spark.createDataFrame([(0, "a"), (1, "b"), (2, None), (3, "a")], "_row long, name string")
    dim = spark.createDataFrame(
        [(9, "a", "late"), (2, "a", "early"), (1, None, "nobody")], "_row long, name string, id string"
    )
    out = {r._row: r.found for r in resolve(rows, dim, {"name": "name"}, {"id": "found"}).collect()}
    assert out == {0: "early", 1: None, 2: None, 3: "early"}


def test_two_keys_with_a_null_match_nothing(spark):
    rows = spark.createDataFrame([(0, "a", "x"), (1, "a", None), (2, None, "x")], "_row long, n string, d string")
    dim = spark.createDataFrame([(0, "a", "x", "i"), (1, "a", None, "j")], "_row long, name string, domain string, id string")
    out = resolve(rows, dim, {"n": "name", "d": "domain"}, {"id": "found"}).collect()
    assert {r._row: r.found for r in out} == {0: "i", 1: None, 2: None}


def test_owner_lists(spark):
    users = spark.createDataFrame([(1, "a@x", "A"), (0, "a@x", "A0"), (2, "b@x", "B")], "_row long, mail string, id string")
    cells = ["a@x", "b@x,a@x", "b@x, a@x", "a@x,,b@x", "who@x", "", None, "a@x,b@x,a@x"]
    rows = spark.createDataFrame(list(enumerate(cells)), "_row long, cell string")
    out = resolve_owners(rows, users, {"cell": "ids"}, unknown="unknown").orderBy("_row").collect()
    assert [r.ids for r in out] == [["A0"], ["B", "A0"], ["B"], ["A0", "B"], [], [], [], ["A0", "B", "A0"]]
    assert [r.unknown for r in out] == [[], [], [" a@x"], [""], ["who@x"], [""], [], []]


def test_several_roles_share_one_lookup(spark):
    users = spark.createDataFrame([("a@x", "A"), ("b@x", "B")], "mail string, id string")
    rows = spark.createDataFrame([(0, "a@x", "b@x"), (1, None, "b@x,a@x")], "_row long, one string, two string")
    out = resolve_owners(rows, users, {"one": "i", "two": "j"}).orderBy("_row").collect()
    assert [(r.i, r.j) for r in out] == [(["A"], ["B"]), ([], ["B", "A"])]


def test_new_and_existing_split_the_rows(spark):
    rows = spark.createDataFrame([(0, "a"), (1, "b"), (2, None), (3, "a")], "_row long, name string")
    catalog = spark.createDataFrame([("a",), ("a",), (None,)], "n string")
    assert {r._row for r in not_in(rows, catalog, {"name": "n"}).collect()} == {1, 2}
    assert sorted(r._row for r in already_in(rows, catalog, {"name": "n"}).collect()) == [0, 3]


def test_a_hot_key_resolves_like_any_other(spark):
    rows = spark.range(30_000).select(
        F.col("id").alias("_row"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 1000)).alias("name"),
    )
    dim = rows.select("_row", "name", F.concat(F.lit("id-"), "name").alias("id"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = resolve(rows, dim, {"name": "name"}, {"id": "found"})
        wrong = out.where(~F.col("found").eqNullSafe(F.concat(F.lit("id-"), "name"))).count()
        assert (out.count(), wrong) == (30_000, 0)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_first_row_number_of_a_key_needs_no_sort(spark):
    rows = spark.createDataFrame([(3, "a"), (1, "a"), (None, "b"), (2, None)], "_row long, k string")
    first = first_match(rows, [F.col("k").alias("key")], {"_row": "first"})
    assert {(r.key, r.first) for r in first.collect()} == {("a", 1), ("b", None)}
    assert "SortAggregate" not in first._jdf.queryExecution().executedPlan().toString()
