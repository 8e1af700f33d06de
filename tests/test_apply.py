"""Change sets, and versions that are published as a whole or not at all."""

import pytest
from pyspark.sql import functions as F

from stewardry.plans import apply


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.fixture
def catalog(spark):
    rows = [("a", "n1", "s"), ("b", "n2", "s"), ("b", "n2 again", "s"), (None, "n3", "s")]
    return spark.createDataFrame(rows, "id string, name string, status string")


def changes(spark, rows, columns="id string, name string, status string"):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"_row long, {columns}")


def test_inserts_and_replaces(spark, catalog):
    new = changes(spark, [("a", "held", "x"), ("c", "first", "x"), ("c", "second", "x"), (None, "no key", "x")])
    other = changes(spark, [("b", "old"), ("b", None), ("c", "done"), ("z", "nowhere"), (None, "no key")], "id string, status string")
    out = apply.merge(catalog, ["id"], new, other)
    expected = [("a", "n1", "s"), ("b", "n2", None), ("b", "n2 again", None), ("c", "first", "done"), (None, "n3", "s")]
    assert rows_of(out) == sorted(expected, key=repr)
    assert rows_of(apply.merge(out, ["id"], new, other)) == rows_of(out)
    assert rows_of(apply.merge(catalog, ["id"], new.limit(0), other.limit(0))) == rows_of(catalog)
    assert rows_of(apply.merge(catalog.limit(0), ["id"], new)) == [("a", "held", "x"), ("c", "first", "x")]


def test_a_key_alone(spark):
    held = spark.createDataFrame([("a", "b")], "source string, target string")
    new = changes(spark, [("a", "b"), ("a", "c"), ("a", "c")], "source string, target string")
    assert rows_of(apply.merge(held, ["source", "target"], new)) == [("a", "b"), ("a", "c")]


def test_versions_hold_all_their_tables(spark, catalog, tmp_path):
    store = apply.Store(spark, str(tmp_path / "store"))
    assert store.head() == (0, {}) and store.versions() == []
    edges = spark.createDataFrame([("a", "b")], "source string, target string")
    assert store.publish({"domains": catalog, "edges": edges}) == 1
    more = store.read("edges").unionByName(spark.createDataFrame([("a", "c")], edges.schema))
    assert store.publish({"edges": more}) == 2
    assert store.versions() == [1, 2]
    assert rows_of(store.read("edges")) == [("a", "b"), ("a", "c")]
    assert rows_of(store.read("edges", 1)) == [("a", "b")]
    assert rows_of(store.read("domains")) == rows_of(catalog)
    assert store.head(1)[1]["domains"] == store.head(2)[1]["domains"]


def test_an_interrupted_publish_leaves_the_old_version(spark, catalog, tmp_path):
    store = apply.Store(spark, str(tmp_path / "store"))
    store.publish({"domains": catalog, "edges": catalog})
    before = store.head()
    broken = catalog.withColumn("name", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        store.publish({"domains": catalog.limit(0), "edges": broken})
    assert store.head() == before and rows_of(store.read("domains")) == rows_of(catalog)
    store.write({"domains": catalog.limit(0)})  # ended before the head was written
    assert store.head() == before and rows_of(store.read("domains")) == rows_of(catalog)


def test_two_loads_from_one_version_conflict(spark, catalog, tmp_path):
    store = apply.Store(spark, str(tmp_path / "store"))
    base = store.publish({"domains": catalog})
    store.publish({"domains": catalog.limit(1)}, base)
    with pytest.raises(apply.Conflict):
        store.publish({"domains": catalog.limit(0)}, base)
    assert store.read("domains").count() == 1
