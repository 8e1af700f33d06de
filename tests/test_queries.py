"""Every query against its SQL in DuckDB, on the smallest tables."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from stewardry.queries.catalog import QUERIES
from stewardry.queries.oracle import ORACLES

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = entry.queries()[name](spark, SF_DIR)
    columns = sorted(result.columns)
    got = Counter(tuple(r) for r in result.select(*columns).collect())
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = Counter(tuple(r[p] for p in places) for r in cursor.fetchall())
    assert got and got == expected


def test_entry(spark):
    assert entry.entry(spark).count() > 0
