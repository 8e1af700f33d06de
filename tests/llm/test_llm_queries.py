"""The queries of the folder that SQL can express, against DuckDB."""

import os
from collections import Counter

import duckdb
import pytest
from stewardry.llm.oracle import ORACLES
from stewardry.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


def rounded(value):
    return round(value, 9) if isinstance(value, float) else value


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    got = Counter(tuple(map(rounded, r)) for r in result.select(*columns).collect())
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark", "labels"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = Counter(tuple(rounded(r[p]) for p in places) for r in cursor.fetchall())
    assert got and got == expected
