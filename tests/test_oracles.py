"""Every registered query against DuckDB on the smallest driver tables."""

import collections
import math
import os

import duckdb
import pytest

from driverdata.oracles import ORACLES
from driverdata.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = [f[: -len(".parquet")] for f in sorted(os.listdir(SF_DIR))] if os.path.isdir(SF_DIR) else []

pytestmark = pytest.mark.skipif(not TABLES, reason="driver tables are not there")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def plain(value):
    if isinstance(value, float) and math.isclose(value, 0.0):
        return 0.0
    return value


def bag(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]
    return collections.Counter(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_a_comparison():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    rows = df.collect()
    assert rows
    if name in ORACLES:
        found = duck.execute(ORACLES[name])
        columns = [d[0] for d in found.description]
        assert sorted(columns) == sorted(df.columns)
        assert bag(df.columns, rows) == bag(columns, found.fetchall())
