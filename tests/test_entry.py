"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as registered
from tablewinnow.fixtures import BASE_TABLES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in BASE_TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(registered.table_queries()) == set(registered.table_sql())


@pytest.mark.parametrize("name", list(registered.table_queries()))
def test_query_equals_sql(spark, sql, name):
    result = registered.table_queries()[name](spark, FOLDER)
    columns = sorted(result.columns)
    found = sorted(map(repr, (tuple(r) for r in result.select(*columns).collect())))
    expected = sql.execute(f"SELECT {', '.join(columns)} FROM ({registered.table_sql()[name]})")
    assert found == sorted(map(repr, expected.fetchall()))


def test_entry(spark):
    assert registered.entry(spark).count() > 0
