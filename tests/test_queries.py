"""Every registered query against its SQL over the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check_queries import TABLES, table_rows
from lakestrata.testbed import catalogue

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return connection


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_equals_sql(spark, db, name):
    df = catalogue.QUERIES[name](spark, FOLDER)
    want = db.sql(catalogue.SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert table_rows(df.columns, df.collect()) == table_rows(want.columns, want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["day_name", "hour", "trip_count"]
