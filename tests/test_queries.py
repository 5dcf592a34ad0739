"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as spark_entry
from tools.check_queries import TABLES, rows_of


@pytest.fixture(scope="module")
def db(sf):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(spark_entry.queries()))
def test_query(spark, sf, db, name):
    df = spark_entry.queries()[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    sql = spark_entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cursor = db.execute(sql)
    columns, want = [d[0] for d in cursor.description], cursor.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, got) == rows_of(columns, want)


def test_entry(spark):
    assert spark_entry.entry(spark).columns == ["slice", "points"]
