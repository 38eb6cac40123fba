"""Every registered query against its SQL."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from riskstream.plans import registry

TABLES = sorted(f[:-8] for f in os.listdir("/root/testdata/sf0.001") if f.endswith(".parquet"))


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf}/{table}.parquet'")
    return con


def by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


@pytest.mark.parametrize("name", [n for n, q in registry.QUERIES.items() if q.sql])
def test_query_agrees_with_sql(spark, sf, duck, name):
    df = entry_points.queries()[name](spark, sf)
    found = by_name(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(entry_points.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert found == by_name(columns, cursor.fetchall())


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0
