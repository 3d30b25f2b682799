"""Every query that has SQL against DuckDB on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for file in os.listdir(DIR):
        con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{DIR}/{file}'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else value


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, database, name):
    result = entry.queries()[name](spark, DIR)
    columns = sorted(result.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in result.collect())
    rows = database.sql(entry.oracle_sql()[name])
    assert sorted(rows.columns) == columns
    at = [rows.columns.index(c) for c in columns]
    assert got == sorted(repr([plain(r[i]) for i in at]) for r in rows.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["path", "ch"]
