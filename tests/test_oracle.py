"""Every named query against its SQL counterpart in DuckDB, value by value."""

from __future__ import annotations

import re

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as contract

TABLES = ("customer", "orders", "lineitem", "part", "events")
SQL = contract.oracle_sql()
QUERIES = contract.queries()
WITHOUT_SQL = {"als_recommendations"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def test_every_query_has_its_sql():
    own = {name for name in QUERIES if not re.match(r"op\d+_|pipeline$", name)}
    assert own - set(SQL) == WITHOUT_SQL
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(n for n in SQL if not re.match(r"op\d+_|pipeline$", n)))
def test_query_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SMALL)
    expected = duck.execute(SQL[name])
    columns = [d[0] for d in expected.description]
    assert sorted(columns) == sorted(result.columns)
    got = sorted(repr([r[c] for c in columns]) for r in result.collect())
    want = sorted(repr(list(r)) for r in expected.fetchall())
    assert got == want


def test_entry_returns_the_flagship_query(spark):
    assert contract.entry(spark).count() == 10
