"""Queries that SQL can express, against DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from basketlens.llm.queries import QUERIES, oracle_sql

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "labels"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    expected = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    result = QUERIES[name](spark, SMALL)
    assert sorted(columns) == sorted(result.columns)
    assert sorted(map(tuple, expected.fetchall())) == sorted(tuple(r) for r in result.select(*columns).collect())
