"""Duplicate and orphan counts through bitmaps, against plain counting."""

from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from basketlens.operators import checks

LONG = st.one_of(st.integers(-70, 70), st.integers(-(2**63), 2**63 - 1), st.sampled_from([0, 63, 64, -1, -64, -65, 2**40, 2**63 - 1, -(2**63)]))
SLOW = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def violations(report):
    return report.first().violations


@SLOW
@given(rows=st.lists(st.tuples(*[st.one_of(st.none(), st.integers(-3, 3), LONG)] * 4), max_size=60), width=st.integers(1, 4), repeat=st.integers(1, 3))
def test_surplus_rows(spark, rows, width, repeat):
    rows = [r[:width] for r in rows] * repeat
    names = [f"k{i}" for i in range(width)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} long" for n in names))
    assert violations(checks.duplicate_check("t", df, names)) == len(rows) - len(set(rows))


@SLOW
@given(child=st.lists(st.one_of(st.none(), LONG), max_size=80), parent=st.lists(st.one_of(st.none(), LONG), max_size=80))
def test_rows_without_a_parent(spark, child, parent):
    c, p = spark.createDataFrame([(x,) for x in child], "k long"), spark.createDataFrame([(x,) for x in parent], "id long")
    known = set(parent)
    assert violations(checks.orphan_check("t", c, "k", p, "id")) == sum(x is not None and x not in known for x in child)


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "bigint", "string", "decimal(9,0)"])
def test_every_type_of_key(spark, kind):
    values = [3, 3, -5, 100, None, None, 64, 64, 64]
    df = spark.createDataFrame([(v, 1) for v in values], "k int, v int").selectExpr(f"cast(k as {kind}) k", "v")
    parents = spark.createDataFrame([(3,), (100,)], "k int").selectExpr(f"cast(k as {kind}) k")
    assert violations(checks.duplicate_check("t", df, ["k"])) == sum(n - 1 for n in Counter(values).values())
    assert violations(checks.orphan_check("t", df, "k", parents, "k")) == 4


def test_words_are_shared_by_neighbouring_keys(spark):
    hot = spark.range(100_000).selectExpr("cast(if(id % 3 = 0, 7, id) as bigint) k")
    assert checks.key_words(hot, ["k"]).count() == -(-100_000 // 64)
    pairs = spark.range(4_000).selectExpr("id div 4 a", "cast(id % 4 as int) b")
    assert checks.key_words(pairs, ["a", "b"]).count() == 125  # tiles of 8 by 8
    # An orphan key with a third of all rows, in a word that has other keys too.
    parents = spark.range(100_000).filter("id <> 7").withColumnRenamed("id", "k")
    assert violations(checks.orphan_check("t", hot, "k", parents, "k")) == 33_334 + 1


def test_plan_has_no_expand_and_aggregates_by_hash(spark):
    df = spark.range(1000).selectExpr("id k", "id % 10 p", "id v")
    report = checks.key_checks("t", df, {"key": ["k", "p"]}, {"p": df.selectExpr("k as p")}, {})
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
