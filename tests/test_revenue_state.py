"""Revenue marts from a growing state against the same marts from all orders."""

from __future__ import annotations

import dataclasses
import datetime as dt
import random

import pytest
from conftest import ORDERS, money, rows

from basketlens.plans import revenue
from basketlens.plans.revenue_state import RevenueState


def made(seed, n=400):
    r = random.Random(seed)
    out = []
    for i in range(n):
        when = dt.datetime(2023, 4, 1) + dt.timedelta(minutes=r.randrange(60 * 24 * 460))
        price = None if r.random() < 0.1 else money(r.randrange(10_000) / 100)
        customer = None if r.random() < 0.05 else r.choice([-5, 7, 7, 7, 2**40, *range(60)])
        out.append((i if r.random() < 0.97 else 5, customer, None if r.random() < 0.02 else when, price, r.choice(["completed", "completed", "pending"])))
    return out


def frame(spark, orders):
    return spark.createDataFrame(orders, ORDERS)


def assert_same(state, orders, p):
    for name in ("revenue_monthly", "revenue_daily", "monthly_trend"):
        assert rows(getattr(state, name)(p)) == rows(getattr(revenue, name)(orders, p)), name


@pytest.mark.parametrize("day", [dt.date(2024, 6, 15), dt.date(2024, 7, 1)])
def test_runs_with_late_rows_equal_the_whole(spark, tmp_path, p, day):
    p = dataclasses.replace(p, as_of=day)
    orders = made(1)
    r = random.Random(2)
    r.shuffle(orders)  # every run has orders of any day
    state = RevenueState(spark, str(tmp_path / "s"))
    for k in range(3):
        state.add(frame(spark, orders[k::3]), p, f"run-{k}")
    assert_same(state, frame(spark, orders), p)
    state.add(frame(spark, orders[1::3]), p, "run-1")  # repeated
    assert_same(state, frame(spark, orders), p)
    state.compact(["run-0", "run-2"], "both")
    assert state.runs() == ["both", "run-1"]
    assert_same(state, frame(spark, orders), p)
    with pytest.raises(ValueError):
        state.add(frame(spark, orders[:5]), p, "run-0")
    with pytest.raises(ValueError):
        state.compact(["run-1"], "both")
    state.compact(state.runs(), "all")
    assert state.runs() == ["all"]
    assert_same(state, frame(spark, orders), p)


def test_only_what_is_new_is_read(spark, tmp_path, p):
    orders = made(3)
    state = RevenueState(spark, str(tmp_path / "s"))
    frame(spark, orders[:300]).write.parquet(str(tmp_path / "old"))
    state.add(spark.read.parquet(str(tmp_path / "old")), p, "1")
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "s").rglob("*.parquet")}
    import shutil

    shutil.move(str(tmp_path / "old"), str(tmp_path / "away"))  # the old orders are not needed again
    state.add(frame(spark, orders[300:]), p, "2")
    assert {f: f.stat().st_mtime_ns for f in before} == before
    assert_same(state, frame(spark, orders), p)


def test_a_run_counts_when_it_is_committed(spark, tmp_path, p, monkeypatch):
    orders = made(4)
    state = RevenueState(spark, str(tmp_path / "s"))
    state.add(frame(spark, orders[:200]), p, "1")
    with monkeypatch.context() as m:
        m.setattr(RevenueState, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            state.add(frame(spark, orders[200:]), p, "2")
    assert state.runs() == ["1"]
    assert_same(state, frame(spark, orders[:200]), p)
    state.add(frame(spark, orders[200:]), p, "2")
    assert_same(state, frame(spark, orders), p)


def test_no_orders(spark, tmp_path, p):
    state = RevenueState(spark, str(tmp_path / "s"))
    assert state.runs() == [] and state.revenue_monthly(p).count() == 0
    state.add(frame(spark, []), p, "1")
    state.add(frame(spark, made(5, 30)), p, "2")
    assert_same(state, frame(spark, made(5, 30)), p)
