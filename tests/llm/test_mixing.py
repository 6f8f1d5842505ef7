"""Rates against their targets and a plain version of the steps."""

from __future__ import annotations

import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.llm import mixing
from basketlens.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, n_tokens int, rate string, p_clean string, lang string"
LABELS = "doc_id long, quality int, toxic int"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, 1, "r", "p", "en") for i, t in enumerate(texts)], SCHEMA)


def made(n=600):
    r = random.Random(2)
    texts, labels = [], []
    for i in range(n):
        kind = r.choices(["clean", "low", "toxic"], [0.7, 0.2, 0.1])[0]
        words = r.choices(["alpha", "beta", "gamma", "delta", "house"], k=r.randrange(20, 60))
        if kind == "low":
            words = [w + r.choice(["###", " |"]) for w in words]
        if kind == "toxic":
            words[3:6] = ["badword", "awful", "badwords"]
        texts.append(" ".join(words))
        if r.random() < 0.6:
            labels.append((i, int(kind != "low"), int(kind == "toxic")))
    return texts, labels


ODD = [None, "", " \n", "same", "same", "x " * 20000]


def test_expected_tokens_match_the_targets(spark):
    texts, labels = made()
    mix = mixing.Mix()
    docs, said = frame(spark, texts + ODD), spark.createDataFrame(labels + [(None, 1, 1), (1, None, None)], LABELS)
    rows = mixing.memberships(docs, said, mix)
    steps, target = mixing.fitted(rows, mix)
    got = sorted(rows.withColumn("rate", mixing.rate_of(mix, steps)).collect(), key=lambda r: r.doc_id)
    p = np.array([[r.p_clean, r.p_low, r.p_toxic] for r in got])
    t = np.array([r.n_tokens for r in got])
    assert len(got) == len(texts) + len(ODD) and np.allclose(p.sum(1), 1) and (p >= 0).all()
    assert t.tolist() == [len((x or "").split()) for x in texts + ODD]
    rate = np.ones(len(t))
    for u in steps:
        rate = np.maximum(0, rate - p @ np.array(u))
    assert np.allclose(rate, [r.rate for r in got]) and (rate >= 0).all()
    wanted = np.array([target[n] for n in mix.domains])
    assert np.abs((rate * t) @ p - wanted).sum() < 0.01 * wanted.sum()
    assert abs(wanted[0] - t @ p[:, 0]) < 1e-6 * wanted[0]


def test_given_budget_and_weights(spark):
    texts, labels = made()
    mix = mixing.Mix(weights={"clean": 0.5, "low": 0.3, "toxic": 0.2}, tokens=30000)
    rows = mixing.rates(frame(spark, texts), spark.createDataFrame(labels, LABELS), mix).collect()
    totals = [sum(r.rate * r.n_tokens * r[f"p_{n}"] for r in rows) for n in mix.domains]
    assert np.allclose(totals, [15000, 9000, 6000], rtol=0.01)
    assert abs(sum(r.copies * r.n_tokens for r in rows) / 30000 - 1) < 0.1
    assert all(r.copies in (int(r.rate), int(r.rate) + 1) for r in rows)


def least_squares(a, target, most, rounds=20_000):
    """Rates in [0, most] with the least sum of squared differences, by accelerated projected gradient."""
    x = y = np.ones(a.shape[1])
    step, k = 1 / np.linalg.norm(a, 2) ** 2, 1.0
    for _ in range(rounds):
        new = np.clip(y - step * a.T @ (a @ y - target), 0, most)
        if (y - new) @ (new - x) > 0:
            k = 1.0
        after = (1 + (1 + 4 * k * k) ** 0.5) / 2
        x, y, k = new, new + (k - 1) / after * (new - x), after
    return x


@pytest.mark.parametrize("most", [None, 1.0])
@pytest.mark.parametrize("weights", [(0.96, 0.03, 0.01), (0.5, 0.3, 0.2)])
def test_rates_against_plain_least_squares(spark, most, weights):
    texts, labels = made(400)
    mix = mixing.Mix(weights=dict(zip(("clean", "low", "toxic"), weights)), most=most)
    rows = mixing.memberships(frame(spark, texts + ODD[:5]), spark.createDataFrame(labels, LABELS), mix)
    steps, target = mixing.fitted(rows, mix)
    got = rows.withColumn("rate", mixing.rate_of(mix, steps)).collect()
    a = np.array([[r.n_tokens * r[f"p_{n}"] for r in got] for n in mix.domains])
    wanted = np.array([target[n] for n in mix.domains])
    rate = np.array([r.rate for r in got])
    assert (rate >= 0).all() and (most is None or (rate <= most).all())
    ours = np.linalg.norm(a @ rate - wanted)
    best = np.linalg.norm(a @ least_squares(a, wanted, most) - wanted)
    assert ours <= 1.02 * best + 1e-3 * wanted.sum()


@pytest.mark.parametrize("most", [None, 1.0])
def test_copies_have_the_fitted_tokens(spark, most):
    texts, labels = made(3000)
    mix = mixing.Mix(most=most)
    rates = mixing.rates(frame(spark, texts), spark.createDataFrame(labels, LABELS), mix)
    rows = rates.collect()
    assert all(r.copies in (int(r.rate), int(r.rate) + 1) for r in rows)
    real = mixing.realised(rates, mix)
    for n in mix.domains:
        part = np.array([r.n_tokens * r[f"p_{n}"] for r in rows])
        rate = np.array([r.rate for r in rows])
        spread = np.sqrt((part**2 * (rate % 1) * (1 - rate % 1)).sum())
        assert abs(real[n] - part @ rate) <= 4 * spread + 1e-6


@pytest.mark.parametrize("bound", [0, 1000])
def test_rows_come_at_their_rates(spark, bound):
    texts, labels = made(300)
    docs, said = frame(spark, texts + ODD), spark.createDataFrame(labels, LABELS)
    mix = mixing.Mix(weights={"clean": 0.9, "low": 0.05, "toxic": 0.05}, broadcast_rows=bound)
    copies = {r.doc_id: r.copies for r in mixing.rates(docs, said, replace(mix, most=1.0)).collect()}
    assert set(copies.values()) == {0, 1}
    got = mixing.mixed(docs, said, mix)  # no row comes twice, so rates end at one
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(i for i, n in copies.items() if n > 0)
    twice = mixing.Mix(weights={"clean": 0.9, "low": 0.05, "toxic": 0.05}, tokens=40000, broadcast_rows=bound)
    copies = {r.doc_id: r.copies for r in mixing.rates(docs, said, twice).collect()}
    again = [r.doc_id for r in mixing.mixed(docs, said, twice, repeat=True).collect()]
    assert sorted(again) == sorted(i for i, n in copies.items() for _ in range(n)) and max(copies.values()) > 1


def test_labels_of_no_or_one_domain(spark):
    docs = frame(spark, ["a b", "c", None])
    for labels, expected in (([], 1 / 3), ([(0, 1, 0)], 1.0)):
        rows = mixing.memberships(docs, spark.createDataFrame(labels, LABELS), mixing.Mix()).collect()
        assert all(abs(r.p_clean - expected) < 1e-9 for r in rows)
    assert mixing.rates(frame(spark, []), spark.createDataFrame([], LABELS)).count() == 0
    assert mixing.rates(frame(spark, [None, ""]), spark.createDataFrame([], LABELS)).count() == 2


def test_query_keeps_clean_documents(spark):
    rows = QUERIES["op3_soft_mixing"](spark, SMALL).join(spark.read.parquet(f"{SMALL}/labels.parquet"), "doc_id")
    got = {(r.quality, r.toxic): r for r in rows.groupBy("quality", "toxic").agg(F.avg((F.col("copies") > 0).cast("int")).alias("kept")).collect()}
    assert got[1, 0].kept > 0.97 and got[0, 0].kept < 0.4


@pytest.mark.parametrize("most", [None, 1.0])
def test_a_step_more_does_not_grow_the_expression(spark, most):
    mix = mixing.Mix(most=most)
    r = random.Random(5)
    steps = [[r.gauss(0, 0.2) for _ in mix.domains] for _ in range(25)]
    given = [tuple(r.random() for _ in mix.domains) for _ in range(50)] + [(1.0, 0.0, 0.0), (0.0, 0.0, 0.0)]
    rows = spark.createDataFrame(given, ", ".join(f"p_{n} double" for n in mix.domains))

    def sizes(steps):
        plan = rows.select(mixing.rate_of(mix, steps).alias("rate"))._jdf.queryExecution().analyzed().toString()
        return plan.count("greatest"), plan.count("p_clean#")

    assert sizes(steps) == sizes(steps[:2])
    for some in (steps, steps[:1], []):
        wanted = []
        for p in given:
            rate = 1.0
            for step in some:
                for x, u in zip(p, step):
                    rate = rate - x * u
                rate = max(0.0, rate) if most is None else min(most, max(0.0, rate))
            wanted.append(rate)
        assert [x.rate for x in rows.select(mixing.rate_of(mix, some).alias("rate")).collect()] == wanted
