"""Nearest neighbours against all inner products."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.llm import nearest
from basketlens.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, key string, v int, ids string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v and [None if x is None else float(x) for x in v], 0, "k", 1, "x") for i, v in rows], SCHEMA)


def good(v):
    return v and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, k=20):
    rows = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and good(v)]
    out = {}
    for i, q in rows:
        if i % 20 == 0:
            other = sorted((-float((q * v).sum()), j) for j, v in rows if j != i)[:k]
            out[i] = [(j, -s) for s, j in other]
    return out


def lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def same(got, expected):
    assert got.keys() == expected.keys()
    for q in expected:
        assert [j for j, _ in got[q]] == [j for j, _ in expected[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in expected[q]], atol=1e-9)


def made(n, dimension, seed=0):
    r = np.random.default_rng(seed)
    return [(i, (r.standard_normal(dimension) * r.choice([0.5, 1, 3])).tolist()) for i in range(n)]


ODD = [
    (1000, None), (1001, []), (1002, [0.0] * 6), (1003, [1.0, None, 0, 0, 0, 0]), (1004, [float("nan")] + [1.0] * 5),
    (1005, [float("inf")] * 6), (1006, [1.0, 2.0]), (None, [1.0] * 6),
]


@pytest.mark.parametrize("blocks", [(4096, 8192), (7, 40)])
def test_all_neighbours(spark, blocks):
    rows = made(300, 6) + [(400 + i, [2.0, 1, 0, 0, 0, 1]) for i in range(70)] + [(500 + i, [0.0, 0, 1, 0, 0, 0]) for i in range(30)]
    settings = nearest.Settings(query_block=blocks[0], candidate_block=blocks[1], bound=6.0)
    got = lists(nearest.nearest(frame(spark, rows + ODD), F.col("vec_id") % 20 == 0, settings))
    same(got, brute(rows))


def test_fewer_candidates_than_neighbours(spark):
    rows = made(5, 4)
    same(lists(nearest.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0)), brute(rows))
    assert nearest.nearest(frame(spark, rows[:1]), F.col("vec_id") % 20 == 0).count() == 0
    assert nearest.nearest(frame(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert nearest.nearest(frame(spark, ODD[:6]), F.col("vec_id") % 20 == 0).count() == 0


def test_a_repeated_query_row_keeps_its_neighbours(spark):
    rows = made(60, 6)
    many = rows + [rows[20]] * 30 + [(41, rows[20][1])] * 30 + [(7, rows[40][1])] * 25
    got = lists(nearest.nearest(frame(spark, many), F.col("vec_id") % 20 == 0, nearest.Settings(bound=6.0)))
    same(got, brute(rows + [(41, rows[20][1]), (7, rows[40][1])]))
    # The same id with another vector is another row: a query and a candidate of its own.
    other = [(1, [3.0, 0, 0, 0, 0, 0])] + [(i, [1.0, i / 100, 0, 0, 0, 0]) for i in range(2, 6)]
    two = nearest.nearest(frame(spark, [(20, [1.0, 0, 0, 0, 0, 0]), (20, [2.0, 0, 0, 0, 0, 0])] + other), F.col("vec_id") == 20).collect()
    assert len(two) == 12
    assert sorted((r.vec_id, r.score) for r in two if r.rank <= 2) == [(1, 3.0), (1, 6.0), (2, 2.0), (20, 2.0)]


def test_the_dimension_of_most_rows_counts(spark):
    rows = [(i + 10, v) for i, v in made(30, 4)]
    odd = [(0, [1.0, 2.0]), (20, [5.0] * 3), (3, [1.0, 2.0])]
    same(lists(nearest.nearest(frame(spark, odd + rows), F.col("vec_id") % 20 == 0)), brute(rows))
    even = [(1, [1.0, 0.0]), (20, [2.0, 0.0]), (40, [1.0] * 3), (3, [1.0] * 3)]  # as many of either: the smaller
    assert [(r.query_id, r.vec_id) for r in nearest.nearest(frame(spark, even), F.col("vec_id") % 20 == 0).collect()] == [(20, 1)]


@pytest.mark.parametrize("dimension, bits", [(64, 1), (64, 4), (5, 4), (100, 2)])
def test_counted_bits_equal_the_product_with_the_code(dimension, bits):
    r = np.random.default_rng(9)
    v, q = r.standard_normal((50, dimension)), r.standard_normal((20, dimension))
    turn = nearest.rotation(dimension, bits, 3)
    assert np.allclose(turn.T @ turn, np.eye(dimension)) and len(turn) % 64 == 0
    words, length, fit = nearest.encode(v, turn)
    signs = np.unpackbits(words.view(np.uint8), axis=1).astype(float) * 2 - 1
    estimate, error = nearest.estimates(nearest.Asked.of(q, turn, 12), slice(None), words, length, fit, 3.0)
    plain = (q @ turn.T) @ signs.T / math.sqrt(len(turn)) * length / fit
    assert np.allclose(estimate, plain, atol=0.02)  # but for the rounding to twelve bits
    coarse, error = nearest.estimates(nearest.Asked.of(q, turn, 4), slice(None), words, length, fit, 3.0)
    assert (np.abs(coarse - q @ v.T) <= error).mean() > 0.99


def test_codes_leave_most_candidates_out():
    r = np.random.default_rng(1)
    centres = r.standard_normal((40, 64))
    v = np.repeat(centres, 100, axis=0) + 0.4 * r.standard_normal((4000, 64))
    settings = nearest.Settings()
    turn = nearest.rotation(64, settings.bits, 3)
    words, length, fit = nearest.encode(v, turn)
    assert words.shape == (4000, 4)
    exact = v[:50] @ v.T
    best, full = nearest.search_block(v[:50], v, np.arange(4000), words, length, fit, turn, settings)
    assert full < 0.05 * 50 * 4000
    for i in range(50):
        true = set(np.argsort(-exact[i])[:20])
        assert len(true & set(best.id[best.query == i])) >= 19


def test_recall_of_the_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    expected, got = brute(rows), lists(QUERIES["op9_one_bit_neighbours"](spark, SMALL))
    assert got.keys() == expected.keys()
    hits = sum(len({j for j, _ in got[q]} & {j for j, _ in expected[q]}) for q in expected)
    assert hits >= 0.99 * sum(map(len, expected.values()))


def test_hardly_a_neighbour_is_missed_on_even_vectors():
    v = np.random.default_rng(5).standard_normal((4000, 64))
    v /= np.linalg.norm(v, axis=1)[:, None]
    turn = nearest.rotation(64, 4, 3)
    best, full = nearest.search_block(v[:100], v, np.arange(4000), *nearest.encode(v, turn), turn, nearest.Settings())
    assert full < 0.3 * 100 * 4000
    true = np.argsort(-(v[:100] @ v.T), axis=1)[:, :20]
    hits = sum(len(set(true[i]) & set(best.id[best.query == i])) for i in range(100))
    assert hits >= 0.999 * 2000
