"""Components of similar documents against all pairs."""

from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest

from basketlens.llm import jaccard_join as join
from basketlens.llm.components import connected_components
from basketlens.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, s1 long, node string, size int"


def shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    to = list(range(len(rows)))

    def find(i):
        while to[i] != i:
            i = to[i]
        return i

    for i, k in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[k])
        if both and 100 * both >= 75 * (len(sets[i]) + len(sets[k]) - both):
            a, b = find(i), find(k)
            to[max(a, b)] = min(a, b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted((d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, "x", 2) for d, t in rows], SCHEMA)


def made(seed, n=150):
    """Families of texts with words changed, some far enough to fall apart; one passage in many."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(r.choices(vocabulary, k=30))
    rows = []
    while len(rows) < n:
        base = r.choices(vocabulary, k=r.choice([1, 3, 5, 6, 9, 20, 60, 200]))
        for _ in range(r.choice([1, 1, 2, 5, 12])):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 4, 8])):
                i = r.randrange(len(w))
                w[i : i + r.choice([0, 1, 1, 2])] = r.choices(vocabulary, k=r.choice([0, 1, 2]))
                w = w or ["one"]
            text = " ".join(w)
            rows.append(((len(rows) * 7919) % 10007, text + ("\n" + passage if r.random() < 0.3 else "")))
    return rows + [(20000, None), (20001, ""), (20002, " \n"), (20003, "one"), (20004, "ONE"), (20004, "ONE"), (20005, "a b c d e " * 3000)]


@pytest.mark.parametrize("settings", [
    join.Settings(), join.Settings(frequent_from=2, evidence=0.2, broadcast_rows=0), join.Settings(block=400),
])
def test_components_of_all_links(spark, settings):
    rows = made(settings.block)
    assert sorted(tuple(r) for r in join.components(frame(spark, rows), settings).collect()) == brute(rows)


def test_links_across_tasks_by_way_of_long_documents(spark):
    """Two near copies in different tasks; in the task of one of them a long document quotes both."""
    r = random.Random(3)
    word = lambda: f"v{r.randrange(10**9)}"
    here, there = [], []
    for i in range(60):
        base = [word() for _ in range(60)]
        here += [(4 * i, " ".join(base)), (4 * i + 1, " ".join([*base, *(word() for _ in range(1000))]))]
        there += [(4 * i + 2, " ".join([*base[:-1], word()])), (4 * i + 3, word())]
    dealt = spark.sparkContext.parallelize(here + there, 2)  # two tasks of equally many rows
    docs = spark.createDataFrame(dealt, "doc_id long, text string")
    assert sorted(tuple(r) for r in join.components(docs).collect()) == brute(here + there)


def test_chance_passages_tie_no_block(spark):
    """Families of near copies, each of which quotes a line of the next one."""
    r = random.Random(4)
    families = [[f"f{i}w{r.randrange(10**6)}" for _ in range(150)] for i in range(40)]
    rows = []
    for i, base in enumerate(families):
        quoted = families[(i + 1) % 40][:6]
        for k in range(3):
            text = [*base[: 50 * k], f"own{k}", *base[50 * k :], *quoted]
            rows.append((3 * i + k, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3, "text")
    settings = join.Settings()
    blocks = join.candidate_blocks(docs, join.named_sets(docs, settings), settings)
    assert max(b.sets for b in blocks.collect()) == 3
    assert sorted(tuple(x) for x in join.components(docs).collect()) == brute(rows)


def test_no_documents(spark):
    assert join.components(frame(spark, [])).count() == 0
    assert join.components(frame(spark, [(1, None), (2, "")])).count() == 2


def test_one_of_each_component_stays(spark):
    rows = made(5, 60)
    left = sorted(r.doc_id for r in join.keep_one(frame(spark, rows)).collect())
    assert left == sorted(d for d, _, c in brute(rows) if d == c)


def test_a_document_is_its_id_and_its_text(spark):
    t, u, v = (" ".join(f"{name}{i}" for i in range(60)) for name in "tuv")
    near = t + " more"
    rows = [(1, t), (1, t), (2, t), (None, t), (2, u), (2, u), (1, v), (None, "alone " * 9), (None, "alone " * 9), (4, near), (1, near),
            (7, ""), (7, ""), (8, None), (8, None), (8, ""), (None, None), (None, None)]
    left = [(r.doc_id, r.text) for r in join.keep_one(frame(spark, rows).repartition(3)).collect()]
    one = [x for x in left if x in ((1, t), (1, near))]  # of two texts under the smallest id, either
    assert len(one) == 1
    want = one + [(2, u), (1, v), (None, "alone " * 9), (7, ""), (8, None), (8, ""), (None, None)]
    assert sorted(left, key=repr) == sorted(want, key=repr)
    same = join.keep_one(frame(spark, [(None, t), (9, near), (None, u), (None, u + " x")]))
    assert sorted(r.doc_id is None for r in same.collect()) == [False, True]


def test_the_tree_finds_every_link():
    r = np.random.default_rng(2)
    for _ in range(60):
        base = r.integers(0, 60, 30)
        sets = [np.unique(np.concatenate([base[r.random(30) < 0.9], r.integers(0, 200, r.integers(0, 12))])).astype(np.uint64) for _ in range(25)]
        to = list(range(25))
        for i, k in combinations(range(25), 2):
            both = len(np.intersect1d(sets[i], sets[k]))
            if 100 * both >= 75 * (len(sets[i]) + len(sets[k]) - both):
                a, b = to[i], to[k]
                to = [min(a, b) if x in (a, b) else x for x in to]
        assert join.linked(sets, 75) == to


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)} | {5000: 5000}


def test_query_over_all_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in QUERIES["op6_ngram_jaccard"](spark, SMALL).collect()) == brute(rows)
