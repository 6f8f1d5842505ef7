"""Divergence of sources against plain counting; perfect hashes by their properties."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketlens.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, term string, n int, shard string, slot int, value long, rank int"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, la, s, 1, "x", 2, "y", 3, 4, 5) for i, (t, la, s) in enumerate(rows)], SCHEMA)


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def brute(rows, s=divergence.Settings()):
    docs = [([lower(w) for w in TERM.findall(t or "")], la or "", so or "") for t, la, so in rows]
    out = []
    for lang in {d[1] for d in docs}:
        own = [d for d in docs if d[1] == lang]
        df = Counter(w for ws, _, _ in own for w in set(ws))
        kept = [w for w, n in df.items() if n >= s.documents]
        counts = {so: Counter(w for ws, _, x in own if x == so for w in ws if df[w] >= s.documents) for so in {d[2] for d in own}}
        total = sum(counts.values(), Counter())

        def share(c):
            n = sum(c.values())
            return {w: 1 + s.scale * (c[w] + 1) // (n + len(kept)) for w in kept}

        f = lambda p, q: (p - q) * (p - q) // q
        p, q = {so: share(c) for so, c in counts.items()}, share(total)
        for so in counts:
            pairs = [(-sum(f(p[so][w], p[x][w]) for w in kept), x.encode()) for x in counts if x != so]
            terms = [(-f(p[so][w], q[w]), w.encode()) for w in kept if counts[so][w] and p[so][w] > q[w]]
            for part, listed in (("pair", sorted(pairs)), ("term", sorted(terms)[: s.terms])):
                out += [(lang, so, part, item.decode(), -v, k + 1) for k, (v, item) in enumerate(listed)]
    return sorted(out)


def plain(df):
    return sorted(tuple(r) for r in df.collect())


WORDS = ["Straße", "ÉCOLE", "école", "don", "t", "AbC", "abc", "日本", "x", "longword" * 40, "é", "İ", "ſ", "K"]


def made(seed=0):
    r = random.Random(seed)
    rows = []
    for lang, sources, docs in (("en", ["a", "b", "ä", None, "Z"], 90), ("de", ["a"], 20), (None, ["q", ""], 8), ("few", ["a", "b"], 2)):
        words = WORDS + [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(120)]
        for k in range(docs):
            source = sources[0] if k % 3 == 0 else r.choice(sources)
            text = "".join(w + r.choice([" ", "\n", "'", "\x00", "\x7f", "1", " _ "]) for w in r.choices(words, k=r.randint(0, 60)))
            rows.append((text, lang, source))
    return rows + [(None, "en", "a"), ("", "en", "quiet"), ("12 34 !", "de", "c"), (rows[0][0], "en", "a"), (rows[0][0], "en", "a"), ("word " * 300_000, "en", "b")]


@pytest.mark.parametrize("shard, broadcast, held, terms", [(2048, 1 << 20, 1 << 24, 200), (5, 1 << 20, 200, 4), (5, 0, 7, 200)])
def test_equals_plain_counts(spark, shard, broadcast, held, terms):
    s = divergence.Settings(shard=shard, broadcast=broadcast, held=held, terms=terms, slice=1500)
    rows = made()
    assert plain(divergence.audited(frame(spark, rows).repartition(5), s)) == brute(rows, s)


def test_nothing_to_compare(spark):
    assert divergence.audited(frame(spark, [])).count() == 0
    rows = [("one two", "en", "a"), (None, "en", None), ("three", None, "a")]  # no term in three documents
    assert plain(divergence.audited(frame(spark, rows))) == brute(rows) == [("en", "", "pair", "a", 0, 1), ("en", "a", "pair", "", 0, 1)]


@pytest.mark.parametrize("n", [1, 2, 3, 50, 3000])
def test_perfect_hash_is_minimal_and_knows_strangers(n):
    terms = [f"t{k}".encode() * (1 + k % 7) for k in range(n)]
    h = divergence.PerfectHash.of(terms)
    assert sorted(h.slots(terms).tolist()) == list(range(n))
    assert (h.slots([b"s" + t for t in terms]) == -1).all() and len(h.keys) == n
    again = divergence.from_row(h.seed, h.pilots.tobytes(), h.keys.to_pylist())
    assert (again.slots(terms) == h.slots(terms)).all()


def test_perfect_hash_takes_another_seed_when_hashes_meet(monkeypatch):
    plainly = divergence.hashes
    monkeypatch.setattr(divergence, "hashes", lambda terms, seed: plainly(terms, seed) if seed else np.full(len(terms), 7, np.uint64))
    h = divergence.PerfectHash.of([b"a", b"b", b"c"])
    assert h.seed == 1 and sorted(h.slots([b"a", b"b", b"c"]).tolist()) == [0, 1, 2]


def test_shards_are_numbered_through():
    terms = [f"t{k}".encode() for k in range(300)]
    by = {}
    for t in terms:
        by.setdefault(divergence.shard_of(t, 7), []).append(t)
    del by[3]  # a shard without kept terms
    parts = {k: divergence.PerfectHash.of(v) for k, v in by.items()}
    of = divergence.Shards(parts, 7)
    kept = sorted(t for v in by.values() for t in v)
    assert sorted(of.slots(pa.array(kept, pa.large_binary())).tolist()) == list(range(len(kept)))
    gone = [t for t in terms if t not in kept] + [b"", b"strange"]
    assert (of.slots(pa.array(gone, pa.large_binary())) == -1).all()


@pytest.mark.parametrize("counts", [[0, 0, 0, 5], [1, 2, 3], [0, 1 << 40, 0], [0]])
def test_packed_counts_add_up(counts):
    x = np.array(counts, np.int64)
    into = np.ones(len(x), np.int64)
    divergence.add_packed(into, divergence.packed(x))
    assert (into == x + 1).all()


def test_shards_agree_with_the_engine(spark):
    terms = [w.encode() for w in WORDS] + [bytes([200 + k % 50]) * k for k in range(1, 80)]
    rows = spark.createDataFrame([(t,) for t in terms], "term binary").select("term", F.pmod(F.xxhash64("term"), F.lit(13)).alias("s")).collect()
    assert all(divergence.shard_of(bytes(r.term), 13) == r.s for r in rows)


def test_large_counts_stay_exact():
    s = divergence.Settings()
    counts = np.array([0, 5, 10**11])
    p = divergence.shares(counts, 10**11 + 5, 3, s.scale)
    assert p.tolist() == [1 + s.scale * (c + 1) // (10**11 + 8) for c in counts.tolist()]
