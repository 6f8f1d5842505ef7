"""Token shards and packing against the library and brute force."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from basketlens.llm import binary_tokens as shards
from basketlens.llm import packing
from basketlens.llm.queries import BYTE_BPE, WORD_BPE
from basketlens.llm.tokens import SLICE, Encoder, encoder

ODD = [
    None, "", " ", "\n\n", "a\tb", "x  y\n\n z\n", "don't I'll 3foo, foo3 <|endoftext|> x", "é́ ñ́a",
    "İstanbul ΣΑΣ ² ½ x²", "a.'s b'", ' (foo) "bar\'s" 12.5', "word " * 3000, "same text", "same text",
]
DOCS = "doc_id long, text string, ids binary, length int, row string"


def docs(spark, texts, ids=None):
    ids = ids or range(len(texts))
    return spark.createDataFrame([(i, t, b"x", 1, "y") for i, t in zip(ids, texts)], DOCS)


def ids_of(path, text, end):
    return np.array(Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids + [end], "<u4")


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab'sÉñ .,\n\t 37|#-́İ", max_size=40), max_size=5))
def test_pieces_encode_as_whole_texts(path, texts):
    library = Tokenizer.from_file(path)
    for text, ids in zip(texts, encoder(path).encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60000), st.integers(0, 2**64 - 1)), max_size=400), st.integers(1, 60))
def test_words_hold_what_was_packed(ids, repeat):
    ids = np.array(ids * repeat, np.uint64)
    words, escapes, blocks = shards.pack(ids)
    assert (shards.unpack(words, escapes, blocks, len(ids)) == ids).all()
    assert len(words) <= len(ids)


def test_small_ids_share_words():
    words, escapes, _ = shards.pack(np.zeros(2400, np.uint64))
    assert len(words) == 10 and not len(escapes)


def test_a_cut_shard_is_refused():
    data = shards.shard_bytes(np.array([1]), np.array([3]), np.array([5, 6, 7]))
    assert shards.shard_parts(data)[2].tolist() == [5, 6, 7]
    with pytest.raises(ValueError):
        shards.shard_parts(data[:-8])


def test_shards_hold_all_documents_in_order(spark, tmp_path):
    order = [7, 3, 12, 0, 5, 1, 4, 2, 6, 8, 9, 10, 11, 13]
    by_id = dict(zip(order, ODD))
    table = shards.write_shards(docs(spark, ODD, order), str(tmp_path), BYTE_BPE, 2, shard_ids=2000)
    assert table.count() > 1
    got = {r.doc_id: (r.start, r.n_tokens, bytes(r.ids)) for r in shards.read_shards(table, str(tmp_path)).collect()}
    at = 0
    for doc_id in sorted(by_id):
        ids = ids_of(BYTE_BPE, by_id[doc_id], 2)
        assert got[doc_id] == (at, len(ids), ids.tobytes())
        at += len(ids)


def test_shards_of_no_documents(spark, tmp_path):
    empty = spark.createDataFrame([], DOCS)
    table = shards.write_shards(empty, str(tmp_path), BYTE_BPE, 2)
    assert shards.read_shards(table, str(tmp_path)).count() == 0


def check_packed(rows, texts, most=2048):
    expected = defaultdict(int)
    for doc_id, text in texts:
        ids = ids_of(WORD_BPE, text, 0)
        for k, a in enumerate(range(0, len(ids), most)):
            part = ids[a : a + most]
            expected[doc_id, k, a, len(part), zlib.crc32(part.tobytes())] += 1
    got = defaultdict(int)
    bins = defaultdict(list)
    for r in rows:
        got[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        bins[r.sequence_id].append((r.offset, r.length))
    assert got == expected
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= most
    return len(bins)


def test_packing_keeps_every_piece_once(spark):
    texts = list(enumerate(ODD)) + [(None, "without id"), (3, "again 3"), (3, "again 3")]
    rows = packing.pack_documents(docs(spark, [t for _, t in texts], [i for i, _ in texts]), WORD_BPE).collect()
    assert check_packed(rows, texts) <= 4
    assert packing.pack_documents(spark.createDataFrame([], DOCS), WORD_BPE).count() == 0


def test_packed_sequences_hold_the_ids(spark):
    texts = ["one two three", "four five", "six " * 5000]
    packed = packing.pack_documents(docs(spark, texts), WORD_BPE, with_ids=True)
    found = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        ids = bytes(found[r.sequence_id].ids)[4 * r.offset : 4 * (r.offset + r.length)]
        assert zlib.crc32(ids) == r.ids_crc32


@settings(max_examples=60, deadline=None)
@given(
    st.dictionaries(st.integers(1, 64), st.integers(1, 50), min_size=1, max_size=20),
    st.integers(1, 12), st.sampled_from(["norm", "dot"]), st.sampled_from([None, 2500]),
)
def test_plan_keeps_every_capacity(counts, documents, score, attention):
    counts = {n: c for n, c in counts.items() if not attention or n * n <= attention}
    capacity = packing.Capacity(64, documents, attention)
    ranks, bins = defaultdict(list), defaultdict(list)
    for length, rank, pieces, sequence, offset in packing.plan(counts, capacity, score):
        for k in range(pieces):
            ranks[length].append(rank + k)
            bins[sequence + k].append((offset, length))
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
    for places in bins.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= 64 and len(places) <= documents
        assert sum(n * n for _, n in places) <= (attention or 64 * 64)


def test_packing_comes_close_to_the_least_number():
    rng = np.random.default_rng(3)
    lengths, n = np.unique(np.clip(rng.lognormal(6, 1, 20000).astype(int), 1, 2048), return_counts=True)
    places = packing.plan(dict(zip(lengths.tolist(), n.tolist())), packing.Capacity())
    sequences = max(p[3] + p[2] for p in places)
    assert sequences <= 1.01 * -(-int((lengths * n).sum()) // 2048)


def test_many_empty_texts_fill_sequences(spark):
    rows = packing.pack_documents(docs(spark, [None if i % 2 else "" for i in range(5000)], list(range(5000))), WORD_BPE).collect()
    bins = defaultdict(list)
    for r in rows:
        assert (r.piece, r.start, r.length) == (0, 0, 1)
        bins[r.sequence_id].append(r.offset)
    assert len(rows) == 5000 and len(bins) == 3  # of 2048 tokens each
    assert all(sorted(at) == list(range(len(at))) for at in bins.values())


@settings(max_examples=40, deadline=None)
@given(
    counts=st.dictionaries(st.integers(1, 64), st.integers(1, 9), min_size=1, max_size=12), documents=st.sampled_from([3, 8, 64]),
    score=st.sampled_from(["norm", "dot"]), attention=st.sampled_from([None, 64 * 64, 5000]),
)
def test_plan_takes_as_many_sequences_as_piece_by_piece(counts, documents, score, attention):
    capacity = packing.Capacity(64, documents, attention)
    total, bins = capacity.vector, []
    for length in sorted(counts, reverse=True):
        need = capacity.need(length)
        for _ in range(counts[length]):
            fitting = []
            for left in set(map(tuple, bins)):
                if all(r >= n for r, n in zip(left, need)):
                    rest = [(r - n) / c for n, r, c in zip(need, left, total)]
                    share = [n / c for n, c in zip(need, total)]
                    value = sum(x * x for x in rest) if score == "norm" else sum(x * y for x, y in zip(rest, share))
                    fitting.append((value, left))
            left = min(fitting)[1] if fitting else tuple(total)
            if fitting:
                bins.remove(left)
            bins.append(tuple(r - n for n, r in zip(need, left)))
    assert len(bins) == max(first + number for _, _, number, first, _ in packing.plan(counts, capacity, score))

@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_frequent_pieces_outlive_the_bound(path):
    library, small = Tokenizer.from_file(path), Encoder(path, keep=20)
    for k in range(6):
        texts = [f"common words, and {k}x{j} rare{k}q{j}" for j in range(9)]
        for text, ids in zip(texts, small.encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        if k:
            assert any("common" in piece for piece in small.known) and len(small.known) < 60
    learned = []
    small._learn = lambda pieces, learn=small._learn: (learned.extend(pieces), learn(pieces))
    small.encode(["common words, and more"])
    assert learned and not any("common" in piece for piece in learned)


def test_tasks_encode_small_slices(spark):
    """A batch of many long texts is encoded slice by slice, so that its pieces are not held at once."""
    assert SLICE <= 1 << 20
    texts = [f"{k} " + "some words " * 60_000 for k in range(4)]
    rows = packing.pack_documents(docs(spark, texts), WORD_BPE, keep=50).collect()
    check_packed(rows, list(enumerate(texts)))
