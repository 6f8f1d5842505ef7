"""Which sources of a language use words unlike the others: exact counts through minimal perfect hashes.

A first pass over the texts counts the documents of each term and keeps the frequent ones. These are
dealt into shards, and each shard gets a minimal perfect hash, which gives every kept term a slot of
its own and stores the term there, so that a term that is not kept is told by comparing. A second
pass counts into one dense array per group and shard. Below a checked size the hashes are broadcast and
a task counts what it reads; beyond it, counts per term go to the shards instead.

Divergences are computed shard by shard, each with the counts of all sources of a language.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from basketlens.llm.common import fields_of, map_arrow, require, ship, staged, text_slices
from basketlens.llm.shingles import mix


@dataclass(frozen=True)
class Settings:
    """``documents``: that a kept term is in, at least. ``terms``: that are listed per group. ``shard``: terms
    of a shard, about. ``broadcast``: bytes of hashes up to which they are broadcast. ``slice``: bytes of text
    that a task cuts at once, or one text. ``held``: counts that a task holds before it hands them on."""

    documents: int = 3
    terms: int = 200
    scale: int = 1_000_000_000
    shard: int = 2048
    broadcast: int = 48 << 20
    slice: int = 4 << 20
    held: int = 1 << 24


# --- terms -----------------------------------------------------------------------------------

# Letters and everything beyond ASCII are kept, A-Z in lower case; the rest separates.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)


def texts_of(docs: DataFrame) -> DataFrame:
    """As bytes, which are what terms are compared and ordered by."""
    return require(docs, "text", "lang", "source").select(*(F.coalesce(F.col(c), F.lit("")).cast("binary").alias(c) for c in ("text", "lang", "source")))


@dataclass
class Cut:
    """The terms of some texts: each distinct one, and for every occurrence its number and its text."""

    distinct: pa.Array
    number: np.ndarray
    text: np.ndarray


def cut(texts: pa.Array) -> Cut:
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    data = LOWER[np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]]
    offsets = offsets - offsets[0]
    inside = data != 32
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (np.append(True, ~inside[:-1]) | edge[:-1])[: len(data)])
    ends = np.flatnonzero(inside & (np.append(~inside[1:], True) | edge[1:])[: len(data)]) + 1
    bounds = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=bounds[1:])
    terms = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data[inside])])
    coded = terms.dictionary_encode()
    return Cut(coded.dictionary, coded.indices.to_numpy(), np.searchsorted(offsets, starts, side="right") - 1)


def cuts(batches: Iterator[pa.RecordBatch], settings: Settings) -> Iterator[tuple[pa.RecordBatch, Cut]]:
    for batch in batches:
        for part in text_slices(batch, "text", settings.slice):
            yield part, cut(part.column("text"))


def numbered(column: pa.Array) -> tuple[list[bytes], np.ndarray]:
    coded = column.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy()


# --- minimal perfect hashes ------------------------------------------------------------------

STEP = np.uint64(0x9E3779B97F4A7C15)


def hashes(terms: list[bytes], seed: int) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(t, seed) for t in terms], np.uint64)


def places(h: np.ndarray, pilots: np.ndarray, size: int | np.ndarray) -> np.ndarray:
    return (mix(h ^ (pilots.astype(np.uint64) * STEP)) % np.asarray(size, np.uint64)).astype(np.int64)


class PerfectHash:
    """Hash and displace: a bucket of terms has a pilot, found so that all its terms fall on free slots."""

    def __init__(self, seed: int, pilots: np.ndarray, keys: pa.Array):
        self.seed, self.pilots, self.keys = seed, pilots, keys

    @classmethod
    def of(cls, terms: list[bytes]) -> PerfectHash:
        """``terms`` are distinct and not none."""
        seed, size = 0, len(terms)
        while len(np.unique(h := hashes(terms, seed))) < size:
            seed += 1
        buckets = max(1, math.ceil(size / 4))
        bucket = cls.bucket(h, buckets)
        by, pilots, free = np.argsort(bucket, kind="stable"), np.zeros(buckets, np.uint32), np.ones(size, bool)
        edges = np.searchsorted(bucket[by], np.arange(buckets + 1))
        slot = np.empty(size, np.int64)
        for b in np.argsort(edges[:-1] - edges[1:], kind="stable").tolist():  # large buckets first
            own = by[edges[b] : edges[b + 1]]
            if not len(own):
                break
            first, width = 0, 32
            while True:
                tried = np.arange(first, first + width, dtype=np.uint64)
                at = places(h[own][:, None], tried[None, :], size)
                fits = free[at].all(0)
                if len(own) > 1:
                    fits &= (np.diff(np.sort(at, 0), axis=0) > 0).all(0)
                if fits.any():
                    k = int(fits.argmax())
                    pilots[b], slot[own] = first + k, at[:, k]
                    free[at[:, k]] = False
                    break
                first, width = first + width, min(4096, width * 2)
        ordered: list[bytes] = [b""] * size
        for t, s in zip(terms, slot.tolist()):
            ordered[s] = t
        return cls(seed, pilots, pa.array(ordered, pa.large_binary()))

    @staticmethod
    def bucket(h: np.ndarray, buckets: int) -> np.ndarray:
        return ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)

    def slots(self, terms: list[bytes]) -> np.ndarray:
        """The slot of each term, -1 for a term that is not stored."""
        h = hashes(terms, self.seed)
        at = places(h, self.pilots[self.bucket(h, len(self.pilots))], len(self.keys))
        same = pc.equal(self.keys.take(pa.array(at)), pa.array(terms, pa.large_binary()))
        return np.where(same.to_numpy(zero_copy_only=False), at, -1)


HASHES = "lang binary, shard int, seed int, pilots binary, keys array<binary>"


def from_row(seed: int, pilots: bytes, keys) -> PerfectHash:
    keys = keys.cast(pa.large_binary()) if isinstance(keys, pa.Array) else pa.array(keys, pa.large_binary())
    return PerfectHash(seed, np.frombuffer(pilots, np.uint32), keys)


def shard_of(term: bytes, shards: int) -> int:
    """As xxhash64 of the engine's functions."""
    h = xxhash.xxh64_intdigest(term, 42)
    return (h - (1 << 64) if h >> 63 else h) % shards


class Shards:
    """The perfect hashes of a language, one after another: slots are numbered through."""

    def __init__(self, parts: dict[int, PerfectHash], shards: int):
        self.shards, sizes, buckets = shards, np.zeros(shards, np.int64), np.ones(shards, np.int64)
        for k, h in parts.items():
            sizes[k], buckets[k] = len(h.keys), len(h.pilots)
        self.sizes, self.buckets = sizes, buckets
        self.base, self.bucket_base = np.cumsum(sizes) - sizes, np.cumsum(buckets) - buckets
        self.pilots = np.zeros(int(buckets.sum()), np.uint32)
        for k, h in parts.items():
            self.pilots[self.bucket_base[k] : self.bucket_base[k] + buckets[k]] = h.pilots
        self.keys = pa.concat_arrays([parts[k].keys for k in sorted(parts)])
        self.seeds = {k: h.seed for k, h in parts.items() if h.seed}

    def slots(self, distinct: pa.Array) -> np.ndarray:
        """The numbered slot of each term, -1 for a term that is not stored."""
        terms = distinct.to_pylist()
        shard = np.array([shard_of(t, self.shards) for t in terms], np.int64)
        h = hashes(terms, 0)
        for k, seed in self.seeds.items():
            own = np.flatnonzero(shard == k)
            h[own] = hashes([terms[i] for i in own.tolist()], seed)
        known = self.sizes[shard] > 0
        size = np.where(known, self.sizes[shard], 1).astype(np.uint64)
        bucket = ((h >> np.uint64(32)) % self.buckets[shard].astype(np.uint64)).astype(np.int64)
        at = places(h, self.pilots[self.bucket_base[shard] + bucket], size) + self.base[shard]
        at = np.where(known, at, 0)
        same = pc.equal(self.keys.take(pa.array(at)), distinct).to_numpy(zero_copy_only=False)
        return np.where(same & known, at, -1)


# --- passes ----------------------------------------------------------------------------------


def frequent(texts: DataFrame, settings: Settings) -> DataFrame:
    """``lang``, ``term`` of terms in enough documents. Every row is a document."""
    ddl = "lang binary, term binary, n long"
    schema = fields_of(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def out():
            if held:
                summed = pa.concat_tables(held).group_by(["lang", "term"]).aggregate([("n", "sum")])
                yield from summed.select(["lang", "term", "n_sum"]).cast(schema.set(2, pa.field("n_sum", pa.int64()))).rename_columns(schema.names).to_batches(max_chunksize=1 << 16)
            held.clear()

        for part, c in cuts(batches, settings):
            langs, lang = numbered(part.column("lang"))
            size = max(1, len(c.distinct))
            once = np.unique(c.text * size + c.number)  # a term counts once per text
            pair, n = np.unique(lang[once // size].astype(np.int64) * size + once % size, return_counts=True)
            held.append(pa.table({
                "lang": pa.array(langs, pa.binary()).take(pa.array(pair // size)), "term": c.distinct.take(pa.array(pair % size)), "n": n}))
            if sum(t.num_rows for t in held) > 1 << 20:
                yield from out()
        yield from out()

    counted = map_arrow(texts.select("lang", "text"), run, ddl).groupBy("lang", "term").agg(F.sum("n").alias("n"))
    return staged(counted.where(F.col("n") >= settings.documents).select("lang", "term"), "frequent")


def hashed(kept: DataFrame, shards: int) -> DataFrame:
    """A minimal perfect hash per language and shard."""
    schema = fields_of(HASHES)

    def build(key, group):
        if not group.num_rows:
            return schema.empty_table()
        h = PerfectHash.of(sorted(group.column("term").to_pylist()))
        row = [key[0].as_py()], [key[1].as_py()], [h.seed], [h.pilots.tobytes()], [h.keys.to_pylist()]
        return pa.table([pa.array(v, t) for v, t in zip(row, schema.types)], schema=schema)

    ship(kept.sparkSession)
    dealt = kept.withColumn("shard", F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int"))
    return staged(dealt.groupBy("lang", "shard").applyInArrow(build, HASHES), "hashes")


COUNTS = "lang binary, source binary, shard int, tasks int, counts binary, total long"


def packed(counts: np.ndarray) -> bytes:
    """The counts of a shard's slots: those that are not 0, or all where that is shorter."""
    slot = np.flatnonzero(counts)
    kind = "<u4" if counts.max(initial=0) < 1 << 32 else "<i8"
    if len(slot) * 2 > len(counts):
        return b"d" + kind[1:].encode() + counts.astype(kind).tobytes()
    return b"s" + kind[1:].encode() + len(slot).to_bytes(4, "little") + slot.astype("<u4").tobytes() + counts[slot].astype(kind).tobytes()


def add_packed(into: np.ndarray, data: bytes) -> None:
    kind = f"<{data[1:3].decode()}"
    if data[:1] == b"d":
        into += np.frombuffer(data, kind, offset=3).astype(np.int64)
    else:
        n = int.from_bytes(data[3:7], "little")
        into[np.frombuffer(data, "<u4", n, 7)] += np.frombuffer(data, kind, n, 7 + 4 * n).astype(np.int64)


def counted(texts: DataFrame, found: DataFrame, shards: int, settings: Settings, bytes_: int) -> DataFrame:
    """How often each kept term occurs in each group: packed ``counts`` per ``lang``, ``source`` and ``shard``, with
    their ``total``. Several rows of a group add up."""
    spark, schema, kinds = texts.sparkSession, fields_of(COUNTS), fields_of("lang binary, source binary, term binary, n long")
    small = bytes_ <= settings.broadcast
    sent = None
    if small:
        parts: dict[bytes, dict[int, PerfectHash]] = {}
        for lang, shard, seed, pilots, keys in zip(*(found.toArrow().column(c) for c in ("lang", "shard", "seed", "pilots", "keys"))):
            parts.setdefault(lang.as_py(), {})[shard.as_py()] = from_row(seed.as_py(), pilots.as_py(), keys.values)
        sent = spark.sparkContext.broadcast({lang: Shards(own, shards) for lang, own in parts.items()})

    def groups(part: pa.RecordBatch, c: Cut) -> Iterator[tuple[bytes, bytes, np.ndarray]]:
        """The numbers of the terms of each language and source."""
        langs, lang = numbered(part.column("lang"))
        sources, source = numbered(part.column("source"))
        group = (lang.astype(np.int64) * len(sources) + source)[c.text]
        by = np.argsort(group, kind="stable")
        edges = np.flatnonzero(np.diff(group[by], prepend=-1))
        for a, z in zip(edges.tolist(), [*edges[1:].tolist(), len(by)]):
            g = int(group[by[a]])
            yield langs[g // len(sources)], sources[g % len(sources)], c.number[by[a:z]]

    def into_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense: dict[tuple[bytes, bytes], np.ndarray] = {}
        tasks = TaskContext.get().partitionId() // 256

        def out():
            for (lang, source), counts in dense.items():
                of, rows = sent.value[lang], []
                for shard in np.flatnonzero(of.sizes).tolist():
                    own = counts[of.base[shard] : of.base[shard] + of.sizes[shard]]
                    if total := int(own.sum()):
                        rows.append((lang, source, shard, tasks, packed(own), total))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), schema.types)], schema=schema)
            dense.clear()

        for part, c in cuts(batches, settings):
            by: dict[bytes, list[tuple[bytes, np.ndarray]]] = {}
            for lang, source, number in groups(part, c):
                if lang in sent.value:
                    by.setdefault(lang, []).append((source, number))
            for lang, own in by.items():
                of, slots = sent.value[lang], np.full(len(c.distinct), -1)
                used = np.unique(np.concatenate([number for _, number in own]))
                slots[used] = of.slots(c.distinct.take(pa.array(used)))
                for source, number in own:
                    at = slots[number]
                    if (lang, source) not in dense:
                        if sum(map(len, dense.values())) + len(of.keys) > settings.held:
                            yield from out()
                        dense[lang, source] = np.zeros(len(of.keys), np.int64)
                    np.add.at(dense[lang, source], at[at >= 0], 1)
        yield from out()

    def by_term(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, c in cuts(batches, settings):
            for lang, source, number in groups(part, c):
                one, n = np.unique(number, return_counts=True)
                same = [pa.repeat(pa.scalar(x, pa.binary()), len(one)) for x in (lang, source)]
                yield pa.RecordBatch.from_arrays([*same, c.distinct.take(pa.array(one)).cast(pa.binary()), pa.array(n, pa.int64())], schema=kinds)

    def in_shard(key, left, right):
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        h = from_row(*(right.column(c)[0].as_py() for c in ("seed", "pilots", "keys")))
        dense: dict[bytes, np.ndarray] = {}
        at = h.slots(left.column("term").to_pylist())
        for source, slot, n in zip(left.column("source").to_pylist(), at.tolist(), left.column("n").to_pylist()):
            if slot >= 0:
                dense.setdefault(source, np.zeros(len(h.keys), np.int64))[slot] += n
        rows = [(key[0].as_py(), source, key[1].as_py(), 0, packed(x), int(x.sum())) for source, x in dense.items()]
        return pa.table([pa.array(v, t) for v, t in zip(zip(*rows), schema.types)], schema=schema) if rows else schema.empty_table()

    def merge(key, group):
        if not group.num_rows:
            return schema.empty_table()
        row = [k.as_py() for k in key]
        x = np.zeros(row[4], np.int64)
        for data in group.column("counts").to_pylist():
            add_packed(x, data)
        return pa.table([pa.array([v], t) for v, t in zip([*row[:4], packed(x), int(x.sum())], schema.types)], schema=schema)

    ship(spark)
    texts = texts.select("lang", "source", "text")
    if not small:
        each = map_arrow(texts, by_term, "lang binary, source binary, term binary, n long").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))
        each = each.withColumn("shard", F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int"))
        return staged(each.groupBy("lang", "shard").cogroup(found.groupBy("lang", "shard")).applyInArrow(in_shard, COUNTS), "counts")
    # Rows of up to 256 tasks are added at once, so that a group stays small however many tasks there are.
    rows = map_arrow(texts, into_slots, COUNTS).join(found.select("lang", "shard", F.size("keys").alias("size")), ["lang", "shard"])
    return staged(rows.groupBy("lang", "source", "shard", "tasks", "size").applyInArrow(merge, COUNTS), "counts")


# --- divergence ------------------------------------------------------------------------------

VALUES = "lang binary, source binary, part string, item binary, high long, low long"
LOW = 30  # values are summed in two parts, neither of which overflows


def shares(counts: np.ndarray, total: int, kept: int, scale: int) -> np.ndarray:
    if counts.size and (int(counts.max()) + 1) * scale >= 1 << 63:
        counts = counts.astype(object)
    return 1 + ((counts + 1) * scale) // (total + kept)


def squares(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return ((p - q) * (p - q)) // q


def of_shard(left: pa.Table, right: pa.Table, settings: Settings) -> Iterator[tuple]:
    """Rows of one shard: partial sums of every ordered pair of sources, and the terms of every source."""
    right = right.to_pylist()
    keys = next(r["keys"] for r in right if r["keys"] is not None)
    sources = sorted((r["source"], r["total"], r["kept"]) for r in right if r["keys"] is None)
    number = {s: k for k, (s, _, _) in enumerate(sources)}
    counts = np.zeros((len(sources), len(keys)), np.int64)
    for source, data in zip(left.column("source").to_pylist(), left.column("counts").to_pylist()):
        add_packed(counts[number[source]], data)
    p = np.stack([shares(c, n, v, settings.scale) for c, (_, n, v) in zip(counts, sources)]).astype(np.int64)
    whole = shares(counts.sum(0), sum(n for _, n, _ in sources), sources[0][2], settings.scale).astype(np.int64)
    place = np.empty(len(keys), np.int64)
    place[sorted(range(len(keys)), key=keys.__getitem__)] = np.arange(len(keys))
    for k, (source, _, _) in enumerate(sources):
        f = squares(p[k], p)
        high, low = (f >> LOW).sum(1).tolist(), (f & ((1 << LOW) - 1)).sum(1).tolist()
        for j, (other, _, _) in enumerate(sources):
            if j != k:
                yield source, "pair", other, high[j], low[j]
        own = np.flatnonzero((counts[k] > 0) & (p[k] > whole))
        value = squares(p[k][own], whole[own])
        first = np.lexsort((place[own], -value))[: settings.terms]
        for i, v in zip(own[first].tolist(), value[first].tolist()):
            yield source, "term", keys[i], v >> LOW, v & ((1 << LOW) - 1)


def audited(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: for each source of a language, part ``pair`` has
    its divergence from every other source, part ``term`` the terms it uses more than the language does.

    A null text, language or source counts as empty. Every row is a document, repeated ones too. A language
    without kept terms has pairs of value 0 and no terms, a source alone in its language no pairs; an empty table gives
    no rows.
    """
    texts = texts_of(docs)
    kept = frequent(texts, settings)
    facts = kept.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    most = kept.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    shards = max(1, math.ceil(most / settings.shard))
    found = hashed(kept, shards)
    counts = counted(texts, found, shards, settings, facts)

    totals = counts.groupBy("lang", "source").agg(F.sum("total").alias("total"))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("kept"))
    groups = texts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = staged(groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept")), "groups")

    every = found.select("lang", "shard").join(groups, "lang").select("lang", "shard", "source", "total", "kept", F.lit(None).cast("array<binary>").alias("keys"))
    none = [F.lit(None).cast(t).alias(n) for n, t in (("source", "binary"), ("total", "long"), ("kept", "long"))]
    right = every.union(found.select("lang", "shard", *none, "keys"))
    schema = fields_of(VALUES)

    def compare(key, left, right):
        columns = list(zip(*of_shard(left, right, settings))) if right.num_rows else []
        if not columns:
            return schema.empty_table()
        columns = [[key[0].as_py()] * len(columns[0]), *columns]
        return pa.table([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    values = staged(counts.select("lang", "source", "shard", "counts").groupBy("lang", "shard").cogroup(right.groupBy("lang", "shard")).applyInArrow(compare, VALUES), "values")
    value = F.col("high").cast("decimal(20,0)") * F.lit(1 << LOW).cast("decimal(10,0)") + F.col("low").cast("decimal(20,0)")
    values = values.select("lang", "source", "part", "item", value.alias("value"))
    sums = values.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    others = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    pairs = others.join(sums, ["lang", "source", "item"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("decimal(38,0)").alias("value"))
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = values.where("part = 'term'").withColumn("value", F.col("value").cast("decimal(38,0)"))
    ranked = pairs.withColumn("rank", F.row_number().over(order)).union(terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= settings.terms))
    return ranked.select(
        *(F.col(c).cast("string").alias(c) for c in ("lang", "source", "part", "item")), F.col("value").try_cast("long").alias("value"), "rank")
