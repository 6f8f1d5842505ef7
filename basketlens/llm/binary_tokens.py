"""Token ids in binary shards, packed by Simple-8b.

A shard file is a header, blocks of 64-bit words, escapes, and three tables:

    magic, version, and the number of documents, ids, words, blocks and escapes (8 x uint64)
    words       uint64 each: 4 bits of selector, 60 bits of payload, first id in the lowest bits
    escapes     uint64 each: ids that no payload holds, in order
    blocks      (ids before, words before) of each block of BLOCK ids, uint64 each
    documents   (doc_id int64, ids uint64) in ascending order of doc_id

A selector says how many ids its word holds, and of how many bits. Blocks do not depend on each
other, and the place of every id follows from the selectors alone, so that a shard is decoded by
array operations. Selector 1 is an escape: one id, whose payload is its place among the escapes.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pa_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import fields_of, map_arrow, require, running_total, scratch, text_slices
from basketlens.llm.tokens import SLICE, encoder

MAGIC = int.from_bytes(b"S8BTOKEN", "little")
VERSION = 1
BLOCK = 8192
# Ids per word and bits per id, by selector. The published code, with 1 as escape.
COUNTS = np.array([240, 1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 60, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = 1
PAYLOAD = np.uint64((1 << 60) - 1)


def pack(ids: np.ndarray, blocks_at_once: int = 32) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, escapes and block table of unsigned ids. Each word takes the most ids that fit."""
    parts = [_pack(ids[at : at + blocks_at_once * BLOCK]) for at in range(0, len(ids), blocks_at_once * BLOCK)]
    words, escapes, blocks = [], [], []
    ids_before = words_before = escapes_before = 0
    for n, w, e, b in parts:
        w[w >> np.uint64(60) == ESCAPE] += np.uint64(escapes_before)
        words.append(w)
        escapes.append(e)
        blocks.append(b + np.array([ids_before, words_before], np.uint64))
        ids_before, words_before, escapes_before = ids_before + n, words_before + len(w), escapes_before + len(e)
    none = np.empty(0, np.uint64)
    return np.concatenate([none, *words]), np.concatenate([none, *escapes]), np.concatenate([none.reshape(0, 2), *blocks])


def _choose(ids: np.ndarray) -> np.ndarray:
    """For each place the selector whose word takes the most ids from there on.

    More ids of fewer bits fit only where fewer ids of more bits do, so the search goes from wide to
    narrow and ends at the first selector that fits nowhere. Room behind the end of a block counts
    as fitting: the word is then not full.
    """
    rows = -(-len(ids) // BLOCK)
    fits = np.zeros((rows, BLOCK + COUNTS.max()), bool)
    chosen = np.full((rows, BLOCK), ESCAPE, np.int8)
    flat = np.zeros(rows * BLOCK, bool)
    for s in (*range(15, 1, -1), 0):
        flat[: len(ids)] = True if BITS[s] >= 8 * ids.itemsize else ids < (1 << int(BITS[s]))
        flat[len(ids) :] = True
        fits[:, :BLOCK] = flat.reshape(rows, BLOCK)
        fits[:, BLOCK:] = True
        span = 1
        while span < COUNTS[s]:  # all of the next `span` ids fit; doubled up to the count
            step = min(span, COUNTS[s] - span)
            fits[:, :-step] &= fits[:, step:]
            span += step
        here = fits[:, :BLOCK]
        if not here.any():
            break
        chosen[here] = s
    return chosen.reshape(-1)[: len(ids)]


def _pack(ids: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    n = len(ids)
    place = np.arange(n, dtype=np.int32)
    left = np.minimum(n, (place // BLOCK + 1) * BLOCK) - place
    selector = _choose(ids)
    ids = ids.astype(np.uint64)
    takes = np.minimum(COUNTS.astype(np.int32)[selector], left)
    starts = []
    step = takes.tolist()
    i = 0
    while i < n:
        starts.append(i)
        i += step[i]
    starts = np.array(starts, np.int64)
    chosen, count = selector[starts], takes[starts]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in range(2, 16):
        at = np.flatnonzero(chosen == s)
        for k in range(COUNTS[s]):
            some = at[count[at] > k]
            if not len(some):
                break
            words[some] |= ids[starts[some] + k] << np.uint64(k * BITS[s])
    escaped = np.flatnonzero(chosen == ESCAPE)
    words[escaped] |= np.arange(len(escaped), dtype=np.uint64)
    first = np.arange(0, n, BLOCK)
    blocks = np.stack([first, np.searchsorted(starts, first)], axis=1).astype(np.uint64)
    return n, words, ids[starts[escaped]], blocks


def unpack(words: np.ndarray, escapes: np.ndarray, blocks: np.ndarray, n: int, blocks_at_once: int = 64) -> np.ndarray:
    """All ids of the words, by array operations over some blocks at a time."""
    out = np.empty(n, np.uint64)
    table = np.concatenate([blocks.astype(np.int64), [[n, len(words)]]])
    for at in range(0, len(blocks), blocks_at_once):
        part = table[at : at + blocks_at_once + 1]
        (a, w), (z, v) = part[0], part[-1]
        _unpack(words[w:v], escapes, part[:, 0] - a, part[:-1, 1] - w, out[a:z])
    return out


def _unpack(words: np.ndarray, escapes: np.ndarray, ids_at: np.ndarray, words_at: np.ndarray, out: np.ndarray) -> None:
    selector = (words >> np.uint64(60)).astype(np.int64)
    payload = words & PAYLOAD
    count = COUNTS[selector]
    before = np.cumsum(count) - count
    # The last word of a block may have room to spare, so places count from the start of each block.
    block = np.repeat(np.arange(len(words_at)), np.diff(np.append(words_at, len(words))))
    place = before - before[words_at][block] + ids_at[block]
    end = ids_at[1:][block]
    for s in np.unique(selector):
        at = np.flatnonzero(selector == s)
        mask = np.uint64((1 << int(BITS[s])) - 1)
        for k in range(COUNTS[s]):
            some = at[place[at] + k < end[at]]
            if s == ESCAPE:
                out[place[some]] = escapes[payload[some].astype(np.int64)]
            else:
                out[place[some] + k] = (payload[some] >> np.uint64(k * BITS[s])) & mask if s else 0


def shard_bytes(doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    words, escapes, blocks = pack(ids)
    head = np.array([MAGIC, VERSION, len(doc_ids), len(ids), len(words), len(blocks), len(escapes), BLOCK], "<u8")
    table = np.stack([doc_ids.astype("<i8").view("<u8"), counts.astype("<u8")], axis=1)
    return b"".join(x.astype("<u8").tobytes() for x in (head, words, escapes, blocks, table))


def shard_parts(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``doc_ids``, ids per document, and all ids of a shard."""
    magic, version, docs, n, words, blocks, escapes, _ = np.frombuffer(data, "<u8", 8).tolist()
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a token shard of this version")
    cuts = np.cumsum([8, words, escapes, 2 * blocks, 2 * docs])
    if len(data) != 8 * cuts[-1]:
        raise ValueError("a token shard is cut short")
    rest = np.frombuffer(data, "<u8")
    w, e, b, t = (rest[a:z] for a, z in zip(cuts, cuts[1:]))
    table = t.reshape(-1, 2)
    return table[:, 0].view("<i8"), table[:, 1].astype(np.int64), unpack(w, e, b.reshape(-1, 2), n)


SHARDS = "part long, piece long, file string, first_doc long, docs long, ids long, bytes long"


def write_shards(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = None,
    shard_ids: int = 4_000_000, partitions: int | None = None,
) -> DataFrame:
    """Encode ``text`` and write the ids as shards below ``folder``, in ascending order of ``doc_id``.

    Documents are dealt to tasks by ranges of ``doc_id``; each task streams its range and closes a
    shard at ``shard_ids`` ids or after a longer document. Files are named by task attempt, and the
    table of shards, which Spark commits, names those that count: a lost or repeated task leaves
    files that no one reads. Null texts are empty documents, of the end id alone. A row without a
    doc_id is an error in the input, and left out. Rows with equal doc_id are kept, in any order.
    Returns the table of shards as read back.
    """
    spark = docs.sparkSession
    docs = require(docs, "doc_id", "text").where("doc_id IS NOT NULL")
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")
    schema = fields_of(SHARDS)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        to, base = pa_fs.FileSystem.from_uri(folder if ":/" in folder else f"file://{os.path.abspath(folder)}")
        encode = encoder(tokenizer).encode
        doc_ids: list[int] = []
        held: list[bytes] = []
        size = piece = 0

        def close() -> pa.RecordBatch:
            nonlocal size, piece
            counts = np.array([len(x) // 4 for x in held], np.int64)
            data = shard_bytes(np.array(doc_ids, np.int64), counts, np.frombuffer(b"".join(held), "<u4"))
            name = f"tokens-{part:06d}-{piece:05d}-{attempt}.s8b"
            with to.open_output_stream(f"{base}/{name}") as out:
                out.write(data)
            row = [part, piece, name, doc_ids[0], len(doc_ids), int(counts.sum()), len(data)]
            doc_ids.clear(), held.clear()
            size, piece = 0, piece + 1
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for some in text_slices(batch, "text", SLICE):
                texts = some.column("text").to_pylist()
                for doc_id, ids in zip(some.column("doc_id").to_pylist(), encode(texts)):
                    ids += end
                    if held and size + len(ids) // 4 > shard_ids:
                        yield close()
                    doc_ids.append(doc_id)
                    held.append(ids)
                    size += len(ids) // 4
        if held:
            yield close()

    # The folder exists before any task writes to it.
    spark.createDataFrame([], SHARDS).write.mode("overwrite").parquet(f"{folder}/opened")
    dealt = docs.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id")
    map_arrow(dealt, write, SHARDS).write.parquet(f"{folder}/shards")
    return spark.read.schema(SHARDS).parquet(f"{folder}/shards")


def read_shards(shards: DataFrame, folder: str) -> DataFrame:
    """Per document of the shards: ``doc_id``, ``start`` (ids of all documents before it), and its
    ``ids`` as little-endian unsigned 32-bit integers. A task holds one shard at a time."""
    places = running_total(shards.withColumn("order", F.struct("part", "piece")), "order", "ids", "start")
    out = "doc_id long, start long, n_tokens long, ids binary"
    schema = fields_of(out)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to, base = pa_fs.FileSystem.from_uri(folder if ":/" in folder else f"file://{os.path.abspath(folder)}")
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                with to.open_input_stream(f"{base}/{name}") as f:
                    doc_ids, counts, ids = shard_parts(f.read())
                if not (ids >> np.uint64(32)).any():
                    ids = ids.astype("<u4")
                else:
                    raise ValueError(f"{name} holds ids above 32 bits")
                ends = np.cumsum(counts)
                for a in range(0, len(doc_ids), 2000):
                    z = min(a + 2000, len(doc_ids))
                    begins = ends[a:z] - counts[a:z]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(doc_ids[a:z], pa.int64()), pa.array(begins + start, pa.int64()),
                        pa.array(counts[a:z], pa.int64()),
                        pa.array([ids[i:j].tobytes() for i, j in zip(begins, ends[a:z])], pa.binary()),
                    ], schema=schema)

    n = max(1, int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return map_arrow(places.select("file", "start").repartition(n, "file"), read, out)


def crc32_of(ids: DataFrame) -> DataFrame:
    """The digest of each document's ids."""
    return ids.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def write_and_digest(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None) -> DataFrame:
    folder = folder or scratch(docs.sparkSession, "tokens")
    return crc32_of(read_shards(write_shards(docs, folder, tokenizer, end_id), folder))


