"""Best-fit packing of documents into sequences, with three capacities per sequence.

A piece needs tokens, one document slot, and attention cost (the square of its length). All three
follow from its length, so pieces of one length are interchangeable: the plan is made from counts
per length, at most one per token of capacity whatever the size of the corpus, and each piece finds
its place from its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from basketlens.llm.common import fields_of, map_arrow, require, staged, text_slices
from basketlens.llm.tokens import KEEP, SLICE, encoder


@dataclass(frozen=True)
class Capacity:
    """Of one sequence. ``attention`` bounds the sum of squared piece lengths; by default one piece
    that fills the sequence reaches it. By default neither documents nor attention end a sequence
    before its tokens do; they weigh in the fit."""

    tokens: int = 2048
    documents: int = 2048
    attention: int | None = None

    @property
    def vector(self) -> tuple[int, int, int]:
        return self.tokens, self.documents, self.attention or self.tokens**2

    def need(self, length: int) -> tuple[int, int, int]:
        return length, 1, length * length


def best_bin(rooms: list[int], by_room: dict[int, set], need: tuple, capacity: tuple, score: str):
    """The residual to put a piece in, or None. ``norm``: the least squared norm of what is left,
    each resource as a share of its capacity. ``dot``: the least share of room left beside the
    piece, weighted by what the piece needs.

    Rooms in tokens rise, and tokens alone are part of either score: where that part reaches the
    best score found, no larger room can be better.
    """
    share = [n / c for n, c in zip(need, capacity)]
    best = None
    for room in rooms[bisect_left(rooms, need[0]) :]:
        tokens = (room - need[0]) / capacity[0]
        if best is not None and (tokens * tokens if score == "norm" else tokens * share[0]) > best[0]:
            break
        for left in by_room[room]:
            if left[1] >= need[1] and left[2] >= need[2]:
                rest = [(r - n) / c for n, r, c in zip(need, left, capacity)]
                value = sum(x * x for x in rest) if score == "norm" else sum(x * y for x, y in zip(rest, share))
                if best is None or (value, left) < best:
                    best = value, left
    return best and best[1]


def plan(counts: dict[int, int], capacity: Capacity, score: str = "norm") -> list[tuple[int, int, int, int, int]]:
    """Places ``(length, rank, pieces, sequence, offset)``: the pieces of ``length`` with ranks from
    ``rank`` on go to as many sequences from ``sequence`` on, at ``offset``.

    Longest first, each into the open sequence where it fits best under every capacity. Sequences
    with equal residuals are one class, moved together, so the work follows the number of lengths.
    """
    total = capacity.vector
    classes: dict[tuple, list[tuple[int, int]]] = defaultdict(list)  # residual: (first sequence, number)
    by_room: dict[int, set] = defaultdict(set)  # room in tokens: residuals
    rooms: list[int] = []  # rooms with residuals, rising
    places, sequences = [], 0

    def add(left, first, number):
        if left[0] and left[1] and left[2]:
            classes[left].append((first, number))
            if not by_room[left[0]]:
                insort(rooms, left[0])
            by_room[left[0]].add(left)

    def remove(left):
        del classes[left]
        by_room[left[0]].discard(left)
        if not by_room[left[0]]:
            del rooms[bisect_left(rooms, left[0])]

    for length in sorted(counts, reverse=True):
        need = capacity.need(length)
        if any(n > c for n, c in zip(need, total)):
            raise ValueError(f"a piece of {length} tokens exceeds the capacity of a sequence")
        rank, rest = 0, counts[length]
        while rest:
            left = best_bin(rooms, by_room, need, total, score)
            if left is None:
                # New sequences take as many pieces of this length at once as still fit there.
                fit = min(c // n for n, c in zip(need, total))
                full, extra = divmod(rest, fit)
                for number, held in ((full, fit), (1 if extra else 0, extra)):
                    if number:
                        for k in range(held):
                            places.append((length, rank, number, sequences, k * length))
                            rank += number
                        add(tuple(c - held * n for n, c in zip(need, total)), sequences, number)
                        sequences += number
                rest = 0
                continue
            runs = classes[left]
            first, number = runs.pop()
            used = min(number, rest)
            if used < number:
                runs.append((first + used, number - used))
            if not runs:
                remove(left)
            places.append((length, rank, used, first, total[0] - left[0]))
            rank, rest = rank + used, rest - used
            add(tuple(r - n for n, r in zip(need, left)), first, used)
    return places


PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"


def cut(
    docs: DataFrame, tokenizer: str, end_id: int, most: int, with_ids: bool = False, keep: int = KEEP,
) -> DataFrame:
    """Pieces of at most ``most`` tokens: only longer documents are cut, the last piece may be
    shorter. ``row`` tells rows with equal doc_id apart. Null texts are empty, of the end id alone.
    ``keep`` bounds the pieces of text that a worker remembers."""
    out = PIECES + (", ids binary" if with_ids else "")
    schema = fields_of(out)
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, keep).encode
        for batch in batches:
            for some in text_slices(batch, "text", SLICE):
                rows = []
                encoded = encode(some.column("text").to_pylist())
                for doc_id, row, ids in zip(some.column("doc_id").to_pylist(), some.column("row").to_pylist(), encoded):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), 4 * most)):
                        part = ids[at : at + 4 * most]
                        rows.append((doc_id, row, piece, at // 4, len(part) // 4, zlib.crc32(part), part)[: len(schema)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
                )

    numbered = require(docs, "doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    return map_arrow(numbered, run, out)


def assign(pieces: DataFrame, capacity: Capacity, score: str = "norm", most_places: int = 4_000_000) -> DataFrame:
    """``pieces`` (staged, with ``length``) with ``sequence_id`` and ``offset``.

    A rank within a length is counted per length and task first, so a length that many pieces share
    is not collected anywhere. The plan is broadcast; its size follows the number of lengths.
    """
    spark = pieces.sparkSession
    part = F.shiftright("row", 33)  # the partition in which the document was numbered
    pieces = pieces.withColumn("part", part)
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    base = counts.select("length", "part", F.coalesce(before, F.lit(0)).alias("base"))
    by_length = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = plan(by_length, capacity, score)
    if len(places) > most_places:
        raise ValueError(f"the plan has {len(places)} places; allow more with most_places")
    table = defaultdict(list)
    for length, *place in places:
        table[length].append(place)
    shared = spark.sparkContext.broadcast({k: np.array(v, np.int64) for k, v in table.items()})

    in_part = F.row_number().over(W.partitionBy("length", "part").orderBy("row", "piece")) - 1
    ranked = (
        pieces.withColumn("in_part", in_part.cast("long"))
        .join(base, ["length", "part"])
        .withColumn("rank", F.col("base") + F.col("in_part"))
        .drop("part", "base", "in_part")
    )
    schema = fields_of(", ".join(f"{n} {t}" for n, t in ranked.dtypes if n != "rank") + ", sequence_id long, offset long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for one in np.unique(length):
                at = np.flatnonzero(length == one)
                first = of[one][:, 0]
                k = np.searchsorted(first, rank[at], side="right") - 1
                sequence[at] = of[one][k, 2] + rank[at] - first[k]
                offset[at] = of[one][k, 3]
            rest = [batch.column(n) for n in schema.names[:-2]]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(sequence), pa.array(offset)], schema=schema)

    out = ", ".join(f"`{n}` {t}" for n, t in ranked.dtypes if n != "rank") + ", sequence_id long, offset long"
    return map_arrow(ranked, place, out)


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: Capacity = Capacity(),
    score: str = "norm", with_ids: bool = False, keep: int = KEEP,
) -> DataFrame:
    """One row per piece: where it lies in its document, and in which sequence at which offset.

    Empty and null texts are pieces of the end id alone; equal rows are packed each; a null doc_id
    stays null; an empty table gives no rows. Pieces are staged once, so ids are made once.
    """
    pieces = staged(cut(docs, tokenizer, end_id, capacity.tokens, with_ids, keep), "pieces")
    return assign(pieces, capacity, score).drop("row")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed token ids themselves, one row per sequence; needs pieces with ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id", "length")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.aggregate("parts.ids", F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"),
        F.col("parts.doc_id").alias("doc_ids"), F.col("parts.offset").alias("offsets"),
    )
