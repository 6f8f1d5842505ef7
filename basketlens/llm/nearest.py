"""Nearest neighbours by inner product, estimated from randomly rotated one-bit codes.

Every vector is turned at random into a space of some more dimensions and coded there by the signs of
its coordinates, 64 to a word, with two numbers beside it: its length, and the inner product of its
direction with its own code. A query's turned direction is rounded to a few bits, kept as bit planes,
so that its inner product with a code is a sum of counted bits of ANDed words. From that the inner
product with the vector is estimated without the vector, and the estimate has an error bound. Of a
block, the best estimates are multiplied in full first; then only candidates whose upper bound
reaches the query's k-th best exact product so far.

Equal vectors are one candidate with several ids, so a vector that very many rows hold is compared
once. Queries and candidates meet in blocks of fixed size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from basketlens.llm.common import fields_of, map_arrow, require, ship, staged


@dataclass(frozen=True)
class Settings:
    """``bound``: error bounds in standard deviations of the estimate; larger is safer and slower.
    ``bits``: of a code per component of a vector. ``planes``: bits that a query's coordinate is rounded to.
    A query block and a candidate block meet in one task."""

    neighbours: int = 20
    bound: float = 3.0
    bits: int = 4
    planes: int = 4
    seed: int = 11
    query_block: int = 4096
    candidate_block: int = 8192


def rotation(dimension: int, bits: int, seed: int) -> np.ndarray:
    """A random rotation of ``dimension`` components into ``bits`` times as many, up to whole words."""
    words = -(-dimension * bits // 64)
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((64 * words, dimension)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits as words, lengths, and inner products of directions with their codes."""
    length = np.linalg.norm(vectors, axis=1)
    turned = (vectors / length[:, None]) @ turn.T
    return _words(turned >= 0), length, np.abs(turned).sum(1) / math.sqrt(len(turn))


def _words(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=-1).view("<u8")


@dataclass
class Asked:
    """Queries in the form that meets codes: bit planes of their rounded coordinates, and what scales them."""

    length: np.ndarray
    low: np.ndarray
    step: np.ndarray
    total: np.ndarray
    planes: np.ndarray

    @classmethod
    def of(cls, queries: np.ndarray, turn: np.ndarray, planes: int) -> Asked:
        length = np.linalg.norm(queries, axis=1)
        turned = (queries / length[:, None]) @ turn.T
        low, most = turned.min(1), (1 << planes) - 1
        step = np.maximum((turned.max(1) - low) / most, 1e-30)
        level = np.rint((turned - low[:, None]) / step[:, None]).astype(np.int64)
        return cls(length, low, step, level.sum(1), np.stack([_words((level >> j) & 1 == 1) for j in range(planes)]))


def estimates(asked: Asked, at: slice, words: np.ndarray, length: np.ndarray, fit: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries by candidates) and their error bounds, from packed words."""
    n = 64 * words.shape[1]
    own = np.bitwise_count(words).sum(1, dtype=np.int32)
    planes = asked.planes[:, at]
    count = np.zeros((planes.shape[1], len(words)), np.int32)
    for w in range(words.shape[1]):
        code = words[:, w][None, :]
        for j, plane in enumerate(planes):
            count += np.bitwise_count(plane[:, w][:, None] & code).astype(np.int32) << j
    low, step, size, total = (x[at][:, None] for x in (asked.low, asked.step, asked.length, asked.total))
    inner = low * (2.0 * own - n) + step * (2.0 * count - total)  # of the rounded direction with the signs
    scale = length / (fit * math.sqrt(n))
    spread = np.sqrt(np.maximum(0, 1 - fit**2) / max(1, n - 1) + step**2 / 12) / fit  # of the code, and of the rounding
    return inner * scale * size, size * length * (bound * spread + 1e-9)


class Best:
    """The k best candidates of each query: largest product, then smallest first id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.query = np.empty(0, np.int64)
        self.score = np.empty(0)
        self.id = np.empty(0, np.int64)
        self.row = np.empty(0, np.int64)
        self.least = np.full(queries, -np.inf)

    def add(self, query: np.ndarray, score: np.ndarray, id_: np.ndarray, row: np.ndarray) -> None:
        if not len(query):
            return
        # Only the queries that have something new are sorted again.
        mine = np.zeros(len(self.least), bool)
        mine[query] = True
        old = mine[self.query]
        rest = [x[~old] for x in (self.query, self.score, self.id, self.row)]
        q, s, i, r = (np.concatenate(x) for x in ((self.query[old], query), (self.score[old], score), (self.id[old], id_), (self.row[old], row)))
        order = np.lexsort((i, -s, q))
        q, s, i, r = q[order], s[order], i[order], r[order]
        begins = np.append(True, q[1:] != q[:-1])
        place = np.arange(len(q)) - np.flatnonzero(begins)[np.cumsum(begins) - 1]
        kept = place < self.k
        last = place == self.k - 1
        self.least[q[last]] = s[last]
        self.query, self.score, self.id, self.row = (np.concatenate(x) for x in zip(rest, (q[kept], s[kept], i[kept], r[kept])))


QUERIES, CANDIDATES = 128, 2048  # that are estimated at once: their words and counts stay near the processor


def search_block(
    queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, words: np.ndarray, length: np.ndarray, fit: np.ndarray,
    turn: np.ndarray, settings: Settings,
) -> tuple[Best, int]:
    """The best candidates of each query in the block, and how many products were made in full."""
    best, asked, full = Best(len(queries), settings.neighbours + 1), Asked.of(queries, turn, settings.planes), 0

    def multiply(query: np.ndarray, row: np.ndarray) -> None:
        nonlocal full
        full += len(query)
        for b in range(0, len(query), 1 << 15):
            q, r = query[b : b + (1 << 15)], row[b : b + (1 << 15)]
            score = (queries[q] * vectors[r]).sum(1)
            fine = score >= best.least[q]
            best.add(q[fine], score[fine], ids[r[fine]], r[fine])

    for a in range(0, len(ids), CANDIDATES):
        z = min(a + CANDIDATES, len(ids))
        for b in range(0, len(queries), QUERIES):
            at = slice(b, b + QUERIES)
            estimate, error = estimates(asked, at, words[a:z], length[a:z], fit[a:z], settings.bound)
            done = np.zeros(estimate.shape, bool)
            if z - a > 2 * best.k:  # the best estimates first: their products say what others have to reach
                first = np.argpartition(estimate, -best.k, axis=1)[:, -best.k :]
                np.put_along_axis(done, first, True, axis=1)
                done &= estimate + error >= best.least[at][:, None]
                query, row = np.nonzero(done)
                multiply(query + b, row + a)
            query, row = np.nonzero((estimate + error >= best.least[at][:, None]) & ~done)
            multiply(query + b, row + a)
    return best, full


def usable(vectors: DataFrame) -> DataFrame:
    """Rows whose vector is not null, zero, empty, or with components that are null or not finite."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return require(vectors, "vec_id", "embedding").select("vec_id", v.alias("v")).where("vec_id IS NOT NULL").where(
        F.col("v").isNotNull() & (F.size("v") > 0) & fine)


CODED = "key long, v array<double>, ids array<bigint>, asked boolean, bits binary, length double, fit double"


def coded(vectors: DataFrame, asked, settings: Settings, dimension: int) -> DataFrame:
    """One row per distinct vector: its smallest ids, whether a query has it, and its code."""
    k = settings.neighbours + 1
    rows = usable(vectors).where(F.size("v") == dimension).withColumn("asked", asked)
    rows = rows.groupBy("v", "vec_id").agg(F.max("asked").alias("asked"))  # equal rows are one
    # Only the smallest ids of a vector can be among the nearest. The limit per vector is taken in
    # every task before the shuffle.
    nth = F.row_number().over(W.partitionBy("v").orderBy("vec_id"))
    few = rows.withColumn("nth", nth).where(F.col("nth") <= k)
    ids = few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    any_asked = rows.groupBy("v").agg(F.max("asked").alias("asked"))
    distinct = ids.join(any_asked, "v").select(F.monotonically_increasing_id().alias("key"), "v", "ids", "asked")
    schema = fields_of(CODED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(dimension, settings.bits, settings.seed)
        for batch in batches:
            if batch.num_rows:
                v = _matrix(batch.column("v"), dimension)
                words, length, fit = encode(v, turn)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array([w.tobytes() for w in words], pa.binary()), pa.array(length), pa.array(fit)], schema=schema)

    return map_arrow(distinct, run, CODED)


def _matrix(column, dimension: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.float64).reshape(-1, dimension)


FOUND = "q long, key long, score double, ids array<bigint>"


def nearest(vectors: DataFrame, asked, settings: Settings = Settings()) -> DataFrame:
    """For every row where ``asked`` (a condition on ``vec_id``) its nearest other rows: ``query_id``,
    ``rank``, ``vec_id``, ``score``.

    Rows with a null id or an unusable vector take no part; neither do vectors of another dimension
    than most usable rows have (ties: the smaller). Rows equal in id and vector are one row, as query
    and as candidate. A query's candidates are all rows but its own; a row with its id and another
    vector is another row. Fewer candidates than asked for are all returned; an empty table gives no
    rows.
    """
    spark = vectors.sparkSession
    most = usable(vectors).groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    first = most["size"]
    table = staged(coded(vectors, asked, settings, first), "codes")
    sizes = table.agg(F.count("*"), F.sum(F.col("asked").cast("int"))).first()
    parts = max(1, math.ceil(sizes[0] / settings.candidate_block))
    groups = max(1, math.ceil((sizes[1] or 0) / settings.query_block))
    out = fields_of(FOUND)

    def join(key, left, right):
        if not left.num_rows or not right.num_rows:
            return out.empty_table()
        q, v = _matrix(left.column("u"), first), _matrix(right.column("v"), first)
        words = np.frombuffer(b"".join(right.column("bits").to_pylist()), "<u8").reshape(len(v), -1)
        best, _ = search_block(
            q, v, pc.list_element(right.column("ids"), 0).to_numpy(), words, right.column("length").to_numpy(), right.column("fit").to_numpy(),
            rotation(first, settings.bits, settings.seed), settings)
        return pa.table({
            "q": left.column("q").to_numpy()[best.query], "key": right.column("key").to_numpy()[best.row], "score": best.score,
            "ids": right.column("ids").take(pa.array(best.row)),
        }).cast(out)

    ship(spark)
    queries = table.where("asked").select(
        F.pmod(F.xxhash64("key"), F.lit(groups)).alias("group"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
        F.col("key").alias("q"), F.col("v").alias("u"))
    codes = table.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group"), F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int").alias("part"),
        "key", "v", "bits", "length", "fit", "ids")
    found = queries.groupBy("group", "part").cogroup(codes.groupBy("group", "part")).applyInArrow(join, FOUND)

    k = settings.neighbours + 1
    by_query = W.partitionBy("q").orderBy(F.desc("score"), F.col("ids")[0], "key")
    some = found.withColumn("nth", F.row_number().over(by_query)).where(F.col("nth") <= k)
    each = some.select("q", "key", F.explode("ids").alias("vec_id"), "score")
    nth = F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "vec_id", "key"))
    each = each.withColumn("nth", nth).where(F.col("nth") <= k)
    # Queries with equal vectors share the search and differ in which row is their own.
    keys = table.where("asked").select(F.col("key").alias("q"), "v")
    own = usable(vectors).where(asked).join(keys, "v").select(F.col("vec_id").alias("query_id"), "q").distinct()
    lists = each.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("nth", "vec_id", "score", "key"))).alias("list"))
    # Its own row is in a list at most once, and a list is one longer than what is asked for.
    others = F.slice(F.filter("list", lambda x: (x.vec_id != F.col("query_id")) | (x.key != F.col("q"))), 1, settings.neighbours)
    return own.join(lists, "q").select("query_id", F.posexplode(others).alias("rank", "one")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), "one.vec_id", "one.score")
