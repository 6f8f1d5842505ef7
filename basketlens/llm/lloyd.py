"""Centroid clustering by Lloyd's rounds over shards of dimensions, in exact integers.

Rows are gathered into blocks, and each block is cut into shards of columns. A task holds some
(block, shard) pieces and computes their exact squared distances to the matching slices of the
centroids. Pieces of a block are added under the block's key, which gives the nearest centroid of
each row. The numbers of the nearest centroids, two bytes a row, go back to the shards, which stay
where they are, and every shard sums its own slice per cluster.

What passes through the driver is the centroids alone: clusters times dimensions integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import fields_of, map_arrow, require, ship, staged


@dataclass(frozen=True)
class Settings:
    """A component x counts as floor(``scale`` * x). Starting centroids are the vectors with the smallest
    sha256 of ``seed``:vec_id. ``block`` rows are one block of ``shards`` column blocks."""

    clusters: int = 40
    rounds: int = 5
    dimension: int = 64
    scale: int = 256
    seed: int = 2
    shards: int = 4
    block: int = 4096


# --- exact integers --------------------------------------------------------------------------

PLAIN = 1 << 50  # beyond this an array holds Python's integers, which have no bound


def integers(v: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * v) for finite doubles, exactly."""
    if not v.size or np.abs(v).max() < PLAIN / scale:
        return np.floor(v * scale).astype(np.int64)
    exact = [(n * scale) // d for n, d in (x.as_integer_ratio() for x in v.ravel().tolist())]
    return np.array(exact, object).reshape(v.shape)


def largest(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min())) if x.size else 0


def pack(x: np.ndarray) -> bytes:
    """The shortest of two, four and eight bytes a number; decimal text for numbers without bound."""
    most = largest(x)
    for kind, bits in (("i2", 15), ("i4", 31), ("i8", 63)):
        if most < 1 << bits:
            return kind.encode() + x.astype(f"<{kind}").tobytes()
    return b"tx" + ",".join(map(str, x.ravel().tolist())).encode()


def unpack(data: bytes, width: int) -> np.ndarray:
    kind = data[:2].decode()
    if kind == "tx":
        x = np.array([int(t) for t in data[2:].split(b",")], object)
    else:
        x = np.frombuffer(data, f"<{kind}", offset=2).astype(np.int64)
        if largest(x) >= PLAIN:
            x = x.astype(object)
    return x.reshape(-1, width)


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to centroids over some columns."""
    bound = x.shape[1] * (2 * max(largest(x), largest(centroids))) ** 2
    if bound < 1 << 53:  # every intermediate sum is an integer that a double holds
        f, g = x.astype(float), centroids.astype(float)
        return ((f * f).sum(1)[:, None] + (g * g).sum(1) - 2 * (f @ g.T)).astype(np.int64)
    kind = np.int64 if bound < 1 << 63 else object
    x, centroids = x.astype(kind), centroids.astype(kind)
    return np.stack([((x - c) ** 2).sum(1) for c in centroids], 1)


def added(parts: list[np.ndarray]) -> np.ndarray:
    if sum(map(largest, parts)) >= 1 << 63:
        parts = [p.astype(object) for p in parts]
    return sum(parts[1:], parts[0])


def as_longs(x: np.ndarray) -> pa.Array:
    """Null for what a long does not hold."""
    return pa.array([n if n < 1 << 63 else None for n in x.tolist()] if x.dtype == object else x, pa.int64())


# --- blocks ----------------------------------------------------------------------------------


def usable(vectors: DataFrame, settings: Settings) -> DataFrame:
    v = F.col("embedding").cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = require(vectors, "vec_id", "embedding").select("vec_id", v.alias("v"))
    return rows.where(F.col("v").isNotNull()).where(F.size("v") == settings.dimension).where(finite)


def columns_of_shard(settings: Settings, shard: int) -> slice:
    edges = np.linspace(0, settings.dimension, settings.shards + 1).astype(int)
    return slice(int(edges[shard]), int(edges[shard + 1]))


PIECES = "block long, shard int, data binary, ids array<bigint>"


def cut(rows: DataFrame, settings: Settings) -> DataFrame:
    """One row per block and shard; shard 0 also carries the ids. Blocks do not cross tasks."""
    schema = fields_of(PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for a in range(0, batch.num_rows, settings.block):
                piece = batch.slice(a, settings.block)
                v = np.asarray(piece.column("v").flatten(), float).reshape(-1, settings.dimension)
                x = integers(v, settings.scale)
                shards = range(settings.shards)
                yield pa.RecordBatch.from_arrays([
                    pa.array([block] * settings.shards, pa.int64()), pa.array(shards, pa.int32()),
                    pa.array([pack(x[:, columns_of_shard(settings, s)]) for s in shards], pa.binary()),
                    pa.array([piece.column("vec_id").to_pylist()] + [None] * (settings.shards - 1), pa.list_(pa.int64())),
                ], schema=schema)
                block += 1

    return staged(map_arrow(rows, run, PIECES), "pieces")


NEAREST = "block long, labels binary, cluster array<int>, distance array<bigint>"


def nearest(pieces: DataFrame, centroids: np.ndarray, settings: Settings) -> DataFrame:
    """Per block the number of the nearest centroid (ties: the smaller) and the distance of each row."""
    k, schema = len(centroids), fields_of(NEAREST)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, shard, data in zip(*(batch.column(c).to_pylist() for c in ("block", "shard", "data"))):
                at = columns_of_shard(settings, shard)
                d = distances(unpack(data, at.stop - at.start), centroids[:, at])
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([pack(d)], pa.binary())], names=["block", "d"])

    def least(table: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        d = added([unpack(data, k) for data in table.column("d").to_pylist()])
        label = d.argmin(1)
        return pa.table([
            table.column("block").slice(0, 1), pa.array([pack(label)], pa.binary()), pa.array([label], pa.list_(pa.int32())),
            pa.ListArray.from_arrays(pa.array([0, len(d)], pa.int32()), as_longs(d[np.arange(len(d)), label])),
        ], schema=schema)

    ship(pieces.sparkSession)
    measured = map_arrow(pieces.select("block", "shard", "data"), measure, "block long, d binary")
    return measured.groupBy("block").applyInArrow(least, NEAREST)


SUMS = "shard int, cluster int, rows long, total binary"


def moved(pieces: DataFrame, labels: DataFrame, centroids: np.ndarray, settings: Settings) -> np.ndarray:
    """Centroids as the floored means of their rows; a centroid without rows stays."""
    schema = fields_of(SUMS)

    def table(sums: dict) -> pa.Table:
        rows = [(s, c, n, pack(np.array(total, object))) for (s, c), (n, total) in sorted(sums.items())]
        return pa.table([pa.array(x, t) for x, t in zip(zip(*rows), schema.types)], schema=schema) if rows else schema.empty_table()

    def add(sums: dict, key: tuple[int, int], n: int, total: list[int]) -> None:
        before = sums.get(key, (0, [0] * len(total)))
        sums[key] = before[0] + n, [a + b for a, b in zip(before[1], total)]

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for batch in batches:
            for shard, data, labels in zip(*(batch.column(c).to_pylist() for c in ("shard", "data", "labels"))):
                at = columns_of_shard(settings, shard)
                x, label = unpack(data, at.stop - at.start), unpack(labels, 1)[:, 0]
                for c in np.unique(label).tolist():
                    own = x[label == c]
                    add(sums, (shard, c), len(own), own.sum(0).tolist())
        yield from table(sums).to_batches()

    def of_slice(group: pa.Table) -> pa.Table:
        sums: dict = {}
        for shard, c, n, total in zip(*(group.column(i).to_pylist() for i in range(4))):
            add(sums, (shard, c), n, unpack(total, 1)[:, 0].tolist())
        return table(sums)

    every = F.explode(F.array(*(F.lit(s) for s in range(settings.shards))))
    labelled = pieces.join(labels.select("block", "labels", every.alias("shard")), ["block", "shard"])
    sums = map_arrow(labelled.select("shard", "data", "labels"), of_task, SUMS).groupBy("shard", "cluster").applyInArrow(of_slice, SUMS)
    out = centroids.astype(object)
    for r in sums.collect():  # clusters times shards rows
        out[r.cluster, columns_of_shard(settings, r.shard)] = [t // r.rows for t in unpack(r.total, 1)[:, 0].tolist()]
    return out


def start(rows: DataFrame, settings: Settings) -> np.ndarray:
    text = F.concat(F.lit(f"{settings.seed}:"), F.col("vec_id").cast("string"))
    first = rows.orderBy(F.sha2(text, 256).asc_nulls_last(), "v").limit(settings.clusters).collect()
    return integers(np.array([r.v for r in first], float).reshape(-1, settings.dimension), settings.scale).astype(object)


def clusters(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256`` per vector.

    Vectors that are null, of another number of components, or hold null or non-finite ones are left
    out. Every row counts, repeated ones too; rows without an id are assigned, but start no centroid
    while others can (equal hashes: the smaller vector first). Fewer vectors than clusters give fewer clusters, none give no
    rows. A distance or sum that no long holds is null.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, settings)
    centroids = start(rows, settings)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    table = cut(rows, settings)
    # Pieces keep their place for all rounds; a lost one is read again from the written table.
    places = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = table.select("block", "shard", "data").repartition(places, "block", "shard").persist(StorageLevel.DISK_ONLY)
    try:
        for _ in range(settings.rounds):
            centroids = moved(pieces, nearest(pieces, centroids, settings), centroids, settings)
        last = nearest(pieces, centroids, settings).drop("labels").join(table.where("shard = 0").select("block", "ids"), "block")
        each = F.explode(F.arrays_zip("ids", "cluster", "distance")).alias("one")
        found = staged(last.select(each).select(F.col("one.ids").alias("vec_id"), "one.cluster", "one.distance"), "clusters")
    finally:
        pieces.unpersist()

    whole = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)")))
    sums = {r[0]: r[1] for r in found.groupBy("cluster").agg(whole).collect()}  # a row per cluster
    total = None if None in sums.values() else sum(sums.values())
    long = lambda n: None if n is None or n >= 1 << 63 else int(n)
    of = [(c, long(n), long(total), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, n in sorted(sums.items())]
    facts = spark.createDataFrame(of, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
