"""A table that change logs are merged into, kept in buckets of its key.

A merge reads and writes only the buckets that the log touches. Every merge writes its buckets to a
folder of its own and then commits by one small file, which names the folder of each bucket. So
readers see a merge whole or not at all, and one that fails leaves the table as it was.

    path/data/version=3/bucket=7/...    rows of the bucket as of merge 3
    path/commits/version=3/...          which version holds each bucket, and the layout

One writer at a time; readers need no lock.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.operators.changes import latest_images
from basketlens.session import staged

LSN = "__lsn"
COMMIT = "bucket INT, held INT, keys ARRAY<STRING>, buckets INT, layout STRING"


@dataclass(frozen=True)
class Merged:
    """What a merge did: the version it made, the buckets it rewrote, and of how many."""

    version: int
    touched: tuple[int, ...]
    buckets: int


class BucketTable:
    """``BucketTable(spark, path)`` opens a table; ``BucketTable.create`` makes one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        last = self._last()
        if last is None:
            raise FileNotFoundError(f"no table at {path}")
        # A row per bucket, and one for the table as a whole.
        rows = spark.read.schema(COMMIT).parquet(f"{path}/commits/version={last}").collect()
        whole = next(r for r in rows if r.bucket is None)
        self.version, self.keys, self.buckets = last, tuple(whole["keys"]), whole.buckets
        self.schema = T.StructType.fromJson(json.loads(whole.layout))
        self.held = {r.bucket: r.held for r in rows if r.bucket is not None}

    @classmethod
    def create(cls, df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> BucketTable:
        """The rows of ``df``, one per key, as version 0. A bucket is what one merge rewrites for a single
        change: take as many as make a bucket some hundred megabytes."""
        table = cls.__new__(cls)
        table.spark, table.path, table.keys, table.buckets = df.sparkSession, path, tuple(keys), buckets
        table.schema, table.held, table.version = df.schema, {}, -1
        if table._last() is not None:
            raise FileExistsError(f"there is a table at {path}")
        table._write(df.withColumn(LSN, F.lit(None).cast("bigint")), range(buckets))
        return cls(table.spark, path)

    def read(self, only: Sequence[int] | None = None) -> DataFrame:
        return self._rows(only).drop(LSN)

    def of_keys(self, wanted: DataFrame) -> DataFrame:
        """The rows of some keys, from their buckets alone."""
        keys = staged(self._keyed(wanted).select(*self.keys).distinct(), "wanted")
        return self.read(self._buckets_of(keys)).join(keys, list(self.keys), "left_semi")

    def merge(self, records: DataFrame) -> Merged:
        """Bring the table up to date with flattened change records (``__lsn``, ``__deleted`` and the
        table's columns): changed rows take their last image, deleted rows go. Changes without a key are
        left out; rows without one stay.

        The log is parsed and reduced once and written; a log that is applied again changes nothing,
        and an older one does not undo newer images of rows that are there.
        """
        columns = [F.col(c).try_cast(self.schema[c].dataType).alias(c) for c in self.schema.names]
        filled = " AND ".join(f"`{k}` IS NOT NULL" for k in self.keys)
        log = records.select(*columns, LSN, "__deleted").where(filled)
        last = staged(latest_images(log, self.keys), "images")
        touched = self._buckets_of(last)
        if not touched:
            return Merged(self.version, (), self.buckets)
        # Rows without a position came with the table and are older than any change; at equal positions the change counts.
        stored = self._rows(touched)
        before = stored.where(filled).withColumns({"__deleted": F.lit(False), "_change": F.lit(0)})
        images = before.unionByName(last.withColumn("_change", F.lit(1)))
        image = F.struct(*[F.col(c) for c in images.columns if c not in self.keys])
        newest = F.struct(F.coalesce(LSN, F.lit(-(1 << 63))), "_change")
        merged = images.groupBy(*self.keys).agg(F.max_by(image, newest).alias("_image")).select(*self.keys, "_image.*")
        alive = merged.where("NOT __deleted").select(*self.schema.names, LSN)
        self._write(alive.unionByName(stored.where(f"NOT ({filled})")), touched)
        now = BucketTable(self.spark, self.path)
        self.version, self.held = now.version, now.held
        return Merged(self.version, tuple(touched), self.buckets)

    def drop_unused(self, delete) -> list[str]:
        """Folders of buckets that the last commit no longer names are given to ``delete``, one by one. Not
        while a reader may still be at an earlier version."""
        written = self._partitions(f"{self.path}/data")
        old = [f"{self.path}/data/version={v}/bucket={b}" for v, b in written if self.held.get(b) != v]
        for folder in old:
            delete(folder)
        return old

    # --- inside ---

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias("bucket")

    def _keyed(self, df: DataFrame) -> DataFrame:
        """Keys in the types of the table, as their hash depends on it."""
        return df.withColumns({k: F.col(k).cast(self.schema[k].dataType) for k in self.keys})

    def _buckets_of(self, keys: DataFrame) -> list[int]:
        return sorted(r.bucket for r in keys.select(self._bucket()).distinct().collect())  # as many as buckets, at most

    def _rows(self, only: Sequence[int] | None = None) -> DataFrame:
        stored = T.StructType([*self.schema.fields, T.StructField(LSN, T.LongType())])
        paths = [f"{self.path}/data/version={v}/bucket={b}" for b, v in sorted(self.held.items()) if only is None or b in set(only)]
        if not paths:
            return self.spark.createDataFrame([], stored)
        return self.spark.read.schema(stored).parquet(*paths)

    def _write(self, rows: DataFrame, touched: Sequence[int]) -> None:
        version = self.version + 1
        data = f"{self.path}/data/version={version}"
        bucketed = rows.withColumn("bucket", self._bucket()).hint("rebalance", F.col("bucket"))
        # The folder as a whole is replaced: all that a failed merge left in it goes.
        bucketed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(data)
        filled = {b for _, b in self._partitions(data, version)}
        held = {b: v for b, v in self.held.items() if b not in set(touched)} | {b: version for b in filled}
        layout = self.schema.json()
        commit = [(None, version, list(self.keys), self.buckets, layout)] + [(b, v, None, None, None) for b, v in sorted(held.items())]
        self.spark.createDataFrame(commit, COMMIT).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/version={version}")

    def _partitions(self, path: str, version: int | None = None) -> list[tuple[int, int]]:
        """Versions and buckets of the folders below ``path`` that hold rows."""
        try:
            files = self.spark.read.parquet(path)
        except AnalysisException:
            return []  # no file was written, as there are no rows
        if "bucket" not in files.columns:
            return []
        own = F.lit(version) if version is not None else F.col("version")
        return sorted((r[0], r[1]) for r in files.select(own.alias("version"), "bucket").distinct().collect())

    def _last(self) -> int | None:
        try:
            commits = self.spark.read.schema(f"{COMMIT}, version INT").parquet(f"{self.path}/commits")
        except AnalysisException:
            return None
        return commits.where("bucket IS NULL").agg(F.max("version")).first()[0]

