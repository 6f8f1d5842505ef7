"""Session settings and the shared folder for checkpoints and stream output."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# State beyond the heap: windows per customer and de-duplication keys grow with the stream.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_local_dirs: dict[str, str] = {}


def build_session(
    app: str = "basketlens", master: str | None = None, shuffle_bytes: int | None = None, **conf: str
) -> SparkSession:
    """``shuffle_bytes`` is the largest shuffle expected; it sets how many partitions AQE starts
    from (128 MB each) before it merges small ones."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    )
    if master:
        builder = builder.master(master)
    if shuffle_bytes:
        partitions = max(200, math.ceil(shuffle_bytes / (128 << 20)))
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions)
        )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``.

    Only a local session, which has one machine, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        folder = _local_dirs.setdefault(context.applicationId, "") or tempfile.mkdtemp(prefix="basketlens-")
        _local_dirs[context.applicationId] = folder
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder and continue from the written table."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def stream_settings(spark: SparkSession) -> Iterator[None]:
    """Settings in force while a stream is started, which keeps them for its life.

    State partitions stay fixed with the checkpoint and are not merged at run time, so unless
    the session was given a number, they follow the parallelism of the cluster.
    """
    given = spark.sparkContext.getConf()
    wanted = STATE_STORE | {"spark.sql.shuffle.partitions": str(spark.sparkContext.defaultParallelism)}
    before = {key: spark.conf.get(key, None) for key in wanted if not given.contains(key)}
    try:
        for key in before:
            spark.conf.set(key, wanted[key])
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
