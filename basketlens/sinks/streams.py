"""Stream sinks: files, topics, tables, per-batch writers. All keep a checkpoint."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from basketlens.functions.render import json_record
from basketlens.session import stream_settings
from basketlens.sources.database import Database, replace_rows, upsert_statements


def _start(
    stream: DataFrame, writer: DataStreamWriter, checkpoint: str, interval: str | None,
    path: str | None = None,
) -> StreamingQuery:
    """Continuous micro-batches when ``interval`` is given, else all that is available, once."""
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    if interval is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=interval)
    with stream_settings(stream.sparkSession):
        return writer.start(path)


def as_messages(rows: DataFrame) -> DataFrame:
    """Every row as one JSON text in ``value``."""
    return rows.select(json_record(*rows.columns).alias("value"))


def to_files(
    stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
    partition_by: Sequence[str] = (), interval: str | None = None,
) -> StreamingQuery:
    """Append to files, exactly once."""
    writer = stream.writeStream.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _start(stream, writer, checkpoint, interval, path)


def to_topic(
    stream: DataFrame, servers: str, topic: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Publish every row as one JSON text, at least once."""
    writer = as_messages(stream).writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return _start(stream, writer.option("topic", topic), checkpoint, interval)


def to_console(stream: DataFrame, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Print results, for debugging."""
    return _start(stream, stream.writeStream.format("console"), checkpoint, interval)


def per_batch(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    return _start(stream, stream.writeStream.foreachBatch(handle), checkpoint, interval)


def batch_files(
    path: str, transform: Callable[[DataFrame], DataFrame]
) -> Callable[[DataFrame, int], None]:
    """Batch handler that writes ``transform(batch)`` to its own folder. A repeated batch
    replaces its folder, which makes the output exactly once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch).withColumn("batch_id", F.lit(batch_id))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "batch_id"
        ).parquet(path)

    return write


def batch_topic(
    servers: str, topic: str, transform: Callable[[DataFrame], DataFrame]
) -> Callable[[DataFrame, int], None]:
    """Batch handler that publishes the rows of ``transform(batch)`` as JSON, at least once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = as_messages(transform(batch)).write.format("kafka")
        writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()

    return write


def batch_upsert(
    db: Database, target: str, staging: str, keys: Sequence[str], latest: Callable[[DataFrame], DataFrame],
    execute: Callable[[list[str]], None], write: Callable[[DataFrame, Database, str], None] = replace_rows,
    deleted: str = "deleted",
) -> Callable[[DataFrame, int], None]:
    """Batch handler that applies the last image per key of each batch to a database table: rows are
    staged by all tasks, then ``execute`` runs the upsert in one transaction. A repeated batch stages
    and applies the same rows, so it changes nothing."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = latest(batch)
        write(rows, db, staging)
        columns = [c for c in rows.columns if c != deleted]
        execute(upsert_statements(target, staging, columns, keys, deleted))

    return handle
