"""Broker topics as streams and as bounded reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F


def topic_options(
    servers: str, topic: str, starting: str, group: str | None = None, per_batch: int | None = None
) -> dict[str, str]:
    """``per_batch`` bounds the messages of one micro-batch while a backlog is worked off."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if group:
        options["groupIdPrefix"] = group
    if per_batch:
        options["maxOffsetsPerTrigger"] = str(per_batch)
    return options


def read_topic_stream(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest",
    group: str | None = None, per_batch: int | None = None,
) -> DataFrame:
    """Stream of ``key, value`` as text with the broker's timestamp."""
    options = topic_options(servers, topic, starting, group, per_batch)
    return decode(spark.readStream.format("kafka").options(**options).load())


def read_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Everything the topic holds now."""
    raw = spark.read.format("kafka").options(**topic_options(servers, topic, "earliest"))
    return raw.load()


def read_topic_head(spark: SparkSession, servers: str, topic: str, n: int, checkpoint: str) -> DataFrame:
    """The first ``n`` messages of a topic, undecoded."""
    options = topic_options(servers, topic, "earliest", per_batch=n)
    return first_messages(spark.readStream.format("kafka").options(**options).load(), n, checkpoint)


def first_messages(stream: DataFrame, n: int, checkpoint: str, wait: float = 0.2) -> DataFrame:
    """The first ``n`` messages of a stream, which is read in small batches (``per_batch``) and stopped
    when they are there: a long topic is not read to its end."""
    found: list[Row] = []

    def take(batch: DataFrame, batch_id: int) -> None:
        if len(found) < n:
            found.extend(batch.orderBy("partition", "offset").limit(n - len(found)).collect())

    query = (
        stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    while len(found) < n and not query.awaitTermination(wait):
        pass
    query.stop()
    return stream.sparkSession.createDataFrame(found, stream.schema)


def decode(messages: DataFrame) -> DataFrame:
    return messages.withColumns(
        {"key": F.col("key").cast("string"), "value": F.col("value").cast("string")}
    )


def with_arrival_time(messages: DataFrame) -> DataFrame:
    """Add the processing time, for topics whose records carry no time of their own."""
    return messages.withColumn("proc_time", F.current_timestamp())


def peek(messages: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` messages by partition and offset, with unreadable values set apart.

    ``value`` holds readable JSON; otherwise ``error`` and ``raw_data`` say what arrived.
    """
    # a number, text or list is readable JSON too: only a variant parse tells them from junk
    decoded = decode(messages)
    readable = F.try_parse_json("value").isNotNull()
    first = decoded.orderBy("partition", "offset").limit(n)
    return first.select(
        "key",
        F.when(readable, F.col("value")).alias("value"),
        F.when(F.col("value").isNotNull() & ~readable, F.lit("not valid JSON")).alias("error"),
        F.when(~readable, F.col("value")).alias("raw_data"),
        "partition", "offset", "timestamp",
    )
