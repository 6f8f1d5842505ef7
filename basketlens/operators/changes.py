"""Change events: decoding, filtering, latest state. All stateless parts also run on streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.schemas import CAPTURED_TABLES, change_event

CREATED = ("c", "r")


def payloads(events: DataFrame, table: str) -> DataFrame:
    """After-images of ``table`` from the JSON text in ``value``; unreadable events are dropped.

    The image is unpacked by a generator: filters on its columns stay above it, so each text is
    parsed once. As a plain projection, every later filter would parse it again.
    """
    image = F.from_json("value", change_event(table))["payload"]
    kept = [c for c in events.columns if c not in ("value", "key")]
    return events.select(*kept, F.inline(F.filter(F.array(image), lambda i: i.isNotNull())))


def change_records(events: DataFrame, table: str) -> DataFrame:
    """Flattened change log: tombstones (null values) dropped, deletes kept and flagged.

    Deletes may carry little more than the key, so no column is required to be filled.
    """
    records = payloads(events.filter(F.col("value").isNotNull()), table)
    deleted = (F.col("__deleted") == "true") | (F.col("__op") == "d")
    return records.withColumn("__deleted", F.coalesce(deleted, F.lit(False)))


def captured(records: DataFrame, tables: Sequence[str] = CAPTURED_TABLES) -> DataFrame:
    return records.filter(F.col("__table").isin(*tables))


def parse_orders(events: DataFrame) -> DataFrame:
    """Order events with ``event_time`` and epoch-millisecond ``timestamp``; events without a
    readable order date are dropped."""
    orders = payloads(events, "orders").withColumn("event_time", F.try_to_timestamp("order_date"))
    return (
        orders.filter(F.col("event_time").isNotNull())
        .withColumn("timestamp", F.unix_millis("event_time"))
        .withColumn("total_price", F.col("total_price").cast("decimal(18,2)"))
    )


def parse_order_items(events: DataFrame) -> DataFrame:
    """Item events that name a product and a quantity."""
    items = payloads(events, "order_items")
    return items.filter(F.col("product_id").isNotNull() & F.col("quantity").isNotNull()).withColumn(
        "price", F.col("price").cast("decimal(18,2)")
    )


def created_only(records: DataFrame) -> DataFrame:
    """Count orders, not change events: keep inserts and snapshot reads. Stateless. Records that
    do not say what happened count as inserts."""
    return records.filter(F.coalesce("__op", F.lit("c")).isin(*CREATED))


def first_event_per_key(stream: DataFrame, key: str, time: str, delay: str, order: str = "__lsn") -> DataFrame:
    """Streaming de-duplication by one aggregation: of the events of a key with one time, the first
    by ``order``. ``time`` is the row's own, which its changes do not move, such as the date of an
    order; a change that does move it counts as another event.

    Each task keeps one event per key and time before the shuffle, so a key that holds much of the
    stream costs no more than any other, and there is one state, which holds a key until the
    watermark passes its time. Events come out at that moment, ``delay`` of event time after their
    own. Repeats may come as late as that; later ones are dropped.
    """
    columns = [c for c in stream.columns if c not in (key, time)]
    # Values that are not used further on are not kept; the order also settles equal or missing positions.
    position = F.coalesce(F.col(order).cast("bigint"), F.xxhash64(*columns)) if order in columns else F.xxhash64(*columns)
    timed = stream.withWatermark(time, delay).withColumn("_position", position)
    first = timed.groupBy(key, time).agg(*[F.min_by(c, "_position").alias(c) for c in columns])
    return first.select(*stream.columns)


def latest_images(records: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Last image per key by log position, whatever order events arrived in.

    Each task keeps one image per key before the shuffle, so a key with very many changes
    costs no more than any other.
    """
    image = F.struct(*[F.col(c) for c in records.columns if c not in keys])
    last = records.groupBy(*keys).agg(F.max_by(image, F.col("__lsn")).alias("_image"))
    return last.select(*keys, "_image.*")


def current_state(records: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows alive after replaying the log."""
    alive = latest_images(records, keys).filter(~F.col("__deleted"))
    return alive.drop("__op", "__table", "__lsn", "__deleted")


def apply_changes(current: DataFrame, records: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A table brought up to date: rows without changes stay, changed rows take their last image,
    deleted rows go.

    The table's rows count as images older than any change, so one aggregation over both decides,
    and the log is read, parsed and shuffled once.
    """
    position, gone = F.col("__lsn"), F.col("__deleted")
    before = current.withColumns({"__lsn": F.lit(None).cast("bigint"), "__deleted": F.lit(False)})
    log = records.select(*(F.col(c).cast(current.schema[c].dataType).alias(c) for c in current.columns), "__lsn", "__deleted")
    images = before.unionByName(log).withColumn("__lsn", F.coalesce(position, F.lit(-(1 << 63))))
    alive = latest_images(images, keys).filter(~gone)
    return alive.select(*current.columns)
