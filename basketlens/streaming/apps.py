"""The stream applications, from orders or items to their destination.

``messages`` holds the JSON texts of a topic in ``value`` (see ``sources.topics``). Applications
on orders take parsed orders, either straight from messages or from the lake: when several
applications run, land the orders once and let the others read the landed table, so that each
text is parsed only once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketlens.operators import changes
from basketlens.operators.cleaning import clean_table, without_columns
from basketlens.params import Params
from basketlens.plans.ingest import SECRET_COLUMNS
from basketlens.schemas import BOOLEAN, PRIMARY_KEYS, TABLES, schema_of
from basketlens.sinks import streams as sinks
from basketlens.sinks.buckets import BucketTable
from basketlens.sinks.delivery import delivery_handler
from basketlens.sources.database import Database
from basketlens.streaming import orders as order_streams
from basketlens.streaming import products as product_streams


def _counted(orders: DataFrame, p: Params, per_change: bool) -> DataFrame:
    """Timed orders. An order is counted once, when it is created, unless every change of an
    order is to be counted."""
    return order_streams.timed(orders if per_change else changes.created_only(orders), p)


def orders_of(messages: DataFrame, p: Params, per_change: bool = False) -> DataFrame:
    """Orders from the messages of the order topic."""
    return _counted(changes.parse_orders(messages), p, per_change)


def untimed_orders_of(messages: DataFrame, per_change: bool = False) -> DataFrame:
    """The same without a watermark: what ``order_alerts`` parses only once for all of its rules."""
    orders = changes.parse_orders(messages)
    return orders if per_change else changes.created_only(orders)


def items_of(messages: DataFrame, per_change: bool = False) -> DataFrame:
    """Items sold, from the messages of the item topic: an item counts once, when it is created,
    unless every change of it is to be counted. Deletes are not sales."""
    items = changes.parse_order_items(messages)
    if per_change:
        return items.filter(F.coalesce(F.col("__deleted"), F.lit("false")) != "true").filter(F.coalesce("__op", F.lit("c")) != "d")
    return changes.created_only(items)


def landed_orders(spark: SparkSession, path: str, p: Params, per_change: bool = False) -> DataFrame:
    """Stream of the orders that ``land_orders`` writes."""
    landed = spark.readStream.schema(order_streams.LANDED).parquet(path)
    orders = landed.withColumnsRenamed({"order_date": "event_time", "op": "__op"})
    return _counted(orders, p, per_change)


def revenue_statistics(
    orders: DataFrame, p: Params, servers: str, topic: str, checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Revenue per window, published as JSON records."""
    records = order_streams.revenue_records(order_streams.window_revenue(orders, p.revenue_window))
    return sinks.to_topic(records, servers, topic, checkpoint, interval)


def top_product_statistics(
    messages: DataFrame, p: Params, servers: str, topic: str, checkpoint: str,
    by: str = "quantity", interval: str | None = None, per_change: bool = False,
) -> StreamingQuery:
    """Best sellers per window, published as JSON records."""
    items = order_streams.timed(items_of(messages, per_change), p, "timestamp")

    def publish(rank: Callable[[DataFrame], DataFrame]):
        return sinks.batch_topic(
            servers, topic, lambda closed: product_streams.top_product_records(rank(closed))
        )

    return product_streams.ranking_stream(items, p, publish, checkpoint, by, "timestamp", interval)


def order_alerts(
    orders: DataFrame, p: Params, checkpoint: str, log_path: str | None = None,
    send: Callable[[dict], int] | None = None, interval: str | None = None,
) -> StreamingQuery:
    """High-value and frequent-order alerts, delivered through ``send`` or else printed."""
    alerts = order_streams.all_alerts(orders, p)
    if send is None:
        return sinks.to_console(order_streams.with_alert_text(alerts), checkpoint, interval)
    if log_path is None:
        raise ValueError("delivery needs a folder for its log")
    return sinks.per_batch(alerts, delivery_handler(log_path, send), checkpoint, interval)


def land_orders(
    messages: DataFrame, p: Params, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Every parsed order event appended to the lake."""
    landed = order_streams.landed(order_streams.timed(changes.parse_orders(messages), p))
    return sinks.to_files(landed, path, checkpoint, interval=interval)


def latest_rows(records: DataFrame, table: str) -> DataFrame:
    """The last image per key of a batch of flattened records, in the declared types and without
    secrets; ``deleted`` marks keys whose last change took them away."""
    key = PRIMARY_KEYS[table]
    last = changes.latest_images(records, [key])
    declared = schema_of(**{f.name: f.dataType for f in TABLES[table].fields}, deleted=BOOLEAN)
    return without_columns(clean_table(last.withColumnRenamed("__deleted", "deleted"), declared), *SECRET_COLUMNS)


def copy_to_table(
    messages: DataFrame, table: str, db: Database, target: str, checkpoint: str,
    execute: Callable[[list[str]], None], interval: str | None = None,
) -> StreamingQuery:
    """Keep a database table equal to a captured one: changed rows take their last image, deleted
    rows go. ``execute`` runs statements on the database, all in one transaction."""
    handle = sinks.batch_upsert(
        db, target, f"{target}_staging", [PRIMARY_KEYS[table]], lambda batch: latest_rows(batch, table), execute
    )
    return sinks.per_batch(changes.change_records(messages, table), handle, checkpoint, interval)


def keep_table(
    messages: DataFrame, table: str, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Keep a bucketed table of the lake (``sinks.buckets``) equal to a captured one. Each batch rewrites
    the buckets it touches; a repeated batch changes nothing."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        BucketTable(batch.sparkSession, path).merge(batch)

    return sinks.per_batch(changes.change_records(messages, table), handle, checkpoint, interval)
