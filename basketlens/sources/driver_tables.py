"""The TPC-H-like tables and the event log, presented as the tables of the shop.

Raw schemas are declared, with the zone-less timestamps read as UTC instants: this saves the
schema job and lets time filters reach the scan. Codes are not translated, because a translated
column could not be filtered in the scan; the status code for completed orders is a parameter.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.functions.exact import money
from basketlens.params import Params
from basketlens.session import pin_utc, scratch
from basketlens.sources.lake import read_table
from basketlens.schemas import BIGINT, DOUBLE, INT, STRING, TIMESTAMP, schema_of

RAW = {
    "customer": schema_of(
        c_custkey=BIGINT, c_name=STRING, c_nationkey=INT, c_acctbal=DOUBLE, c_mktsegment=STRING,
    ),
    "orders": schema_of(
        o_orderkey=BIGINT, o_custkey=BIGINT, o_orderstatus=STRING, o_totalprice=DOUBLE,
        o_orderdate=TIMESTAMP, o_orderpriority=STRING,
    ),
    "lineitem": schema_of(
        l_orderkey=BIGINT, l_partkey=BIGINT, l_suppkey=BIGINT, l_linenumber=INT,
        l_quantity=DOUBLE, l_extendedprice=DOUBLE, l_discount=DOUBLE, l_tax=DOUBLE,
        l_returnflag=STRING, l_linestatus=STRING, l_shipdate=TIMESTAMP,
    ),
    "part": schema_of(
        p_partkey=BIGINT, p_name=STRING, p_brand=STRING, p_type=STRING, p_size=INT,
        p_retailprice=DOUBLE,
    ),
    "events": schema_of(
        event_id=BIGINT, ts=TIMESTAMP, user_id=BIGINT, event_type=STRING, value=DOUBLE,
        props=STRING,
    ),
}

# Chosen so that every mart and every alert has rows at all scales.
PARAMS = Params(
    as_of=dt.date(2001, 8, 1),
    completed=("F",),
    high_value=3_500_000,
    medium_value=2_000_000,
    report_high_value=3_500_000,
    report_medium_value=2_000_000,
    product_window="1 day",
    revenue_window="1 day",
    alert_amount=200,
    alert_window="1 day",
    similar_orders=2,
)
FEATURE_DAY = dt.date(2024, 2, 15)  # two weeks after the last event


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(pin_utc(spark), f"{sf_dir}/{name}.parquet", RAW[name])


_written: dict[tuple[str, str, str], str] = {}


def written_log(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> str:
    """Folder of a change log made from the tables, written once per application: the logs stand for
    what a broker would hold, so making them is no part of a query."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = scratch(spark, f"log-{name}")
        make().write.parquet(path)
        _written[key] = path
    return _written[key]


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = written_log(spark, sf_dir, "order-changes", lambda: order_changes(spark, sf_dir))
    return spark.read.schema("value STRING").parquet(path)


def order_message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = written_log(spark, sf_dir, "orders", lambda: order_messages(raw(spark, sf_dir, "events")))
    return spark.readStream.schema("value STRING").parquet(path)


def item_message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = written_log(spark, sf_dir, "items", lambda: item_messages(raw(spark, sf_dir, "events")))
    return spark.readStream.schema("value STRING, event_time TIMESTAMP").parquet(path)


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log as a stream of files. A pattern, because the table may be one file or a
    folder of files, and a stream takes a single file only by pattern. There is no limit of files
    per batch: a backlog is one batch, in which no row can be late."""
    return pin_utc(spark).readStream.schema(RAW["events"]).parquet(f"{sf_dir}/[e]vents.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.col("c_mktsegment").alias("email"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("order_date"),
        money("o_totalprice").alias("total_price"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_custkey").alias("customer_id"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``order_item_id`` is only ever counted; order and line number are no key here."""
    return raw(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money("l_extendedprice").alias("price"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The launch date is derived from the size, for want of one."""
    return raw(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        money("p_retailprice").alias("price"),
        F.col("p_type").alias("category_id"),
        F.date_add(F.lit(dt.date(1995, 1, 1)), F.col("p_size")).cast("timestamp").alias("created_at"),
    )


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = raw(spark, sf_dir, "part").select(F.col("p_type").alias("category_id")).distinct()
    return kinds.withColumn("name", F.col("category_id"))


def order_events(events: DataFrame) -> DataFrame:
    """Every event as an order of its user."""
    return events.select(
        F.col("event_id").alias("order_id"),
        F.col("user_id").alias("customer_id"),
        money("value").alias("total_price"),
        F.col("event_type").alias("status"),
        F.col("ts").alias("event_time"),
    )


def product_events(events: DataFrame, kind: str) -> DataFrame:
    """Events of one type that concern a product, with the product and a quantity. The product
    is read by a generator, which parses each text once however often the column is used."""
    concerned = events.filter(F.col("event_type") == kind).select(
        "event_id", "user_id", "value", "ts", F.json_tuple("props", "k").alias("product")
    )
    return concerned.select(
        F.col("event_id").alias("order_item_id"),
        F.col("event_id").alias("order_id"),
        F.col("user_id").alias("customer_id"),
        F.col("product").cast("bigint").alias("product_id"),
        (F.col("event_id") % 5 + 1).cast("int").alias("quantity"),
        money("value").alias("price"),
        F.col("ts").alias("event_time"),
    )


def carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_events(raw(spark, sf_dir, "events"), "click").select(
        F.col("order_item_id").alias("cart_id"), "quantity",
        F.col("event_time").alias("added_at"), "customer_id", "product_id",
    )


def wishlists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_events(raw(spark, sf_dir, "events"), "view").select(
        F.col("order_item_id").alias("wishlist_id"),
        F.col("event_time").alias("added_at"), "customer_id", "product_id",
    )


def shop(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All tables by their shop names."""
    readers = {
        "customers": customers, "orders": orders, "order_items": order_items,
        "products": products, "categories": categories, "carts": carts, "wishlists": wishlists,
    }
    return {name: read(spark, sf_dir) for name, read in readers.items()}


def order_messages(events: DataFrame) -> DataFrame:
    """The order events as JSON change events, the form in which the broker carries them."""
    image = F.struct(
        F.col("event_id").alias("order_id"),
        F.col("user_id").alias("customer_id"),
        F.col("value").alias("total_price"),
        F.col("event_type").alias("status"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("order_date"),
        F.lit("c").alias("__op"),
        F.lit("orders").alias("__table"),
        F.col("event_id").alias("__lsn"),
    )
    return events.select(F.to_json(F.struct(image.alias("payload"))).alias("value"))


def item_messages(events: DataFrame) -> DataFrame:
    """Purchases as JSON item events; the broker's record time is the only time they have.

    Error events become items without a quantity, which the parser has to drop.
    """
    image = F.struct(
        F.col("event_id").alias("order_item_id"),
        F.col("event_id").alias("order_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
        F.when(F.col("event_type") == "purchase", F.col("event_id") % 5 + 1).alias("quantity"),
        F.col("value").alias("price"),
        F.lit("c").alias("__op"),
        F.lit("order_items").alias("__table"),
        F.col("event_id").alias("__lsn"),
    )
    sold = events.filter(F.col("event_type").isin("purchase", "error"))
    return sold.select(
        F.to_json(F.struct(image.alias("payload"))).alias("value"), F.col("ts").alias("event_time")
    )


def item_changes(events: DataFrame) -> DataFrame:
    """A log of purchased items: each is inserted, those with an even id get one more unit later, and
    those with an id that three divides are deleted, with their full image."""
    steps = F.array(F.lit("c"), F.when(F.col("event_id") % 2 == 0, "u"), F.when(F.col("event_id") % 3 == 0, "d"))
    image = F.struct(
        F.col("event_id").alias("order_item_id"),
        F.col("event_id").alias("order_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
        (F.col("event_id") % 5 + 1 + (F.col("op") == "u").cast("int")).alias("quantity"),
        F.col("value").alias("price"),
        F.col("op").alias("__op"),
        F.lit("order_items").alias("__table"),
        F.col("event_id").alias("__lsn"),
        F.when(F.col("op") == "d", "true").otherwise("false").alias("__deleted"),
    )
    sold = events.filter(F.col("event_type") == "purchase").withColumn("op", F.explode(F.array_compact(steps)))
    return sold.select(F.to_json(F.struct(image.alias("payload"))).alias("value"))


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change log of all orders, as JSON texts.

    Every order is inserted as pending and later updated to its status; orders in status P are
    then deleted, which leaves a delete event with little more than the key, and a tombstone.
    Orders of priority 5-LOW add an event without a date and one that is cut off.
    """
    insert, update, delete, tombstone, undated, cut_off = range(6)
    deleted = F.col("o_orderstatus") == "P"
    low = F.col("o_orderpriority") == "5-LOW"
    steps = F.array(
        F.lit(update), F.lit(insert),
        F.when(deleted, delete), F.when(deleted, tombstone),
        F.when(low, undated), F.when(low, cut_off),
    )
    step = F.col("step")
    whole, dated = step != delete, ~step.isin(delete, undated)
    image = F.struct(
        F.col("o_orderkey").alias("order_id"),
        F.when(step == insert, "c").when(step == delete, "d").otherwise("u").alias("__op"),
        F.lit("orders").alias("__table"),
        (F.col("o_orderkey") * 10 + F.when(step.isin(insert, delete), step).otherwise(update)).alias("__lsn"),
        F.when(step == delete, "true").otherwise("false").alias("__deleted"),
        F.when(whole, F.col("o_custkey")).alias("customer_id"),
        F.when(whole, F.col("o_totalprice")).alias("total_price"),
        F.when(step == insert, "pending").when(whole, F.col("o_orderstatus")).alias("status"),
        F.when(dated, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("order_date"),
    )
    events = raw(spark, sf_dir, "orders").select("*", F.explode(F.array_compact(steps)).alias("step"))
    text = F.to_json(F.struct(image.alias("payload")))
    cut = F.when(step == cut_off, 20).otherwise(F.length("text"))
    return events.select("step", text.alias("text")).select(
        F.when(step != tombstone, F.substring("text", F.lit(1), cut)).alias("value")
    )
