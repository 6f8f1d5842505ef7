"""Named queries over the driver tables: each takes a session and a data folder."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable
from functools import partial, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens import jobs
from basketlens.operators import changes, checks, cleaning, incremental, interactions
from basketlens.plans import customers, features, ingest, products, recommend, revenue
from basketlens.plans.revenue_state import RevenueState
from basketlens.schemas import BIGINT, INT, PRICE, STRING, TABLES, TIMESTAMP, schema_of
from basketlens.session import pin_utc, scratch
from basketlens.sinks import marts as mart_sink
from basketlens.sinks.buckets import BucketTable
from basketlens.sinks import streams as sinks
from basketlens.sources import catalog, topics
from basketlens.sources import driver_tables as shop
from basketlens.streaming import apps
from basketlens.streaming import orders as order_streams
from basketlens.streaming import products as product_streams

Query = Callable[[SparkSession, str], DataFrame]
P = shop.PARAMS
FEATURE_P = dataclasses.replace(P, as_of=shop.FEATURE_DAY)

REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register ``fn``. Results carry UTC times without a zone, so that they read the same in a
    Python process of any time zone."""

    @wraps(fn)
    def zoneless(spark: SparkSession, sf: str) -> DataFrame:
        result = fn(pin_utc(spark), sf)
        times = [f.name for f in result.schema if isinstance(f.dataType, T.TimestampType)]
        return result.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times})

    REGISTRY[fn.__name__] = zoneless
    return fn


def _utc(day: str) -> Column:
    return F.lit(day).cast("timestamp")


# --- customers -------------------------------------------------------------------------------


@query
def customer_segmentation(spark, sf):
    return customers.customer_segmentation(shop.orders(spark, sf), shop.customers(spark, sf), P)


@query
def segment_distribution(spark, sf):
    return customers.segment_distribution(customer_segmentation(spark, sf))


@query
def customer_order_value_segments(spark, sf):
    return customers.order_value_segments(shop.orders(spark, sf), shop.customers(spark, sf), P)


@query
def customer_segmentation_all_orders(spark, sf):
    return customers.segmentation_of_all_orders(shop.orders(spark, sf), shop.customers(spark, sf), P)


@query
def rfm(spark, sf):
    return customers.rfm(shop.orders(spark, sf), P)


# --- revenue ---------------------------------------------------------------------------------


@query
def revenue_monthly(spark, sf):
    return revenue.revenue_monthly(shop.orders(spark, sf), P)


@query
def revenue_monthly_growth(spark, sf):
    return revenue.revenue_monthly_growth(revenue_monthly(spark, sf))


@query
def revenue_daily(spark, sf):
    return revenue.revenue_daily(shop.orders(spark, sf), P)


@query
def monthly_trend(spark, sf):
    return revenue.monthly_trend(shop.orders(spark, sf), P)


def _revenue_state(spark: SparkSession, sf: str) -> RevenueState:
    """Two runs of what arrived, the second with orders of earlier days that came late and repeated once,
    and a third put together with the first."""
    orders = shop.orders(spark, sf)
    late = F.col("order_id") % 7 == 0
    last = F.col("order_date") >= _utc("2001-07-01")
    state = RevenueState(spark, scratch(spark, "revenue-state"))
    state.add(orders.filter(~late & ~last), P, "2001-07-01")
    state.add(orders.filter(late & ~last), P, "2001-07-02")
    for _ in range(2):
        state.add(orders.filter(last), P, "2001-08-01")
    state.compact(["2001-07-01", "2001-07-02"], "to-2001-07-02")
    return state


@query
def revenue_monthly_from_state(spark, sf):
    return _revenue_state(spark, sf).revenue_monthly(P)


@query
def revenue_daily_from_state(spark, sf):
    return _revenue_state(spark, sf).revenue_daily(P)


@query
def monthly_trend_from_state(spark, sf):
    return _revenue_state(spark, sf).monthly_trend(P)


# --- products --------------------------------------------------------------------------------


@query
def base_product_metrics(spark, sf):
    return products.base_product_metrics(
        shop.orders(spark, sf), shop.order_items(spark, sf),
        shop.products(spark, sf), shop.categories(spark, sf), P,
    )


@query
def top_products_summary(spark, sf):
    return products.top_products_summary(base_product_metrics(spark, sf), P)


@query
def product_pricing_analytics(spark, sf):
    return products.product_pricing_analytics(base_product_metrics(spark, sf))


@query
def product_lifecycle_metrics(spark, sf):
    return products.product_lifecycle_metrics(base_product_metrics(spark, sf))


@query
def category_performance(spark, sf):
    return products.category_performance(base_product_metrics(spark, sf))


@query
def top_products_by_name(spark, sf):
    return products.top_products_by_name(
        shop.orders(spark, sf), shop.order_items(spark, sf),
        shop.products(spark, sf), shop.categories(spark, sf), P,
    )


@query
def product_popularity(spark, sf):
    return products.product_popularity(shop.order_items(spark, sf))


@query
def interaction_score(spark, sf):
    return products.interaction_score(shop.orders(spark, sf), shop.order_items(spark, sf))


# --- features and recommendations --------------------------------------------------------------


def _interactions(df: DataFrame) -> DataFrame:
    return df.withColumn("weight", F.col("weight").cast("double"))


@query
def purchase_interactions(spark, sf):
    return _interactions(
        interactions.purchases(shop.orders(spark, sf), shop.order_items(spark, sf), P.as_of)
    )


@query
def wishlist_interactions(spark, sf):
    return _interactions(interactions.wishes(shop.customers(spark, sf), shop.wishlists(spark, sf)))


@query
def cart_interactions(spark, sf):
    return _interactions(interactions.cart_additions(
        shop.customers(spark, sf), shop.carts(spark, sf), FEATURE_P.as_of
    ))


@query
def user_item_interactions(spark, sf):
    return features.user_item_interactions(
        shop.orders(spark, sf), shop.order_items(spark, sf), shop.customers(spark, sf),
        shop.carts(spark, sf), shop.wishlists(spark, sf), FEATURE_P,
    )


@query
def user_features(spark, sf):
    return features.user_features(
        shop.customers(spark, sf).select("customer_id"),
        user_item_interactions(spark, sf), shop.orders(spark, sf),
    )


@query
def product_features(spark, sf):
    return features.product_features(
        shop.products(spark, sf), user_item_interactions(spark, sf),
        shop.order_items(spark, sf), FEATURE_P,
    )


@query
def feature_entries(spark, sf):
    return features.feature_entries(interaction_score(spark, sf))


@query
def als_recommendations(spark, sf):
    """For the customers of the last 90 days, from a model that was saved and loaded."""
    path = scratch(spark, "als-model")
    recommend.save(recommend.train(interaction_score(spark, sf), P), path)
    served = recommend.active_customers(shop.orders(spark, sf), P)
    return recommend.recommend(recommend.load(path), served, P)


@query
def als_recommendation_ranks(spark, sf):
    """Who is served which ranks, and whether the products of each list exist and differ."""
    ranked = als_recommendations(spark, sf)
    known = shop.products(spark, sf).select("product_id", F.lit(1).alias("known"))
    return ranked.join(known, "product_id", "left").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("ranks"), F.max("rank").alias("last_rank"),
        F.count_distinct("product_id").alias("products"), F.count("known").alias("known_products"),
    )


# --- ingest ------------------------------------------------------------------------------------


@query
def table_validation(spark, sf):
    """The required columns of the product job, checked on raw tables that lack one of them."""
    tables = {n: shop.raw(spark, sf, n) for n in ("customer", "orders", "lineitem", "part")}
    required = {
        "customer": ["c_custkey", "c_email"], "orders": ["o_orderkey", "o_orderstatus"],
        "lineitem": ["l_orderkey"], "part": ["p_partkey", "p_name"],
    }
    return checks.validate_tables(tables, required)


@query
def column_nulls(spark, sf):
    """Null counts of orders left-joined to nothing: shipment is unknown, status partly so."""
    orders = shop.orders(spark, sf).withColumns({
        "shipment_id": F.lit(None).cast("int"),
        "status": F.when(F.col("status") != "P", F.col("status")),
    })
    return cleaning.null_profile(orders)


DIRTY_ORDERS = schema_of(
    order_id=BIGINT, order_date=TIMESTAMP, total_price=PRICE, status=STRING,
    customer_id=INT, phone_number=STRING, shipment_id=INT,
)


@query
def cleaned_orders(spark, sf):
    """Orders turned to loose text with zones, null texts and bad dates, and cleaned again."""
    status = F.col("o_orderstatus")
    plain = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    dirty = shop.raw(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(status == "P", "not a date")
        .when(status == "O", F.concat(plain, F.lit("+07:00")))
        .otherwise(plain).alias("order_date"),
        F.when(F.col("o_orderpriority") == "5-LOW", "nan")
        .otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("total_price"),
        F.when(status == "P", "None").otherwise(status).alias("status"),
        F.concat(F.col("o_custkey").cast("string"), F.lit(".0")).try_cast("double").alias("customer_id"),
        F.concat(F.lit("00"), F.col("o_custkey").cast("string")).alias("phone_number"),
    )
    return cleaning.clean_table(dirty, DIRTY_ORDERS, null_text="", stand_ins=cleaning.NULL_TEXTS)


@query
def lake_snapshot(spark, sf):
    """All raw tables taken into the lake, and one that cannot be read."""
    readers = {name: partial(shop.raw, spark, sf, name) for name in shop.RAW}
    readers["no_such_table"] = lambda: spark.read.parquet(f"{sf}/no_such_table.parquet")
    schemas = shop.RAW | {"no_such_table": schema_of(id=INT)}
    results = ingest.snapshot_tables(readers, schemas, scratch(spark, "lake"))
    return ingest.results_frame(spark, results)


@query
def data_quality(spark, sf):
    orders = shop.orders(spark, sf)
    items = shop.order_items(spark, sf)
    return checks.quality_report(
        checks.key_checks(
            "orders", orders, {"key": ["order_id"]}, {"customer_id": shop.customers(spark, sf)},
            {"null:status": F.col("status").isNull(), "range:total_price": ~F.col("total_price").between(0, 400_000)},
        ),
        checks.key_checks(
            "order_items", items, {"key": ["order_id", "order_item_id"]},
            {"order_id": orders, "product_id": shop.products(spark, sf)}, {"null:price": F.col("price").isNull()},
        ),
    )


@query
def incremental_orders(spark, sf):
    """The copy of last year, loaded further: half of the orders of its last day had not arrived."""
    orders = shop.orders(spark, sf)
    day = F.col("order_date").cast("date").cast("timestamp")
    last = orders.filter(F.col("order_date") < _utc("2001-01-01")).agg(F.max(day)).first()[0]
    early = (F.col("order_date") < F.lit(last)) | ((day == F.lit(last)) & (F.col("order_id") % 2 == 0))
    copy = orders.filter(early).withColumn("order_date", day)
    mark = incremental.high_water_mark(copy, "order_date")
    since = incremental.changed_since(orders.withColumn("order_date", day), "order_date", mark)
    return incremental.merged(copy, since, ["order_id"], "order_date")


def _misfit_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Raw orders as text, some with ids, amounts and dates that no declared type holds."""
    low = F.col("o_orderpriority") == "5-LOW"
    return shop.raw(spark, sf, "orders").select(
        F.when(low, F.concat(F.lit("9"), "o_orderkey", F.lit("0" * 19))).otherwise(F.col("o_orderkey").cast("string")).alias("order_id"),
        F.when(F.col("o_orderstatus") == "P", "soon").otherwise(F.col("o_orderdate").cast("string")).alias("order_date"),
        F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("9" * 17), F.col("o_totalprice").cast("decimal(18,2)").cast("string")))
        .otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("total_price"),
        F.when(low, "None").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(low, "nan").when(F.col("o_orderstatus") == "F", F.concat("o_custkey", F.lit(".5")))
        .otherwise(F.concat(F.lit("30"), F.lpad(F.col("o_custkey").cast("string"), 8, "0"))).alias("customer_id"),
    )


@query
def ingest_misfits(spark, sf):
    """Values per column that the declared types cannot hold."""
    return cleaning.misfit_counts(_misfit_orders(spark, sf), TABLES["orders"])


# --- change events -----------------------------------------------------------------------------


@query
def cdc_order_events(spark, sf):
    return changes.parse_orders(shop.order_log(spark, sf)).select(
        "order_id", "customer_id", "total_price", "status", "timestamp",
        F.col("__op").alias("op"), F.col("__lsn").alias("lsn"),
    )


@query
def cdc_item_events(spark, sf):
    items = changes.parse_order_items(shop.item_messages(shop.raw(spark, sf, "events")))
    return items.select("order_item_id", "product_id", "quantity", "price", "event_time")


@query
def cdc_item_sales(spark, sf):
    """Units sold per product, from a log in which items are also changed and deleted."""
    log = shop.item_changes(shop.raw(spark, sf, "events"))
    return _unit_sales(apps.items_of(log))


def _unit_sales(items: DataFrame) -> DataFrame:
    return items.groupBy("product_id").agg(F.sum("quantity").alias("units"), F.count(F.lit(1)).alias("items"))


@query
def cdc_change_records(spark, sf):
    """The flattened log: how many records of each kind, and how far it reaches."""
    records = changes.captured(changes.change_records(shop.order_log(spark, sf), "orders"))
    return records.groupBy(
        F.col("__table").alias("table_name"), F.col("__op").alias("op"), F.col("__deleted").alias("deleted")
    ).agg(F.count(F.lit(1)).alias("records"), F.max("__lsn").alias("last_lsn"))


@query
def cdc_current_orders(spark, sf):
    records = changes.change_records(shop.order_log(spark, sf), "orders")
    dated = records.filter(F.col("order_date").isNotNull() | F.col("__deleted"))
    state = changes.current_state(dated, ["order_id"])
    return state.select(
        "order_id", "customer_id", F.col("total_price").cast("decimal(18,2)").alias("total_price"),
        "status", F.try_to_timestamp("order_date").alias("order_date"),
    )


@query
def cdc_merged_orders(spark, sf):
    """Last year's copy of the orders, kept in buckets and brought up to date with the changes since."""
    columns = ["order_id", "customer_id", "status"]
    copy = shop.orders(spark, sf).filter(F.col("order_date") < _utc("2001-01-01"))
    pending = copy.withColumn("status", F.lit("pending")).select(columns)
    records = changes.change_records(shop.order_log(spark, sf), "orders")
    since = records.filter(F.col("__deleted") | (F.col("order_date") >= "2000-06-01"))
    table = BucketTable.create(pending, scratch(spark, "orders-table"), ["order_id"], buckets=8)
    table.merge(since)
    return table.read()


@query
def cdc_new_orders(spark, sf):
    """Monthly order counts, by orders and by change events."""
    events = changes.parse_orders(shop.order_log(spark, sf))
    return events.groupBy(F.date_trunc("month", "event_time").alias("order_month")).agg(
        F.count(F.lit(1)).alias("change_events"),
        F.count_if(F.col("__op").isin(*changes.CREATED)).alias("new_orders"),
    )


@query
def topic_peek(spark, sf):
    events = shop.raw(spark, sf, "events")
    sound = F.to_json(F.struct(F.struct("event_id", "value").alias("payload")))
    messages = events.select(
        F.col("user_id").cast("string").alias("key"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("broken "), F.col("event_id")))
        .otherwise(sound).cast("binary").alias("value"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )
    return topics.peek(messages)


# --- windows and alerts on bounded input ---------------------------------------------------------


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return shop.order_events(shop.raw(spark, sf, "events"))


def _items(spark: SparkSession, sf: str) -> DataFrame:
    return shop.product_events(shop.raw(spark, sf, "events"), "purchase")


# Amounts a thousand times as large, so that alerts have thousands to set apart.
DEAR = dataclasses.replace(P, alert_amount=1000 * P.alert_amount)


def _in_thousands(orders: DataFrame) -> DataFrame:
    return orders.withColumn("total_price", (F.col("total_price") * 1000).cast("decimal(18,2)"))


def _same_amounts(orders: DataFrame) -> DataFrame:
    """In thousands, and to the next ten thousand, so that some customers repeat an amount."""
    return orders.withColumn("total_price", (F.ceil(F.col("total_price") / 10) * 10_000 + F.lit("0.5").cast("decimal(2,1)")).cast("decimal(18,2)"))


@query
def window_revenue_10s(spark, sf):
    return order_streams.window_revenue(_orders(spark, sf), "10 seconds")


@query
def window_revenue_1min(spark, sf):
    return order_streams.window_revenue(_orders(spark, sf), "1 minute")


@query
def window_revenue_5min(spark, sf):
    return order_streams.window_revenue(_orders(spark, sf), "5 minutes")


@query
def window_revenue_1h(spark, sf):
    return order_streams.window_revenue(_orders(spark, sf), "1 hour")


@query
def revenue_records(spark, sf):
    return order_streams.revenue_records(
        order_streams.window_revenue(_orders(spark, sf), P.revenue_window)
    )


@query
def revenue_trend(spark, sf):
    return order_streams.revenue_trend(order_streams.window_revenue(_orders(spark, sf), "1 hour"))


@query
def top_products_by_quantity(spark, sf):
    return product_streams.top_products(_items(spark, sf), P)


@query
def top_products_by_revenue(spark, sf):
    return product_streams.top_products(_items(spark, sf), P, by="revenue")


@query
def top_product_records(spark, sf):
    return product_streams.top_product_records(product_streams.top_products(_items(spark, sf), P))


@query
def enriched_top_products(spark, sf):
    return product_streams.enrich_top_products(top_product_records(spark, sf), shop.products(spark, sf))


@query
def category_windows(spark, sf):
    return product_streams.category_windows(_items(spark, sf), shop.products(spark, sf), "1 day")


@query
def product_trend(spark, sf):
    return product_streams.product_trend(
        product_streams.product_windows(_items(spark, sf), P.product_window)
    )


@query
def high_value_alerts(spark, sf):
    return order_streams.with_alert_text(order_streams.high_value_alerts(_in_thousands(_orders(spark, sf)), DEAR))


@query
def frequent_order_alerts(spark, sf):
    return order_streams.with_alert_text(order_streams.frequent_order_alerts(_orders(spark, sf), P))


@query
def similar_order_alerts(spark, sf):
    return order_streams.similar_order_alerts(_orders(spark, sf), P)


@query
def all_alerts(spark, sf):
    return order_streams.all_alerts(_same_amounts(_orders(spark, sf)), DEAR)


# --- the same on streams ---------------------------------------------------------------------------


def _order_stream(spark: SparkSession, sf: str) -> DataFrame:
    messages = shop.order_message_stream(spark, sf)
    return order_streams.timed(changes.parse_orders(messages), P)


def _item_stream(spark: SparkSession, sf: str) -> DataFrame:
    messages = shop.item_message_stream(spark, sf)
    return order_streams.timed(changes.parse_order_items(messages), P)


def _landed(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Run the stream over everything there is and read what it wrote."""
    path = scratch(spark, name)
    sinks.to_files(stream, f"{path}/data", f"{path}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/data")


@query
def stream_window_revenue(spark, sf):
    windows = order_streams.window_revenue(_order_stream(spark, sf), P.revenue_window)
    return _landed(spark, windows, "window-revenue")


@query
def stream_top_products(spark, sf):
    path = scratch(spark, "top-products")
    product_streams.stream_top_products(
        _item_stream(spark, sf), P, f"{path}/data", f"{path}/checkpoint"
    ).awaitTermination()
    return spark.read.parquet(f"{path}/data").drop("batch_id")


@query
def stream_item_sales(spark, sf):
    """The same count over a stream of the log."""
    items = apps.items_of(shop.item_changes(shop.events_stream(spark, sf)))
    return _unit_sales(_landed(spark, items.select("order_item_id", "product_id", "quantity"), "items"))


@query
def stream_enriched_top_products(spark, sf):
    """Ranking records published as JSON by one stream, read and enriched by another."""
    records = scratch(spark, "top-product-records")
    top_product_records(spark, sf).select(F.to_json(F.struct("*")).alias("value")).write.text(records)
    messages = pin_utc(spark).readStream.text(records)
    enriched = product_streams.enrich_top_products(
        product_streams.parse_records(messages), shop.products(spark, sf)
    )
    return _landed(spark, enriched, "enriched")


@query
def stream_alerts(spark, sf):
    orders = changes.parse_orders(shop.order_message_stream(spark, sf))
    return _landed(spark, order_streams.all_alerts(_same_amounts(orders), DEAR), "alerts")


@query
def stream_revenue_trend(spark, sf):
    """Trend over the table that a stream of hourly windows has written."""
    windows = order_streams.window_revenue(_order_stream(spark, sf), "1 hour")
    return order_streams.revenue_trend(_landed(spark, windows, "hourly-revenue"))


@query
def stream_product_trend(spark, sf):
    """Rising products in the table that a stream of product windows has written."""
    windows = product_streams.product_windows(_item_stream(spark, sf), P.product_window)
    return product_streams.product_trend(_landed(spark, windows, "product-windows"))


@query
def stream_landed_orders(spark, sf):
    return _landed(spark, order_streams.landed(_order_stream(spark, sf)), "orders")


@query
def stream_category_windows(spark, sf):
    windows = product_streams.category_windows(
        _item_stream(spark, sf), shop.products(spark, sf), "1 day"
    )
    return _landed(spark, windows, "category-windows")


@query
def stream_deduplicated_orders(spark, sf):
    """Every order event arrives twice and is counted once."""
    messages = shop.order_message_stream(spark, sf)
    twice = messages.select(F.explode(F.array("value", "value")).alias("value"))
    first = changes.first_event_per_key(changes.parse_orders(twice), "order_id", "event_time", "5 seconds")
    return _landed(spark, order_streams.window_revenue(first, P.revenue_window), "deduplicated")


# --- sinks, catalog and jobs ---------------------------------------------------------------------


@query
def orders_by_month(spark, sf):
    """Orders written by month and read back by folder."""
    path = scratch(spark, "orders-by-month")
    mart_sink.write_orders_by_month(shop.orders(spark, sf), path)
    return spark.read.parquet(path).groupBy("order_month").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total_price").cast("decimal(38,2)").alias("revenue")
    )


@query
def catalog_row_counts(spark, sf):
    """External tables registered over the raw files and counted through the catalog."""
    path = scratch(spark, "catalog")
    database = f"shop_{path[-12:]}"
    catalog.create_database(spark, database, path)
    for name in ("customer", "orders", "lineitem", "part"):
        catalog.register_table(spark, database, name, shop.RAW[name], f"{sf}/{name}.parquet")
    listed = {
        f.table_name: f"{database}.{f.table_name}" for f in catalog.list_tables(spark, database).collect()
    }
    return catalog.row_counts(spark, listed)


@query
def job_counts(spark, sf):
    """Run all four jobs on all tables and report the rows they read and wrote."""
    target = scratch(spark, "marts")
    tables = shop.shop(spark, sf)
    reports = [jobs.run_job(job, tables, target, P) for job in jobs.JOBS.values()]
    result = reports[0].counts(spark)
    for report in reports[1:]:
        result = result.unionByName(report.counts(spark))
    return result


@query
def segmentation_rerun(spark, sf):
    """Rows per segment after the segmentation has run twice for one day."""
    target = scratch(spark, "marts")
    for _ in range(2):
        report = jobs.run_job(jobs.SEGMENTATION, shop.shop(spark, sf), target, P)
        if report.status != "SUCCESS":
            raise RuntimeError(report.error_message)
    written = spark.read.parquet(f"{target}/segmentation_customer")
    return written.groupBy("customer_segment").agg(F.count(F.lit(1)).alias("customers"))


@query
def job_category_mart(spark, sf):
    """Category performance as the product job wrote it."""
    target = scratch(spark, "marts")
    report = jobs.run_job(jobs.PRODUCTS, shop.shop(spark, sf), target, P)
    if report.status != "SUCCESS":
        raise RuntimeError(report.error_message)
    return spark.read.parquet(f"{target}/product_analytics/category_performance")
