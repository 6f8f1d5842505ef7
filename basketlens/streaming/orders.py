"""Order streams: event time, revenue per window, alerts, landing.

Every function maps a DataFrame to a DataFrame and accepts bounded input as well, on which the
watermark has no effect. Input columns: ``customer_id, total_price, event_time``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.functions import render
from basketlens.functions.exact import ratio
from basketlens.operators.previous import growth_percent, with_previous
from basketlens.params import Params
from basketlens.schemas import BIGINT, STRING, TIMESTAMP, schema_of


def timed(df: DataFrame, p: Params, time: str = "event_time") -> DataFrame:
    """Declare event time; rows later than the watermark may be dropped."""
    return df.withWatermark(time, p.watermark) if df.isStreaming else df


def has_watermark(df: DataFrame, time: str = "event_time") -> bool:
    return "spark.watermarkDelayMs" in df.schema[time].metadata


def window_revenue(orders: DataFrame, window: str, time: str = "event_time") -> DataFrame:
    """Orders, revenue and average order value per tumbling window.

    Windows are aggregated partially in every task before the shuffle; there is no single key
    that would send the stream through one task.
    """
    per_window = orders.groupBy(F.window(time, window).alias("w")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("total_price").alias("revenue"),
    )
    return per_window.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "total_orders",
        F.col("revenue").cast("decimal(38,2)").alias("total_revenue"),
        ratio("revenue", "total_orders").alias("avg_order_value"),
    )


def revenue_records(windows: DataFrame) -> DataFrame:
    """Publishable form of the window revenue."""
    return windows.select(
        F.lit(render.REVENUE_METRIC).alias("metric"),
        render.epoch_seconds(F.col("window_start")).alias("window_start"),
        render.epoch_seconds(F.col("window_end")).alias("window_end"),
        "total_orders",
        "total_revenue",
        render.minutes_between(F.col("window_start"), F.col("window_end")).alias("window_duration_minutes"),
    )


def revenue_trend(windows: DataFrame) -> DataFrame:
    """Every window against the one before it; reads the table the window stream writes."""
    compared = with_previous(
        windows.select("window_start", "total_orders", "total_revenue"),
        order="window_start",
        values={"prev_revenue": "total_revenue", "prev_orders": "total_orders"},
        bucket=F.date_trunc("month", "window_start"),
    )
    return compared.withColumn(
        "revenue_growth_rate", growth_percent(F.col("total_revenue"), F.col("prev_revenue"))
    )


def high_value_alerts(orders: DataFrame, p: Params) -> DataFrame:
    return orders.filter(F.col("total_price") > p.alert_amount).select(
        "customer_id",
        F.lit(render.HIGH_VALUE_REASON).alias("reason"),
        render.amount_text(F.col("total_price")).alias("value"),
    )


def frequent_order_alerts(orders: DataFrame, p: Params, time: str = "event_time") -> DataFrame:
    """Customers with more than ``alert_orders`` orders in one window."""
    counted = orders.groupBy(F.window(time, p.alert_window), "customer_id").agg(
        F.count(F.lit(1)).alias("orders")
    )
    return counted.filter(F.col("orders") > p.alert_orders).select(
        "customer_id",
        F.lit(render.FREQUENT_REASON).alias("reason"),
        F.concat(F.col("orders").cast("string"), F.lit(f" orders in {p.alert_window}")).alias("value"),
    )


def similar_order_alerts(orders: DataFrame, p: Params, time: str = "event_time") -> DataFrame:
    """Customers repeating one amount at least ``similar_orders`` times in one window."""
    counted = orders.groupBy(F.window(time, p.alert_window), "customer_id", "total_price").agg(
        F.count(F.lit(1)).alias("orders")
    )
    return counted.filter(F.col("orders") >= p.similar_orders).select(
        "customer_id",
        F.lit(render.SIMILAR_REASON).alias("reason"),
        F.concat(
            F.col("orders").cast("string"), F.lit(" x "), render.amount_text(F.col("total_price"))
        ).alias("value"),
    )


def window_alerts(orders: DataFrame, p: Params, time: str = "event_time") -> DataFrame:
    """The rules over windows, frequent and similar orders, from one windowed count.

    Every order counts once under its customer and once under its customer and amount. Both are rows
    of one aggregation, combined in every task before its one shuffle, with one state.
    """
    by_amount = F.explode(F.array(F.lit(False), F.lit(True))).alias("by_amount")
    counted = (
        orders.select(time, "customer_id", "total_price", by_amount)
        .groupBy(F.window(time, p.alert_window), "customer_id", "by_amount", F.when(F.col("by_amount"), F.col("total_price")).alias("amount"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    similar = F.col("by_amount")
    raised = F.when(similar, F.col("orders") >= p.similar_orders).otherwise(F.col("orders") > p.alert_orders)
    count = F.col("orders").cast("string")
    return counted.filter(raised).select(
        "customer_id",
        F.when(similar, render.SIMILAR_REASON).otherwise(render.FREQUENT_REASON).alias("reason"),
        F.when(similar, F.concat(count, F.lit(" x "), render.amount_text(F.col("amount"))))
        .otherwise(F.concat(count, F.lit(f" orders in {p.alert_window}"))).alias("value"),
    )


def all_alerts(orders: DataFrame, p: Params) -> DataFrame:
    """High-value alerts at once; frequent and similar orders when their window closes.

    A stream that carries its watermark is read by both branches, which suits landed orders, where
    reading is cheap. One without a watermark is read and parsed once: both branches take its rows
    from one exchange, and the windows get their watermark behind it. (In front of it, the branch that
    reuses the exchange would never see the watermark move.)
    """
    if not orders.isStreaming or has_watermark(orders):
        return high_value_alerts(orders, p).unionByName(window_alerts(orders, p))
    columns = ("customer_id", "total_price", "event_time")
    dealt = orders.select(*columns).repartition(F.xxhash64(*columns))
    # A generator: a plain filter would move below the exchange of its branch, which then differs from the other's.
    one = F.struct("customer_id", "total_price")
    dear = dealt.select(F.inline(F.filter(F.array(one), lambda o: o.total_price > p.alert_amount)))
    return high_value_alerts(dear, p).unionByName(window_alerts(timed(dealt, p), p))


def with_alert_text(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn(
        "message", render.alert_text(F.col("customer_id"), F.col("reason"), F.col("value"))
    )


LANDED = schema_of(
    order_id=BIGINT, customer_id=BIGINT, total_price=T.DecimalType(18, 2), status=STRING,
    order_date=TIMESTAMP, op=STRING,
)


def landed(orders: DataFrame) -> DataFrame:
    """Parsed orders as they are appended to the lake, one row per change."""
    return orders.select(
        "order_id", "customer_id", "total_price", "status",
        F.col("event_time").alias("order_date"), F.col("__op").alias("op"),
    )
