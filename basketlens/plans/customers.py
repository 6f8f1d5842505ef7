"""Customer marts: value segments and recency-frequency-monetary scores.

Orders are always aggregated per customer before the join: each task pre-aggregates, so a
customer with a third of all orders reaches the shuffle as one row per task, and the join
reuses the aggregation's partitioning. ``customer_id`` is the primary key of customers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.exact import ratio, total
from basketlens.functions.labels import value_segment
from basketlens.params import Params

SQL_LABELS = ("high value", "medium value", "low value")


def _spend(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.count("total_price").alias("_priced"),
        total("total_price").alias("total_spent"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )


def customer_segmentation(orders: DataFrame, customers: DataFrame, p: Params) -> DataFrame:
    """Spend, order dates and value segment of every customer with orders."""
    named = customers.select("customer_id", "last_name", "email")
    lifetime = F.datediff("last_order_date", "first_order_date")
    return (
        _spend(orders)
        .join(named, "customer_id", "inner")
        .select(
            "customer_id", "last_name", "email", "total_orders", "total_spent",
            ratio("total_spent", "_priced").alias("avg_order_spent"),
            "first_order_date", "last_order_date",
            value_segment(F.col("total_spent"), p.high_value, p.medium_value).alias("customer_segment"),
            F.lit(p.as_of).alias("process_date"),
            lifetime.alias("customer_lifetime_days"),
            ratio(lifetime, "total_orders").alias("avg_days_between_orders"),
        )
    )


def segment_distribution(segmentation: DataFrame) -> DataFrame:
    return segmentation.groupBy("customer_segment").agg(F.count(F.lit(1)).alias("customers"))


def order_value_segments(orders: DataFrame, customers: DataFrame, p: Params) -> DataFrame:
    """Report over all customers, those without orders included as lowest segment."""
    named = customers.select("customer_id", "first_name", "last_name")
    spent = F.col("total_spent")
    segment = value_segment(spent, p.report_high_value, p.report_medium_value, inclusive=False)
    return (
        named.join(_spend(orders), "customer_id", "left")
        .select(
            "customer_id", "first_name", "last_name",
            F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
            "total_spent",
            ratio(spent, "_priced").alias("avg_order_value"),
            segment.alias("customer_segment"),
        )
    )


def segmentation_of_all_orders(orders: DataFrame, customers: DataFrame, p: Params) -> DataFrame:
    """Twin of the segmentation that keeps orders of unknown customers, under a null customer."""
    spend = _spend(orders).withColumnRenamed("customer_id", "ordered_by")
    named = customers.select("customer_id", "last_name", "email")
    merged = (
        spend.join(named, F.col("ordered_by") == F.col("customer_id"), "left")
        .groupBy("customer_id", "last_name", "email")
        .agg(
            F.sum("total_orders").alias("total_orders"),
            F.sum("_priced").alias("_priced"),
            total("total_spent").alias("total_spent"),
        )
    )
    segment = value_segment(
        F.col("total_spent"), p.high_value, p.medium_value, inclusive=False, labels=SQL_LABELS
    )
    return merged.select(
        "customer_id", "last_name", "email", "total_orders", "total_spent",
        ratio("total_spent", "_priced").alias("avg_spent"),
        segment.alias("customer_segment"),
    )


def rfm(orders: DataFrame, p: Params) -> DataFrame:
    """Days since the last order, number of orders and spend per customer."""
    return orders.groupBy("customer_id").agg(
        F.datediff(F.lit(p.as_of), F.max("order_date")).alias("recency"),
        F.count(F.lit(1)).alias("frequency"),
        total("total_price").alias("monetary"),
    )
