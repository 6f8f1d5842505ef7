"""Weighted customer-product interactions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.functions.labels import WEIGHT, WISHLIST_WEIGHT, recency_weight

INTERACTION = ("customer_id", "product_id", "weight", "timestamp")


def with_recency(df: DataFrame, as_of: dt.date) -> DataFrame:
    """Weight = quantity x recency, kept as an exact decimal."""
    recency = recency_weight(F.datediff(F.lit(as_of), F.col("timestamp")))
    return df.withColumn("weight", F.col("quantity").cast("decimal(12,0)") * recency)


def purchases(orders: DataFrame, items: DataFrame, as_of: dt.date) -> DataFrame:
    """Every ordered product, whatever the order status; identical purchases collapse."""
    bought = (
        orders.select("order_id", "customer_id", F.col("order_date").alias("timestamp"))
        .join(items.select("order_id", "product_id", "quantity"), "order_id")
        .select("customer_id", "product_id", "quantity", "timestamp")
        .distinct()
    )
    return with_recency(bought, as_of).select(*INTERACTION)


def cart_additions(customers: DataFrame, carts: DataFrame, as_of: dt.date) -> DataFrame:
    added = _known(customers, carts.select(
        "customer_id", "product_id", "quantity", F.col("added_at").alias("timestamp")
    ))
    return with_recency(added, as_of).select(*INTERACTION)


def wishes(customers: DataFrame, wishlists: DataFrame) -> DataFrame:
    weight: Column = F.lit(WISHLIST_WEIGHT).cast(WEIGHT)
    wished = _known(customers, wishlists.select(
        "customer_id", "product_id", F.col("added_at").alias("timestamp")
    ))
    return wished.withColumn("weight", weight).select(*INTERACTION)


def _known(customers: DataFrame, rows: DataFrame) -> DataFrame:
    """Distinct rows of known customers. The semi join cannot multiply rows, and leaves both
    sides plain shuffles, which lets AQE split the partition of a very active customer."""
    return rows.distinct().join(customers.select("customer_id"), "customer_id", "left_semi")
