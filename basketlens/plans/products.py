"""Product marts over completed orders.

Facts are aggregated down to the product before product and category names are joined, so the
joins with the dimensions move one row per product instead of one per item, and a product that
holds a third of all items is pre-aggregated in every task. Sizes decide the join strategy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.functions.exact import mean, ratio, total
from basketlens.operators.ranking import top_k
from basketlens.params import Params
from basketlens.plans.revenue import completed


def line_value() -> Column:
    return F.col("quantity").cast("decimal(10,0)") * F.col("price")


def sales(orders: DataFrame, items: DataFrame, p: Params) -> DataFrame:
    """Items of completed orders with customer and date."""
    sold = completed(orders, p).select("order_id", "customer_id", "order_date")
    return items.join(sold, "order_id", "inner")


def _named(products: DataFrame, categories: DataFrame) -> DataFrame:
    names = categories.select("category_id", F.col("name").alias("category_name"))
    return products.select("product_id", F.col("name").alias("product_name"), "category_id").join(
        names, "category_id", "inner"
    )


def base_product_metrics(
    orders: DataFrame, items: DataFrame, products: DataFrame, categories: DataFrame, p: Params
) -> DataFrame:
    per_product = sales(orders, items, p).groupBy("product_id").agg(
        F.sum("quantity").alias("total_quantity_sold"),
        total(line_value()).alias("total_revenue"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count("order_item_id").alias("total_orders"),
        mean("price").alias("avg_selling_price"),
        F.min("order_date").alias("first_sale_date"),
        F.max("order_date").alias("last_sale_date"),
    )
    return per_product.join(_named(products, categories), "product_id", "inner").select(
        "product_id", "product_name", "category_name",
        "total_quantity_sold", "total_revenue", "unique_customers", "total_orders",
        "avg_selling_price", "first_sale_date", "last_sale_date",
        F.lit(p.as_of).alias("analysis_date"),
    )


def top_products_summary(base: DataFrame, p: Params) -> DataFrame:
    summary = base.select(
        "product_id", "product_name", "category_name",
        "total_quantity_sold", "total_revenue", "unique_customers", "analysis_date",
    )
    return top_k(summary, "total_revenue", ["product_id"], p.top_k)


def product_pricing_analytics(base: DataFrame) -> DataFrame:
    return base.select(
        "product_id", "product_name", "category_name", "avg_selling_price",
        ratio("total_revenue", "unique_customers").alias("avg_revenue_per_customer"),
        ratio("total_quantity_sold", "unique_customers").alias("avg_quantity_per_customer"),
        "analysis_date",
    )


def product_lifecycle_metrics(base: DataFrame) -> DataFrame:
    """Products sold on more than one day."""
    days = F.datediff("last_sale_date", "first_sale_date")
    return base.filter(days > 0).select(
        "product_id", "product_name", "category_name", "first_sale_date", "last_sale_date",
        days.alias("product_lifecycle_days"),
        ratio("total_revenue", days).alias("revenue_per_day"),
        "analysis_date",
    )


def category_performance(base: DataFrame) -> DataFrame:
    return base.groupBy("category_name", "analysis_date").agg(
        total("total_revenue").alias("category_total_revenue"),
        F.sum("total_quantity_sold").alias("category_total_quantity"),
        F.count_distinct("product_id").alias("active_products_count"),
        mean("total_revenue").alias("avg_product_revenue_in_category"),
    )


def top_products_by_name(
    orders: DataFrame, items: DataFrame, products: DataFrame, categories: DataFrame, p: Params
) -> DataFrame:
    """Best sellers by name: products that share a name and category count as one."""
    per_buyer = sales(orders, items, p).groupBy("product_id", "customer_id").agg(
        F.sum("quantity").alias("quantity"), total(line_value()).alias("revenue")
    )
    by_name = (
        per_buyer.join(_named(products, categories), "product_id", "inner")
        .groupBy("product_name", "category_name")
        .agg(
            F.sum("quantity").alias("total_quantity_sold"),
            total("revenue").alias("total_revenue"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )
    )
    return top_k(by_name, "total_revenue", ["product_name", "category_name"], p.top_k)


def product_popularity(items: DataFrame) -> DataFrame:
    return items.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("purchase_count"), mean("price").alias("avg_price")
    )


def interaction_score(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Units bought per customer and product."""
    return (
        items.select("order_id", "product_id", "quantity")
        .join(orders.select("order_id", "customer_id"), "order_id", "inner")
        .groupBy("customer_id", "product_id")
        .agg(F.sum("quantity").alias("interaction_score"))
    )
