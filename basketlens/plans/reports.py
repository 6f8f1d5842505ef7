"""Reading order of the marts.

Marts are written unordered, because a sort before a partitioned write is wasted. A report sorts
what it shows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The column each mart is presented by, and whether the largest comes first.
REPORT_ORDER: dict[str, tuple[str, bool]] = {
    "customer_segmentation": ("total_spent", True),
    "customer_order_value_segments": ("total_spent", True),
    "customer_segmentation_all_orders": ("total_spent", True),
    "revenue_monthly": ("order_month", False),
    "revenue_monthly_growth": ("order_month", False),
    "revenue_daily": ("order_date_only", False),
    "monthly_trend": ("order_month", False),
    "top_products_summary": ("total_revenue", True),
    "top_products_by_name": ("total_revenue", True),
    "product_pricing_analytics": ("avg_revenue_per_customer", True),
    "category_performance": ("category_total_revenue", True),
    "user_item_interactions": ("avg_weight", True),
}


def in_report_order(name: str, mart: DataFrame) -> DataFrame:
    if name not in REPORT_ORDER:
        return mart
    column, largest_first = REPORT_ORDER[name]
    return mart.orderBy(F.desc(column) if largest_first else F.asc(column))


def report(name: str, mart: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows in reading order; every task keeps ``n`` rows only."""
    return in_report_order(name, mart).limit(n)
