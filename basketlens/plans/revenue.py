"""Revenue marts over completed orders.

Status and date conditions compare bare columns with constants, so both reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.functions.exact import ratio, total
from basketlens.functions.labels import day_name, is_weekend
from basketlens.operators.previous import growth_percent, with_previous
from basketlens.params import Params
from basketlens.schemas import MONTH


def completed(orders: DataFrame, p: Params) -> DataFrame:
    return orders.filter(F.col("status").isin(*p.completed))


def since(orders: DataFrame, start: Column) -> DataFrame:
    """Orders from ``start`` on. Where orders are partitioned by month, earlier months are not
    even listed."""
    recent = orders.filter(F.col("order_date") >= start.cast("timestamp"))
    if MONTH in orders.columns:
        recent = recent.filter(F.col(MONTH) >= F.date_format(start, "yyyy-MM"))
    return recent


def _by_month(orders: DataFrame, p: Params) -> DataFrame:
    recent = since(completed(orders, p), F.add_months(F.lit(p.as_of), -p.months_back))
    month = F.date_trunc("month", "order_date")
    return recent.groupBy(month.alias("order_month")).agg(
        F.count_distinct("customer_id").alias("unique_customer"),
        F.count_distinct("order_id").alias("total_orders"),
        total("total_price").alias("total_revenue"),
    )


def revenue_monthly(orders: DataFrame, p: Params) -> DataFrame:
    return monthly_mart(_by_month(orders, p), p)


def monthly_mart(by_month: DataFrame, p: Params) -> DataFrame:
    return by_month.select(
        "*",
        ratio("total_revenue", "unique_customer").alias("avg_revenue_per_customer"),
        ratio("total_orders", "unique_customer").alias("orders_per_customer"),
        F.lit(p.as_of).alias("analysis_date"),
    )


def revenue_monthly_growth(monthly: DataFrame) -> DataFrame:
    """Growth against the month before that had sales."""
    compared = with_previous(
        monthly.select("order_month", "total_revenue", "unique_customer"),
        order="order_month",
        values={"prev_month_revenue": "total_revenue", "prev_month_customers": "unique_customer"},
        bucket=F.year("order_month"),
    )
    return compared.select(
        "*",
        growth_percent(F.col("total_revenue"), F.col("prev_month_revenue")).alias("revenue_growth_rate"),
        growth_percent(F.col("unique_customer"), F.col("prev_month_customers")).alias("customer_growth_rate"),
    )


def revenue_daily(orders: DataFrame, p: Params) -> DataFrame:
    recent = since(completed(orders, p), F.date_sub(F.lit(p.as_of), p.days_back))
    daily = recent.groupBy(F.col("order_date").cast("date").alias("order_date_only")).agg(
        total("total_price").alias("daily_revenue"),
        F.count("order_id").alias("daily_orders"),
        F.count_distinct("customer_id").alias("daily_unique_customers"),
        F.count("total_price").alias("_priced"),
    )
    return daily_mart(daily, p)


def daily_mart(daily: DataFrame, p: Params) -> DataFrame:
    day = F.col("order_date_only")
    return daily.select(
        day,
        F.dayofweek(day).alias("day_of_week"),
        day_name(day).alias("day_name"),
        is_weekend(day).alias("is_weekend"),
        "daily_revenue", "daily_orders", "daily_unique_customers",
        ratio("daily_revenue", "_priced").alias("daily_avg_order_value"),
        ratio("daily_revenue", "daily_unique_customers").alias("revenue_per_customer"),
        F.lit(p.as_of).alias("analysis_date"),
    )


def monthly_trend(orders: DataFrame, p: Params) -> DataFrame:
    """Monthly report with the average order value."""
    return trend_mart(_by_month(orders, p))


def trend_mart(by_month: DataFrame) -> DataFrame:
    return by_month.select(
        "order_month",
        "total_orders",
        F.col("total_revenue").alias("monthly_revenue"),
        F.col("unique_customer").alias("unique_customers"),
        ratio("total_revenue", "total_orders").alias("avg_order_value"),
    )
