"""Text and record rendering for alerts and stream output."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wording of alerts and names of the stream metrics.
HIGH_VALUE_REASON = "High value order"
FREQUENT_REASON = "Frequent orders"
SIMILAR_REASON = "Similar orders"
CURRENCY = "VND"
DELIVERY_PREFIX = "🚨 **FRAUD DETECTED**\n"
REVENUE_METRIC = "revenue_window"
TOP_PRODUCT_METRIC = "top_product_window"


def amount_text(amount: Column) -> Column:
    """``12345678.5`` -> ``12,345,678.5 VND``: thousands separated, at least one decimal."""
    grouped = F.format_number(amount, 2)
    return F.concat(F.regexp_replace(grouped, "0$", ""), F.lit(f" {CURRENCY}"))


def alert_text(customer: Column, reason: Column, value: Column) -> Column:
    extra = F.when(value.isNotNull() & (value != ""), F.concat(F.lit(" (Value: "), value, F.lit(")")))
    return F.concat(
        F.lit("🚨 Fraud Alert: Customer "), customer.cast("string"),
        F.lit(" | "), reason, F.coalesce(extra, F.lit("")),
    )


def epoch_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts)


def minutes_between(start: Column, end: Column) -> Column:
    return (F.unix_seconds(end) - F.unix_seconds(start)) / F.lit(60.0)


def json_record(*cols: Column | str) -> Column:
    return F.to_json(F.struct(*cols))
