"""Item streams: best sellers per window, enrichment, category sales, trending.

Input columns: ``product_id, quantity, price`` and a time column, the broker's record time
because items carry no time of their own.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketlens.functions import render
from basketlens.functions.exact import total
from basketlens.operators.previous import growth_percent, with_previous
from basketlens.operators.ranking import top_k_per_group
from basketlens.params import Params
from basketlens.plans.products import line_value
from basketlens.schemas import TOP_PRODUCT_RECORD
from basketlens.sinks.streams import batch_files, per_batch

Transform = Callable[[DataFrame], DataFrame]
BatchHandler = Callable[[DataFrame, int], None]

METRICS = {"quantity": "total_quantity", "revenue": "total_revenue"}


def _sold(items: DataFrame, window: str, time: str) -> DataFrame:
    """Sums per window ``w`` and product; only positive quantities."""
    sold = items.filter(F.col("product_id").isNotNull() & (F.col("quantity") > 0))
    return sold.groupBy(F.window(time, window).alias("w"), "product_id").agg(
        F.sum("quantity").alias("total_quantity"),
        total(line_value()).alias("total_revenue"),
        F.count(F.lit(1)).alias("item_count"),
    )


def _bounds(windows: DataFrame) -> DataFrame:
    rest = [c for c in windows.columns if c != "w"]
    return windows.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *rest
    )


def product_windows(items: DataFrame, window: str, time: str = "event_time") -> DataFrame:
    """Quantity, revenue and number of items per product and window."""
    return _bounds(_sold(items, window, time))


def rank_products(windows: DataFrame, p: Params, by: str = "quantity") -> DataFrame:
    """Ranks 1..k per window, by units or by revenue; ties go to the smaller product id."""
    return top_k_per_group(
        windows, ["window_start", "window_end"], METRICS[by], ["product_id"], p.stream_top_k
    )


def top_products(items: DataFrame, p: Params, by: str = "quantity", time: str = "event_time") -> DataFrame:
    """Best sellers per window of bounded input."""
    return rank_products(product_windows(items, p.product_window, time), p, by)


def top_product_records(ranked: DataFrame) -> DataFrame:
    """Publishable form of the ranking, one record per rank."""
    return ranked.select(
        F.lit(render.TOP_PRODUCT_METRIC).alias("metric"),
        render.epoch_seconds(F.col("window_start")).alias("window_start"),
        render.epoch_seconds(F.col("window_end")).alias("window_end"),
        "product_id", "total_quantity", "rank",
        render.minutes_between(F.col("window_start"), F.col("window_end")).alias("window_duration_minutes"),
    )


def parse_records(messages: DataFrame) -> DataFrame:
    """Ranking records from the JSON text in ``value``, as another stream reads them; unreadable
    texts, which parse to a record without a metric, are dropped."""
    record = F.from_json("value", TOP_PRODUCT_RECORD)
    return messages.select(F.inline(F.filter(F.array(record), lambda r: r["metric"].isNotNull())))


def ranking_stream(
    items: DataFrame, p: Params, write: Callable[[Transform], BatchHandler], checkpoint: str,
    by: str = "quantity", time: str = "event_time", interval: str | None = None,
) -> StreamingQuery:
    """Rank closed windows of a stream; ``write`` turns the ranking into a batch handler.

    A watermark closes a window in one micro-batch for all products, so each batch holds whole
    windows. The batch is ranked with a per-task cut to ``k`` rows: products are never gathered
    into one list.
    """
    windows = product_windows(items, p.product_window, time)
    return per_batch(windows, write(lambda closed: rank_products(closed, p, by)), checkpoint, interval)


def stream_top_products(
    items: DataFrame, p: Params, path: str, checkpoint: str,
    by: str = "quantity", time: str = "event_time", interval: str | None = None,
) -> StreamingQuery:
    """Ranking into files."""
    return ranking_stream(items, p, partial(batch_files, path), checkpoint, by, time, interval)


def enrich_top_products(ranked: DataFrame, products: DataFrame) -> DataFrame:
    """Add name, category and price; a missing id or an unknown product is named in ``error``.

    A left join of a stream or a table with the product table; its size picks the strategy.
    """
    details = products.select(
        "product_id", F.col("name").alias("product_name"), "category_id", "price"
    ).withColumn("_known", F.lit(True))
    error = F.when(F.col("product_id").isNull(), "product_id is required").when(
        F.col("_known").isNull(), "Product not found"
    )
    return ranked.join(details, "product_id", "left").withColumn("error", error).drop("_known")


def category_windows(
    items: DataFrame, products: DataFrame, window: str, time: str = "event_time"
) -> DataFrame:
    """Sales per category and window, on bounded input and on streams.

    Items are summed up per product before the join, also on a stream, where a second
    aggregation may follow the first: a product with most of the sales joins as one row.
    """
    per_product = _sold(items, window, time)
    return _bounds(
        per_product.join(products.select("product_id", "category_id"), "product_id")
        .groupBy(F.window("w", window).alias("w"), "category_id")
        .agg(
            F.sum("total_quantity").alias("total_quantity"),
            total("total_revenue").alias("total_revenue"),
            F.sum("item_count").alias("item_count"),
        )
    )


def product_trend(windows: DataFrame) -> DataFrame:
    """Products ordered more often than in the window before in which they sold.

    Reads the table of product windows, where a product has one row per window.
    """
    compared = with_previous(
        windows.select("window_start", "product_id", "item_count"),
        order="window_start",
        values={"prev_item_count": "item_count"},
        bucket=F.date_trunc("month", "window_start"),
        by=["product_id"],
    )
    rising = compared.filter(F.col("item_count") > F.col("prev_item_count"))
    return rising.withColumn(
        "growth_rate", growth_percent(F.col("item_count"), F.col("prev_item_count"))
    )
