"""Seconds per headline query: median of three warm runs, results computed in full and discarded.

Reads ``BENCH_SF_DIR`` on ``local[BENCH_CPUS]`` and prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from basketlens.queries import REGISTRY  # noqa: E402
from basketlens.session import build_session  # noqa: E402

RUNS = 3
STREAMS = ("stream_window_revenue", "stream_top_products", "stream_alerts", "stream_landed_orders")
HEADLINES = (
    "customer_segmentation", "segment_distribution", "customer_order_value_segments", "rfm",
    "revenue_monthly", "revenue_monthly_growth", "revenue_daily", "monthly_trend",
    "base_product_metrics", "top_products_summary", "product_pricing_analytics",
    "product_lifecycle_metrics", "category_performance", "top_products_by_name",
    "product_popularity", "interaction_score", "user_item_interactions", "user_features",
    "product_features", "data_quality", "cdc_current_orders", "window_revenue_1min",
    "revenue_trend", "top_products_by_quantity", "product_trend", "all_alerts",
) + STREAMS


def run_once(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    only = sys.argv[1:] or HEADLINES
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g",
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds, spread = {}, {}
    for name in only:
        run_once(spark, name, sf_dir)  # compiles code, and writes the change logs that stand for a broker
        runs = [run_once(spark, name, sf_dir) for _ in range(RUNS)]
        seconds[name] = round(statistics.median(runs), 3)
        spread[name] = [round(min(runs), 3), round(max(runs), 3)]
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    print(json.dumps({
        "metric": "total_seconds_headline_queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "spread": spread,
        "stream_rows_per_second": {n: round(events / seconds[n]) for n in STREAMS if n in seconds},
        "sf": Path(sf_dir).name,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
