"""Plans: what reaches the scan, what is cut before the shuffle, how hot keys are spread."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from basketlens.operators.previous import with_previous
from basketlens.operators.ranking import top_k_per_group
from basketlens.plans import customers, products, revenue
from basketlens.sources import driver_tables as shop

P = shop.PARAMS


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def details_of(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    changed = {}

    def set_(key, value):
        changed.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield set_
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_filters_and_columns_reach_the_scan(spark):
    plan = details_of(revenue.revenue_monthly(shop.orders(spark, SMALL), P))
    assert "EqualTo(o_orderstatus,F)" in plan and "GreaterThanOrEqual(o_orderdate" in plan
    assert "o_orderpriority" not in plan


def test_orders_are_aggregated_before_the_customer_join(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(customers.customer_segmentation(shop.orders(spark, SMALL), shop.customers(spark, SMALL), P))
    # one shuffle for the orders, one for the customers: the join reuses the first
    assert plan.count("Exchange hashpartitioning") == 2


def test_no_broadcast_without_a_size(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    tables = shop.shop(spark, SMALL)
    base = products.base_product_metrics(
        tables["orders"], tables["order_items"], tables["products"], tables["categories"], P
    )
    assert "Broadcast" not in plan_of(base)


def test_ranking_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS g", "id", "id % 7 AS m")
    top = top_k_per_group(df, ["g"], "m", ["id"], 2)
    assert plan_of(top).count("WindowGroupLimit") == 2
    assert rows(top, "g", "rank", "id")[:2] == [(0, 1, 6), (0, 2, 27)]


def test_hot_order_is_split_by_aqe(spark, conf, tmp_path):
    """One order holds a third of all items: its partition of the join is read by several tasks."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    # scaled down with the data; the hot rows compress well, hence the factor
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "16KB")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16KB")
    conf("spark.sql.files.openCostInBytes", "1KB")
    conf("spark.sql.shuffle.partitions", "16")
    conf("spark.sql.files.maxPartitionBytes", "128KB")
    items = spark.range(0, 120_000, 1, 8).select(
        F.col("id").alias("order_item_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 20_000).alias("order_id"),
        (F.col("id") % 500).alias("product_id"), F.lit(1).alias("quantity"),
        (F.col("id") % 97).cast("decimal(18,2)").alias("price"),
    )
    items.write.parquet(f"{tmp_path}/items")
    orders = spark.range(0, 20_000, 1, 4).select(
        F.col("id").alias("order_id"), (F.col("id") % 900).alias("customer_id"),
        F.lit(dt.datetime(2001, 1, 1)).alias("order_date"), F.lit("F").alias("status"),
    )
    orders.write.parquet(f"{tmp_path}/orders")
    sold = products.sales(spark.read.parquet(f"{tmp_path}/orders"), spark.read.parquet(f"{tmp_path}/items"), P)
    per_product = sold.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    assert per_product.agg(F.sum("n")).first()[0] == 120_000
    per_product.collect()
    assert "SortMergeJoin(skew=true)" in plan_of(per_product)


@pytest.mark.parametrize("by", [[], ["k"]])
def test_previous_row_equals_a_global_lag(spark, by):
    start = dt.datetime(2024, 1, 1)
    data = [
        (k, start + dt.timedelta(hours=7 * i * (k + 1), minutes=k), i * 10 + k)
        for k in range(3) for i in range(300) if i % 11
    ]
    df = spark.createDataFrame(data, "k INT, t TIMESTAMP, v INT")
    got = with_previous(df, "t", {"before": "v"}, F.date_trunc("month", "t"), by)

    expected = []
    for key in ({r[0] for r in data} if by else [None]):
        axis = sorted((r for r in data if key is None or r[0] == key), key=lambda r: r[1])
        expected += [(k, t, v, axis[i - 1][2] if i else None) for i, (k, t, v) in enumerate(axis)]
    assert rows(got) == sorted(expected, key=repr)


def test_partitioned_marts_are_rebalanced(spark, tmp_path, conf):
    """A folder with most of the rows is written by several tasks, the small ones by one."""
    from basketlens.sinks.marts import Layout, write_mart

    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    df = spark.range(0, 200_000, 1, 8).selectExpr(
        "id", "hash(id) AS noise", "CASE WHEN id % 100 = 0 THEN 'b' ELSE 'a' END AS part"
    )
    assert write_mart(df, f"{tmp_path}/mart", Layout(("part",))) == 200_000
    files = {p: len(list((tmp_path / f"mart/part={p}").glob("*.parquet"))) for p in "ab"}
    assert files["a"] > files["b"] and files["b"] == 1


OTHER_PLANS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "13",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.files.maxPartitionBytes": "64KB",
}


@pytest.mark.parametrize("name", [
    "customer_segmentation", "customer_segmentation_all_orders", "base_product_metrics", "top_products_by_name",
    "user_features", "product_features", "data_quality", "cdc_merged_orders", "revenue_trend", "enriched_top_products",
])
def test_results_do_not_depend_on_the_plan(spark, conf, name):
    """Without broadcasts, with other partitions and with splits forced, to the last digit."""
    from basketlens.queries import REGISTRY

    usual = rows(REGISTRY[name](spark, SMALL))
    for key, value in OTHER_PLANS.items():
        conf(key, value)
    assert rows(REGISTRY[name](spark, SMALL)) == usual
