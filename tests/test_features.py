from __future__ import annotations

import dataclasses
import datetime as dt

import pytest
from conftest import ITEMS, ORDERS, money, rows, ts

from basketlens.operators import interactions
from basketlens.plans import features, products, recommend


def _tables(spark, p):
    def day(age):
        return dt.datetime.combine(p.as_of - dt.timedelta(days=age), dt.time(9))

    orders = spark.createDataFrame(
        [(i, 1, day(age), money(10 * i), "pending") for i, age in enumerate((30, 31, 90, 91, 180, 181), 1)]
        + [(7, 1, day(30), money(70), "pending")],
        ORDERS,
    )
    items = spark.createDataFrame(
        [(i, i, 100 + i, 2, money(5)) for i in range(1, 7)]
        + [(7, 7, 101, 2, money(5))],  # same product, quantity and time as the first
        ITEMS,
    )
    customers = spark.createDataFrame([(1,), (2,), (3,)], "customer_id BIGINT")
    carts = spark.createDataFrame(
        [(2, 200, 3, day(1)), (2, 200, 3, day(1)), (9, 200, 3, day(1))],
        "customer_id BIGINT, product_id BIGINT, quantity INT, added_at TIMESTAMP",
    )
    wishlists = spark.createDataFrame(
        [(2, 200, day(300))], "customer_id BIGINT, product_id BIGINT, added_at TIMESTAMP"
    )
    return orders, items, customers, carts, wishlists


def test_recency_limits_and_duplicates(spark, p):
    orders, items, *_ = _tables(spark, p)
    weights = interactions.purchases(orders, items, p.as_of)
    assert [(r[0], float(r[1])) for r in rows(weights, "product_id", "weight")] == [
        (101, 2.0), (102, 1.6), (103, 1.6), (104, 1.2), (105, 1.2), (106, 0.8),
    ]


def test_cart_and_wishlist_only(spark, p):
    orders, items, customers, carts, wishlists = _tables(spark, p)
    matrix = features.user_item_interactions(orders, items, customers, carts, wishlists, p)
    # cart: 3 x 1.0, once; wish: 0.6; the customer who is not known is left out
    assert rows(matrix.filter("product_id = 200"), "customer_id", "avg_weight", "interaction_count") == [
        (2, 1.8, 2)
    ]


def test_missing_activity_is_zero_and_dates_are_null(spark, p):
    orders, items, customers, carts, wishlists = _tables(spark, p)
    matrix = features.user_item_interactions(orders, items, customers, carts, wishlists, p)
    users = {r["customer_id"]: r for r in features.user_features(customers, matrix, orders).collect()}
    assert set(users) == {1, 2, 3}
    idle = users[3]
    assert (idle["total_activity_score"], idle["total_orders"], idle["total_spent"]) == (0.0, 0, 0)
    assert idle["last_activity_date"] is None and idle["first_purchase_date"] is None
    active = users[1]
    assert active["customer_lifetime_days"] == 151
    assert active["purchase_frequency"] == pytest.approx(7 / 152)
    assert active["unique_products_interacted"] == 6

    catalogue = spark.createDataFrame(
        [(101, 1, money(3), ts("2024-06-05")), (999, 1, money(3), None)],
        "product_id BIGINT, category_id INT, price DECIMAL(18,2), created_at TIMESTAMP",
    )
    made = {r["product_id"]: r for r in features.product_features(catalogue, matrix, items, p).collect()}
    assert (made[101]["total_sold"], made[101]["total_orders"], made[101]["total_revenue"]) == (4, 2, 20)
    assert made[101]["days_since_launch"] == 10
    assert (made[999]["total_sold"], made[999]["days_since_launch"]) == (0, 0)
    assert made[999]["last_interaction_date"] is None


def test_optional_attributes_are_carried(spark, p):
    orders, items, customers, carts, wishlists = _tables(spark, p)
    matrix = features.user_item_interactions(orders, items, customers, carts, wishlists, p)
    from pyspark.sql import functions as F

    aged = customers.withColumn("age", F.lit(40))
    assert "age" in features.user_features(aged, matrix, orders).columns


def test_feature_entries_by_customer(spark, p):
    orders, items, *_ = _tables(spark, p)
    entries = features.feature_entries(products.interaction_score(orders, items))
    assert rows(features.entries_of(entries, 1).filter("field = '101'")) == [
        ("user:1:interactions", "101", '{"product_id":101,"score":4}')
    ]


def test_entries_are_stored_for_lookup(spark, tmp_path):
    from basketlens.sinks.marts import write_for_lookup

    scores = spark.range(5000).selectExpr("id % 500 AS customer_id", "id AS product_id", "id % 9 AS interaction_score")
    entries = features.feature_entries(scores)
    write_for_lookup(entries, f"{tmp_path}/entries", "key", "field")
    stored = spark.read.parquet(f"{tmp_path}/entries")
    assert rows(features.entries_of(stored, 77)) == rows(features.entries_of(entries, 77))
    found = stored.filter("key = 'user:77:interactions'").selectExpr("_metadata.file_path AS f").distinct().count()
    assert found == 1 and stored.count() == 5000


def test_recommendations_prefer_the_own_group(spark, p):
    # two groups of customers that buy two disjoint sets of products
    scores = spark.createDataFrame(
        [(c, pr, 5 if c % 2 == pr % 2 else 1) for c in range(12) for pr in range(8) if (c + pr) % 5],
        "customer_id INT, product_id INT, interaction_score BIGINT",
    )
    model = recommend.train(scores, p)
    few = spark.createDataFrame([(0,), (1,), (500,)], "customer_id INT")
    result = recommend.recommend(model, few, dataclasses.replace(p, recommendations=3))
    got = rows(result, "customer_id", "rank", "product_id")
    assert [(c, r) for c, r, _ in got] == [(c, r) for c in (0, 1) for r in (1, 2, 3)]  # 500 is unknown
    assert all(c % 2 == pr % 2 for c, _, pr in got)
    again = recommend.recommend(recommend.train(scores, p), few, dataclasses.replace(p, recommendations=3))
    assert rows(again, "customer_id", "rank", "product_id") == got


def test_recommendations_are_the_best_scores(spark, p):
    """Against all scores computed in numpy from the fitted factors."""
    import numpy as np

    scores = spark.createDataFrame(
        [(c, pr, (c * 7 + pr * 3) % 11 + 1) for c in range(30) for pr in range(40) if (c * pr) % 3],
        "customer_id INT, product_id INT, interaction_score BIGINT",
    )
    model = recommend.train(scores, p)
    users = {r["id"]: np.array(r["features"]) for r in model.userFactors.collect()}
    items = {r["id"]: np.array(r["features"]) for r in model.itemFactors.collect()}
    result = recommend.recommend(model, scores.select("customer_id").distinct(), p)
    by_user: dict = {}
    for r in result.orderBy("customer_id", "rank").collect():
        by_user.setdefault(r["customer_id"], []).append(r["rating"])
    assert set(by_user) == set(users)
    for user, ratings in by_user.items():
        best = sorted((float(users[user] @ f) for f in items.values()), reverse=True)[: p.recommendations]
        assert ratings == pytest.approx(best, rel=1e-4)
