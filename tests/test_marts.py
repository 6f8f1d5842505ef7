from __future__ import annotations

import datetime as dt
from decimal import Decimal

from conftest import ITEMS, ORDERS, money, rows, ts

from basketlens.plans import customers, products, revenue


def _customers(spark, *ids):
    data = [(i, f"first{i}", f"last{i}", f"{i}@x") for i in ids]
    return spark.createDataFrame(data, "customer_id BIGINT, first_name STRING, last_name STRING, email STRING")


def _orders(spark, *data):
    """(order, customer, date, price, status)"""
    return spark.createDataFrame([(o, c, ts(d), money(v), s) for o, c, d, v, s in data], ORDERS)


def _products(spark):
    products_df = spark.createDataFrame(
        [(1, "lamp", 10), (2, "lamp", 10), (3, "desk", 20), (4, "orphan", 99)],
        "product_id BIGINT, name STRING, category_id INT",
    )
    categories = spark.createDataFrame([(10, "light"), (20, "wood")], "category_id INT, name STRING")
    return products_df, categories


def _items(spark, *data):
    return spark.createDataFrame([(i, o, pr, q, money(v)) for i, o, pr, q, v in data], ITEMS)


def test_segment_limits_are_inclusive_and_reports_are_not(spark, p):
    orders = _orders(
        spark,
        (1, 1, "2024-01-01", 100_000_000, "pending"),
        (2, 2, "2024-01-01", 10_000_000, "confirmed"),
        (3, 3, "2024-01-01", 9_999_999.99, "completed"),
        (4, 4, "2024-01-01", 10_000, "completed"),
    )
    people = _customers(spark, 1, 2, 3, 4, 5)
    inclusive = customers.customer_segmentation(orders, people, p)
    assert rows(inclusive, "customer_id", "customer_segment") == [
        (1, "High Value"), (2, "Medium Value"), (3, "Low Value"), (4, "Low Value"),
    ]
    report = customers.order_value_segments(orders, people, p)
    assert (4, 1, "Medium Value") in rows(report, "customer_id", "total_orders", "customer_segment")
    assert (5, 0, "Low Value") in rows(report, "customer_id", "total_orders", "customer_segment")
    assert report.filter("customer_id = 5").first()["total_spent"] is None
    twin = customers.segmentation_of_all_orders(orders, people, p)
    assert (1, "medium value") in rows(twin, "customer_id", "customer_segment")


def test_single_order_has_no_lifetime(spark, p):
    orders = _orders(
        spark, (1, 1, "2024-01-01", 5, "x"), (2, 2, "2024-01-01", 5, "x"), (3, 2, "2024-01-11", 10, "x")
    )
    result = customers.customer_segmentation(orders, _customers(spark, 1, 2), p)
    assert rows(result, "customer_id", "customer_lifetime_days", "avg_days_between_orders", "avg_order_spent") == [
        (1, 0, 0.0, 5.0), (2, 10, 5.0, 7.5),
    ]


def test_unknown_customers_share_one_group(spark, p):
    orders = _orders(
        spark, (1, 1, "2024-01-01", 5, "x"), (2, 8, "2024-01-01", 6, "x"), (3, 9, "2024-01-01", 7, "x")
    )
    result = customers.segmentation_of_all_orders(orders, _customers(spark, 1), p)
    assert rows(result, "customer_id", "total_orders", "total_spent", "avg_spent") == [
        (1, 1, money(5), 5.0), (None, 2, money(13), 6.5),
    ]


def test_segments_sum_to_customers_with_orders(spark, p):
    orders = _orders(spark, *[(i, i % 7, "2024-01-01", i * 1_000_000, "x") for i in range(60)])
    marts = customers.customer_segmentation(orders, _customers(spark, *range(9)), p)
    counted = {r[0]: r[1] for r in customers.segment_distribution(marts).collect()}
    assert sum(counted.values()) == 7


def test_month_range_gap_and_growth(spark, p):
    orders = _orders(
        spark,
        (1, 1, "2023-06-14 23:59:59", 1000, "completed"),  # one day too early
        (2, 1, "2023-06-15 00:00:00", 100, "completed"),   # first day of the range
        (3, 2, "2023-08-02", 150, "completed"),            # July has no sales
        (4, 2, "2023-09-02", 0, "completed"),
        (5, 3, "2024-01-02", 50, "completed"),             # previous month had no revenue
        (6, 3, "2024-01-03", 999, "pending"),
    )
    monthly = revenue.revenue_monthly(orders, p)
    grown = revenue.revenue_monthly_growth(monthly)
    assert rows(grown, "order_month", "total_revenue", "prev_month_revenue", "revenue_growth_rate") == [
        (dt.datetime(2023, 6, 1), money(100), None, 0.0),
        (dt.datetime(2023, 8, 1), money(150), money(100), 50.0),
        (dt.datetime(2023, 9, 1), money(0), money(150), -100.0),
        (dt.datetime(2024, 1, 1), money(50), money(0), 0.0),
    ]


def test_other_statuses_can_count_as_completed(spark, p):
    import dataclasses

    orders = _orders(spark, (1, 1, "2024-06-01", 5, "confirmed"), (2, 1, "2024-06-01", 6, "completed"))
    both = dataclasses.replace(p, completed=("completed", "confirmed"))
    assert revenue.revenue_monthly(orders, both).first()["total_orders"] == 2


def test_daily_range_and_weekend(spark, p):
    orders = _orders(
        spark,
        (1, 1, "2024-03-16 10:00:00", 3, "completed"),   # 91 days before
        (2, 1, "2024-03-17 10:00:00", 4, "completed"),   # 90 days before, a Sunday
        (3, 1, "2024-06-08 10:00:00", 5, "completed"),   # Saturday
        (4, 1, "2024-06-10 10:00:00", 6, "completed"),   # Monday
        (5, 1, "2024-06-10 11:00:00", 8, "completed"),
    )
    daily = revenue.revenue_daily(orders, p)
    assert rows(daily, "day_of_week", "day_name", "is_weekend", "daily_revenue", "daily_avg_order_value") == [
        (1, "Sunday", True, money(4), 4.0),
        (2, "Monday", False, money(14), 7.0),
        (7, "Saturday", True, money(5), 5.0),
    ]


def test_product_marts(spark, p):
    products_df, categories = _products(spark)
    orders = _orders(
        spark,
        (1, 1, "2024-01-01", 0, "completed"), (2, 2, "2024-01-06", 0, "completed"),
        (3, 1, "2024-02-01", 0, "pending"),
    )
    items = _items(
        spark, (1, 1, 1, 2, 10), (2, 2, 1, 1, 16), (3, 1, 2, 3, 12), (4, 3, 3, 9, 99), (5, 1, 4, 1, 1), (6, 1, 3, 1, 5),
    )
    base = products.base_product_metrics(orders, items, products_df, categories, p)
    assert rows(base, "product_id", "total_quantity_sold", "total_revenue", "unique_customers", "total_orders") == [
        (1, 3, money(36), 2, 2), (2, 3, money(36), 1, 1), (3, 1, money(5), 1, 1),
    ]
    # sold on one day only: no lifecycle
    lifecycle = products.product_lifecycle_metrics(base)
    assert rows(lifecycle, "product_id", "product_lifecycle_days", "revenue_per_day") == [(1, 5, 7.2)]
    # a tie in revenue goes to the smaller id
    import dataclasses

    first = products.top_products_summary(base, dataclasses.replace(p, top_k=1))
    assert rows(first, "product_id") == [(1,)]
    # two products with one name count as one, and their shared buyer once
    named = products.top_products_by_name(orders, items, products_df, categories, p)
    assert rows(named, "product_name", "total_revenue", "unique_customers") == [
        ("desk", money(5), 1), ("lamp", money(72), 2),
    ]
    performance = products.category_performance(base)
    assert rows(performance, "category_name", "category_total_revenue", "active_products_count") == [
        ("light", money(72), 2), ("wood", money(5), 1),
    ]
    pricing = products.product_pricing_analytics(base)
    assert (1, 13.0, 18.0, 1.5) in rows(
        pricing, "product_id", "avg_selling_price", "avg_revenue_per_customer", "avg_quantity_per_customer"
    )


def test_money_sums_stay_exact(spark, p):
    orders = _orders(spark, *[(i, 1, "2024-06-01", Decimal("0.10"), "completed") for i in range(1000)])
    assert revenue.revenue_monthly(orders, p).first()["total_revenue"] == Decimal("100.00")


def test_nulls_in_orders(spark, p):
    """Orders without customer or price, against the same counts taken in Python."""
    data = [
        (i, None if i % 5 == 0 else i % 4, ts("2024-06-01"), None if i % 3 == 0 else money(i), "completed")
        for i in range(1, 60)
    ]
    orders = spark.createDataFrame(data, ORDERS)
    people = _customers(spark, 0, 1, 2, 9)

    expected = {}
    for _, customer, _, price, _ in data:
        key = customer if customer in (0, 1, 2) else None
        group = expected.setdefault(key, [0, 0, 0])
        group[0] += 1
        if price is not None:
            group[1] += 1
            group[2] += price
    twin = customers.segmentation_of_all_orders(orders, people, p)
    assert {r["customer_id"]: (r["total_orders"], r["total_spent"], r["avg_spent"]) for r in twin.collect()} == {
        k: (n, s, float(s) / c) for k, (n, c, s) in expected.items()
    }
    segments = customers.customer_segmentation(orders, people, p)
    assert {r[0] for r in segments.select("customer_id").collect()} == {0, 1, 2}
    monthly = revenue.revenue_monthly(orders, p).first()
    assert (monthly["unique_customer"], monthly["total_orders"]) == (4, 59)
    assert customers.rfm(orders, p).filter("customer_id is null").first()["frequency"] == 11
