from __future__ import annotations

import dataclasses
import datetime as dt
import json
import os

import pytest
from conftest import money, rows, ts

from basketlens.operators import changes
from basketlens.sinks import delivery
from basketlens.sinks import streams as sinks
from basketlens.sources import topics
from basketlens.streaming import orders as order_streams
from basketlens.streaming import products as product_streams

SENTINEL = "2030-01-01T00:00:00Z"


@pytest.fixture
def p(p):
    return dataclasses.replace(p, product_window="1 minute", revenue_window="10 seconds")


def order(order_id, customer, price, time, op="c"):
    return json.dumps({"payload": {
        "order_id": order_id, "customer_id": customer, "total_price": price, "order_date": time,
        "__op": op, "__table": "orders", "__lsn": order_id,
    }})


def item(item_id, product, quantity, price=1.0):
    return json.dumps({"payload": {
        "order_item_id": item_id, "product_id": product, "quantity": quantity, "price": price,
    }})


class Topic:
    """A folder of text files, read one file per micro-batch, in the order they were added."""

    def __init__(self, spark, path):
        self.spark, self.path, self.count = spark, path, 0
        path.mkdir()

    def add(self, *lines):
        file = self.path / f"{self.count:03d}.txt"
        file.write_text("\n".join(lines) + "\n")
        os.utime(file, (1_700_000_000 + self.count, 1_700_000_000 + self.count))
        self.count += 1

    def stream(self):
        return self.spark.readStream.option("maxFilesPerTrigger", 1).text(str(self.path))


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


@pytest.fixture
def land(spark, tmp_path):
    def run(stream, fmt="parquet"):
        out, check = str(tmp_path / "out"), str(tmp_path / "check")
        sinks.to_files(stream, out, check, fmt).awaitTermination()
        return spark.read.schema(stream.schema).format(fmt).load(out)

    return run


def orders_of(topic, p):
    return order_streams.timed(changes.parse_orders(topic.stream()), p)


def test_revenue_windows_count_orders_and_close(topic, land, p):
    topic.add(
        order(1, 900, 10.10, "2024-01-01T00:00:01Z"), order(2, 901, 20.20, "2024-01-01T00:00:09Z"),
        order(3, 900, 5, "2024-01-01T00:00:12Z"),
    )
    topic.add(order(9, 1, 1, SENTINEL))
    windows = land(order_streams.window_revenue(orders_of(topic, p), p.revenue_window))
    assert rows(windows, "window_start", "total_orders", "total_revenue", "avg_order_value") == [
        (dt.datetime(2024, 1, 1, 0, 0, 0), 2, money(30.30), 15.15),
        (dt.datetime(2024, 1, 1, 0, 0, 10), 1, money(5), 5.0),
    ]
    records = order_streams.revenue_records(windows.filter("total_orders = 2"))
    got = records.first().asDict()
    assert got["metric"] == "revenue_window" and got["window_start"] == 1704067200
    assert got["window_end"] == 1704067210 and got["window_duration_minutes"] == pytest.approx(1 / 6)
    message = json.loads(sinks.as_messages(records).first()["value"])
    assert message == got | {"total_revenue": 30.30}
    assert list(message) == [
        "metric", "window_start", "window_end", "total_orders", "total_revenue", "window_duration_minutes",
    ]


def test_late_orders(topic, land, p):
    topic.add(order(1, 1, 1, "2024-01-01T00:00:08Z"), order(2, 1, 1, "2024-01-01T00:00:12Z"))
    topic.add(order(3, 1, 10, "2024-01-01T00:00:09Z"))          # 3 s late: kept
    topic.add(order(4, 1, 1, "2024-01-01T00:05:00Z"))           # closes the first windows
    topic.add(order(5, 1, 100, "2024-01-01T00:00:07Z"))         # right after: still counted or not,
    topic.add(order(6, 1, 1000, "2024-01-01T00:00:07Z"))        # two files later: dropped
    topic.add(order(9, 1, 1, SENTINEL))
    windows = land(order_streams.window_revenue(orders_of(topic, p), p.revenue_window))
    first = windows.filter("window_start = timestamp'2024-01-01 00:00:00'").first()
    assert first["total_revenue"] in (money(11), money(111))
    assert windows.groupBy().sum("total_revenue").first()[0] < 1000


def test_only_the_sixth_order_in_a_minute_alerts(topic, land, p):
    lines = [order(i, 5, i + 1, f"2024-01-01T00:00:{10 + i:02d}Z") for i in range(5)]
    lines += [order(10 + i, 6, i + 1, f"2024-01-01T00:00:{10 + i:02d}Z") for i in range(6)]
    # six orders, but in two minutes
    lines += [order(20 + i, 7, i + 1, f"2024-01-01T00:0{i % 2}:30Z") for i in range(6)]
    # one amount three times in a minute, and three times in two minutes
    lines += [order(40 + i, 4, 7, f"2024-01-01T00:00:{10 + i:02d}Z") for i in range(3)]
    lines += [order(50 + i, 3, 7, f"2024-01-01T00:0{i % 2}:30Z") for i in range(3)]
    # the limit itself is not above the limit
    lines += [order(30, 8, 10_000_000, "2024-01-01T00:00:30Z"), order(31, 9, 12_345_678.5, "2024-01-01T00:00:30Z")]
    topic.add(*lines)
    topic.add(order(99, 1, 1, SENTINEL))
    alerts = land(order_streams.all_alerts(orders_of(topic, p), p))
    assert rows(alerts.filter("customer_id <> 4")) == [
        (6, "Frequent orders", "6 orders in 1 minute"),
        (9, "High value order", "12,345,678.5 VND"),
    ]
    assert rows(alerts.filter("customer_id = 4")) == [(4, "Similar orders", "3 x 7.0 VND")]
    alerts = alerts.filter("customer_id <> 4")
    assert rows(order_streams.with_alert_text(alerts), "message")[0] == (
        "🚨 Fraud Alert: Customer 6 | Frequent orders (Value: 6 orders in 1 minute)",
    )


def test_alerts_of_one_parse(spark, topic, tmp_path, p):
    """Both branches take their rows from one exchange, and the windows still close."""
    lines = [order(10 + i, 6, i % 2, f"2024-01-01T00:00:{10 + i:02d}Z") for i in range(6)]
    lines += [order(31, 9, 12_345_678.5, "2024-01-01T00:00:30Z"), order(32, 8, None, "2024-01-01T00:00:30Z")]
    topic.add(*lines)
    topic.add(order(50, 7, 3, "2024-01-01T00:10:00Z"), order(51, 7, 3, "2024-01-01T00:10:01Z"))
    topic.add(order(52, 7, 3, "2024-01-01T00:20:00Z"))
    topic.add(*[order(60 + i, 6, 5, "2024-01-01T00:00:40Z") for i in range(9)])  # too late by now
    topic.add(order(99, 1, 20_000_000, SENTINEL))
    orders = changes.parse_orders(topic.stream())
    assert not order_streams.has_watermark(orders) and order_streams.has_watermark(order_streams.timed(orders, p))
    found = {}
    for name, source in (("once", orders), ("twice", order_streams.timed(orders, p))):
        alerts = order_streams.all_alerts(source, p)
        query = sinks.to_files(alerts, str(tmp_path / name), str(tmp_path / f"{name}-check"))
        query.awaitTermination()
        plan = query._jsq.explainInternal(False)
        found[name] = rows(spark.read.schema(alerts.schema).parquet(str(tmp_path / name)))
        assert plan.count("ReusedExchange") == (1 if name == "once" else 0)
        assert plan.count("from_json") == (1 if name == "once" else 2)
        assert plan.count("StateStoreSave") == 1
    assert found["once"] == found["twice"] == [
        (1, "High value order", "20,000,000.0 VND"), (6, "Frequent orders", "6 orders in 1 minute"),
        (6, "Similar orders", "3 x 0.0 VND"), (6, "Similar orders", "3 x 1.0 VND"), (9, "High value order", "12,345,678.5 VND"),
    ]


def test_similar_orders(topic, land, p):
    topic.add(*[order(i, 5, 7.5, "2024-01-01T00:00:10Z") for i in range(3)], order(7, 5, 8, "2024-01-01T00:00:10Z"))
    topic.add(order(99, 1, 1, SENTINEL))
    alerts = land(order_streams.similar_order_alerts(orders_of(topic, p), p))
    assert rows(alerts, "customer_id", "value") == [(5, "3 x 7.5 VND")]


def test_amounts_as_text(spark):
    from pyspark.sql import functions as F

    from basketlens.functions.render import amount_text

    df = spark.createDataFrame([(money(v),) for v in (15000000, 1234567.89, 0.5, 638807)], "v DECIMAL(18,2)")
    got = [r[0] for r in df.select(amount_text(F.col("v"))).collect()]
    assert got == ["15,000,000.0 VND", "1,234,567.89 VND", "0.5 VND", "638,807.0 VND"]


@pytest.mark.parametrize("position", ["no_such_column", "__lsn"])
def test_updates_of_an_order_are_counted_once(topic, land, p, position):
    def change(order_id, lsn, price, second):
        return json.dumps({"payload": {
            "order_id": order_id, "customer_id": 1, "total_price": price,
            "order_date": f"2024-01-01T00:00:0{second}Z", "__op": "u", "__table": "orders", "__lsn": lsn,
        }})

    topic.add(*[change(1, lsn, 10, 1) for lsn in range(40)])  # in many buckets, and repeated
    topic.add(*[change(1, lsn, 10, 1) for lsn in range(20, 60)], change(2, 99, 5, 2))
    topic.add(order(9, 1, 1, SENTINEL))
    parsed = changes.parse_orders(topic.stream())
    first = changes.first_event_per_key(parsed, "order_id", "event_time", "20 minutes", position)
    windows = land(order_streams.window_revenue(first, "10 seconds"))
    assert rows(windows, "total_orders", "total_revenue") == [(2, money(15))]


def test_the_first_event_of_a_key_is_kept_whole(topic, land, p):
    def change(order_id, lsn, price, status, minute=0):
        return json.dumps({"payload": {
            "order_id": order_id, "customer_id": 10 * price, "total_price": price, "status": status,
            "order_date": f"2024-01-01T00:{minute:02d}:01Z", "__op": "u", "__table": "orders", "__lsn": lsn,
        }})

    topic.add(change(1, 7, 30, "late"), change(1, 5, 20, "first"), change(2, None, 4, None), change(2, None, 4, None))
    topic.add(change(1, 3, 10, "arrives second, came first"), change(3, 1, 8, "x"))
    topic.add(change(4, 1, 9, "x", minute=50))
    topic.add(change(1, 1, 99, "too late", minute=0), change(9, 1, 1, "open", minute=55))  # within the watermark of the batch before
    topic.add(change(1, 1, 77, "too late"), change(9, 2, 1, "open", minute=55))
    topic.add(order(99, 1, 1, SENTINEL))
    first = changes.first_event_per_key(changes.parse_orders(topic.stream()), "order_id", "event_time", "20 minutes")
    got = {r.order_id: (r.customer_id, r.total_price, r.status) for r in land(first).collect()}
    assert got[1] in ((100, money(10), "arrives second, came first"), (990, money(99), "too late"))
    assert got[2] == (40, money(4), None) and got[3] == (80, money(8), "x") and got[4] == (90, money(9), "x") and got[9] == (10, money(1), "open")


def test_de_duplication_keeps_one_state(spark, topic, tmp_path, p):
    topic.add(*[order(i % 3, 1, 1, "2024-01-01T00:00:10Z") for i in range(9)])
    first = changes.first_event_per_key(changes.parse_orders(topic.stream()), "order_id", "event_time", "5 seconds")
    query = sinks.to_files(first.select("order_id", "total_price"), str(tmp_path / "out"), str(tmp_path / "check"))
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert plan.count("StateStoreSave") == 1 and "Deduplicate" not in plan
    assert "min_by(status" not in plan  # what is not used is not kept


def _timed_items(topic, p):
    """Items get the time of the file they arrived in, as the broker would stamp them."""
    from pyspark.sql import functions as F

    read = topic.stream().withColumn("event_time", F.col("_metadata.file_modification_time"))
    return order_streams.timed(changes.parse_order_items(read), p)


def test_top_products_of_a_stream(spark, topic, tmp_path, p):
    topic.add(
        item(1, 10, 5), item(2, 20, 5), item(3, 30, 9), item(4, 40, 1), item(5, 50, 2), item(6, 60, 3),
        item(7, 70, 4), item(8, 10, 1), item(9, 80, 0), item(10, 90, -3),
    )
    topic.count += 100_000  # a day later
    topic.add(item(11, 1, 1))
    out = str(tmp_path / "top")
    product_streams.stream_top_products(
        _timed_items(topic, p), p, out, str(tmp_path / "check")
    ).awaitTermination()
    ranked = spark.read.parquet(out)
    first = [(3, 20, 5), (1, 30, 9), (2, 10, 6), (4, 70, 4), (5, 60, 3)]
    assert rows(ranked, "rank", "product_id", "total_quantity") == sorted(first)
    record = product_streams.top_product_records(ranked).orderBy("rank").first().asDict()
    assert record["metric"] == "top_product_window" and record["window_duration_minutes"] == 1.0


def test_repeated_batch_replaces_its_output(spark, tmp_path):
    handler = sinks.batch_files(str(tmp_path / "out"), lambda df: df)
    batch = spark.range(3)
    handler(batch, 0)
    handler(batch, 1)
    handler(batch, 1)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6


def test_enrichment_names_unknown_products(spark, topic, land):
    record = {"metric": "top_product_window", "window_start": 0, "window_end": 60, "total_quantity": 4, "rank": 1}
    topic.add(*[json.dumps(record | {"product_id": i}) for i in (1, 2, None)], "{broken")
    products = spark.createDataFrame(
        [(1, "lamp", 10, money(3))], "product_id BIGINT, name STRING, category_id INT, price DECIMAL(18,2)"
    )
    stream = product_streams.enrich_top_products(product_streams.parse_records(topic.stream()), products)
    assert rows(land(stream), "product_id", "product_name", "error") == [
        (1, "lamp", None), (2, None, "Product not found"), (None, None, "product_id is required"),
    ]


def test_category_windows_stream_equals_batch(spark, topic, land, p):
    topic.add(item(1, 1, 2, 1.5), item(2, 2, 1, 2.0), item(3, 1, 1, 1.5), item(4, 9, 1), item(5, 1, -1))
    topic.count += 100_000
    topic.add(item(6, 1, 1))
    products = spark.createDataFrame([(1, "a"), (2, "b")], "product_id BIGINT, category_id STRING")
    streamed = land(product_streams.category_windows(_timed_items(topic, p), products, "1 minute"))
    assert rows(streamed, "category_id", "total_quantity", "total_revenue", "item_count") == [
        ("a", 3, money(4.5), 2), ("b", 1, money(2), 1),
    ]
    bounded = changes.parse_order_items(spark.read.text(str(topic.path))).selectExpr(
        "*", "timestamp'2024-01-01' AS event_time"
    )
    batch = product_streams.category_windows(bounded, products, "1 minute")
    assert rows(batch, "category_id", "item_count") == [("a", 3), ("b", 1)]


def test_json_sink_and_landing(topic, land, p):
    topic.add(order(1, 2, 3.5, "2024-01-01T00:00:01Z"), "{broken")
    landed = land(order_streams.landed(orders_of(topic, p)), "json")
    assert rows(landed, "order_id", "total_price", "order_date") == [(1, money(3.5), ts("2024-01-01 00:00:01"))]


def test_arrival_time_windows(topic, land, p):
    topic.add(item(1, 10, 2))
    arrived = topics.with_arrival_time(changes.parse_order_items(topic.stream()))
    assert land(arrived).filter("proc_time > timestamp'2024-01-01'").count() == 1


# --- alert delivery ------------------------------------------------------------------------------


def _alerts(spark):
    data = [(1, "High value order", "15,000,000.0 VND"), (2, "Frequent orders", "6 orders in 1 minute")]
    return spark.createDataFrame(data, "customer_id BIGINT, reason STRING, value STRING").coalesce(1)


def _recording_sender(path, fail_first=0, status=204):
    """A channel that writes every call to a file and fails a number of times."""

    def send(message):
        calls = len(open(path).readlines()) if os.path.exists(path) else 0
        with open(path, "a") as log:
            log.write(json.dumps(message) + "\n")
        if calls < fail_first:
            raise ConnectionError("down")
        return status

    return send


def test_delivery_retries_and_passes_alerts_through(spark, tmp_path):
    calls = tmp_path / "calls"
    log = delivery.deliver(_alerts(spark), _recording_sender(str(calls), fail_first=1)).collect()
    assert [(r.customer_id, r.delivered, r.error) for r in log] == [(1, True, None), (2, True, None)]
    sent = [json.loads(line)["content"] for line in calls.read_text().splitlines()]
    assert len(sent) == 3 and sent[0] == sent[1]
    assert sent[0] == (
        "🚨 **FRAUD DETECTED**\n🚨 Fraud Alert: Customer 1 | High value order (Value: 15,000,000.0 VND)"
    )


def test_refused_alerts_are_logged(spark, tmp_path):
    log = delivery.deliver(_alerts(spark), _recording_sender(str(tmp_path / "c"), status=500), attempts=2).collect()
    assert [(r.delivered, r.error) for r in log] == [(False, "status 500")] * 2


def test_http_sender_posts_json(monkeypatch):
    seen = []

    class Response:
        status = 204
        __enter__ = lambda self: self
        __exit__ = lambda self, *args: None

    def urlopen(request, timeout):
        seen.append((request.full_url, request.get_method(), json.loads(request.data), timeout))
        return Response()

    monkeypatch.setattr("urllib.request.urlopen", urlopen)
    assert delivery.http_sender("http://channel")({"content": "x"}) == 204
    assert seen == [("http://channel", "POST", {"content": "x"}, 5.0)]


def test_finished_batch_is_not_sent_again(spark, tmp_path):
    calls = tmp_path / "calls"
    handle = delivery.delivery_handler(str(tmp_path / "log"), _recording_sender(str(calls)))
    for batch_id in (0, 0, 1):
        handle(_alerts(spark), batch_id)
    assert len(calls.read_text().splitlines()) == 4
    assert spark.read.parquet(str(tmp_path / "log")).count() == 4


def test_alert_stream_to_delivery(spark, topic, tmp_path, p):
    topic.add(order(31, 9, 12_000_000, "2024-01-01T00:00:30Z"))
    calls = tmp_path / "calls"
    handle = delivery.delivery_handler(str(tmp_path / "log"), _recording_sender(str(calls)))
    alerts = order_streams.all_alerts(orders_of(topic, p), p)
    sinks.per_batch(alerts, handle, str(tmp_path / "check")).awaitTermination()
    assert len(calls.read_text().splitlines()) == 1


# --- applications --------------------------------------------------------------------------------


def test_alert_application(spark, topic, tmp_path, p):
    from basketlens.streaming import apps

    # one order and its two updates are one order, unless changes are to be counted
    lines = [order(i, 6, i + 1, f"2024-01-01T00:00:{10 + i:02d}Z") for i in range(4)]
    lines += [order(1, 6, 2, "2024-01-01T00:00:40Z", "u"), order(2, 6, 3, "2024-01-01T00:00:41Z", "u")]
    topic.add(*lines, order(31, 9, 12_000_000, "2024-01-01T00:00:30Z"))
    topic.add(order(99, 1, 1, SENTINEL))
    for per_change, customers in ((False, {9}), (True, {6, 9})):
        log = str(tmp_path / f"log{per_change}")
        orders = apps.orders_of(topic.stream(), p, per_change)
        apps.order_alerts(
            orders, p, str(tmp_path / f"check{per_change}"), log, lambda message: 204
        ).awaitTermination()
        sent = spark.read.parquet(log)
        assert {r[0] for r in sent.select("customer_id").collect()} == customers
        assert sent.filter("not delivered").isEmpty()


def test_alerts_without_channel_are_printed(topic, tmp_path, p):
    from basketlens.streaming import apps

    topic.add(order(31, 9, 12_000_000, "2024-01-01T00:00:30Z"))
    orders = apps.orders_of(topic.stream(), p)
    apps.order_alerts(orders, p, str(tmp_path / "check")).awaitTermination()
    with pytest.raises(ValueError):
        apps.order_alerts(orders, p, str(tmp_path / "other"), send=lambda message: 204)


def test_landed_orders_feed_the_same_alerts(spark, topic, tmp_path, land, p):
    from basketlens.streaming import apps

    topic.add(*[order(i, 6, i + 1, f"2024-01-01T00:00:{10 + i:02d}Z") for i in range(6)])
    topic.add(order(31, 9, 12_000_000, "2024-01-01T00:00:30Z"), order(31, 9, 12_000_000, "2024-01-01T00:00:30Z", "u"))
    topic.add(order(99, 1, 1, SENTINEL))
    table = str(tmp_path / "table")
    apps.land_orders(topic.stream(), p, table, str(tmp_path / "landing")).awaitTermination()
    assert spark.read.parquet(table).count() == 9
    alerts = land(order_streams.all_alerts(apps.landed_orders(spark, table, p), p))
    assert rows(alerts, "customer_id") == [(6,), (9,)]


def test_restart_continues_where_it_stopped(spark, topic, tmp_path, p):
    from basketlens.streaming import apps

    for n in range(2):
        topic.add(order(n, 1, 5, f"2024-01-01T00:0{n}:00Z"))
        apps.land_orders(topic.stream(), p, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == n + 1


def test_stream_settings_are_restored(spark):
    from basketlens.session import stream_settings

    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    with stream_settings(spark):
        assert "RocksDB" in spark.conf.get(key)
    assert spark.conf.get(key, None) == before


def test_ranking_stream_equals_batch_on_closed_windows(spark, topic, tmp_path, p):
    topic.add(*[item(i, i % 9, i % 4 + 1, i % 7) for i in range(200)])
    topic.count += 100_000
    topic.add(item(999, 1, 1))
    out = str(tmp_path / "top")
    items = _timed_items(topic, p)
    product_streams.stream_top_products(items, p, out, str(tmp_path / "c"), by="revenue").awaitTermination()
    bounded = changes.parse_order_items(spark.read.text(str(topic.path / "000.txt"))).selectExpr(
        "*", "timestamp'2024-01-01' AS event_time"
    )
    batch = product_streams.top_products(bounded, p, by="revenue")
    columns = ["rank", "product_id", "total_quantity", "total_revenue"]
    assert rows(spark.read.parquet(out), *columns) == rows(batch, *columns)
