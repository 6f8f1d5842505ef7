from __future__ import annotations

import json
import random

from conftest import SMALL, money, rows

from basketlens.operators import changes
from basketlens.sources import driver_tables as shop
from basketlens.streaming import apps


def _event(op, lsn, table="customers", deleted="false", **columns):
    return json.dumps({
        "schema": {}, "payload": columns | {"__op": op, "__table": table, "__lsn": lsn, "__deleted": deleted},
    })


def _log(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value STRING")


LIFE = [
    _event("c", 1, customer_id=1, first_name="Ida", email="i@x"),
    _event("u", 2, customer_id=1, first_name="Ines", email="i@x"),
    _event("d", 3, deleted="true", customer_id=1),
    None,
    _event("c", 4, customer_id=2, first_name="Tim"),
    _event("u", 9, customer_id=2, first_name="Tom"),
]


def test_create_update_delete_leaves_nothing(spark):
    records = changes.change_records(_log(spark, *LIFE[:4]), "customers")
    assert records.count() == 3
    assert changes.current_state(records, ["customer_id"]).count() == 0


def test_state_does_not_depend_on_arrival_order(spark):
    for seed in range(4):
        shuffled = LIFE[:]
        random.Random(seed).shuffle(shuffled)
        records = changes.change_records(_log(spark, *shuffled), "customers")
        state = changes.current_state(records, ["customer_id"])
        assert rows(state, "customer_id", "first_name") == [(2, "Tom")]


def test_latest_image_before_the_delete(spark):
    records = changes.change_records(_log(spark, *LIFE[:2]), "customers")
    assert rows(changes.current_state(records, ["customer_id"]), "first_name") == [("Ines",)]


def test_order_parser_drops_what_it_cannot_date(spark):
    good = _event("c", 1, "orders", order_id=1, customer_id=5, total_price=10.5, order_date="2024-01-01T00:00:01Z")
    zoned = _event("c", 2, "orders", order_id=2, customer_id=5, total_price=1, order_date="2024-01-01T07:00:01+07:00")
    log = _log(
        spark, good, zoned, "{broken", None, '{"schema": {}}',
        _event("c", 3, "orders", order_id=3), _event("c", 4, "orders", order_id=4, order_date=""),
        _event("c", 5, "orders", order_id=5, order_date="someday"),
    )
    parsed = changes.parse_orders(log)
    assert rows(parsed, "order_id", "timestamp", "total_price") == [
        (1, 1704067201000, money(10.5)), (2, 1704067201000, money(1)),
    ]


def test_item_parser_needs_product_and_quantity(spark):
    log = _log(
        spark,
        _event("c", 1, "order_items", order_item_id=1, product_id=3, quantity=2, price=1.25),
        _event("c", 2, "order_items", order_item_id=2, quantity=2),
        _event("c", 3, "order_items", order_item_id=3, product_id=3),
        _event("c", 4, "order_items", order_item_id=4, product_id=3, quantity=0, price=1),
    )
    assert rows(changes.parse_order_items(log), "order_item_id", "quantity") == [(1, 2), (4, 0)]


def test_captured_tables_and_new_orders(spark):
    log = _log(
        spark,
        _event("r", 1, "orders", order_id=1, order_date="2024-01-01"),
        _event("c", 2, "orders", order_id=2, order_date="2024-01-01"),
        _event("u", 3, "orders", order_id=2, order_date="2024-01-01"),
        _event("c", 4, "sessions", order_id=3, order_date="2024-01-01"),
    )
    records = changes.captured(changes.change_records(log, "orders"))
    assert rows(records, "__lsn") == [(1,), (2,), (3,)]
    assert rows(changes.created_only(records), "order_id") == [(1,), (2,)]


def test_texts_are_parsed_once(spark):
    plan = changes.parse_orders(_log(spark, *LIFE))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_changes_applied_to_a_table(spark):
    current = spark.createDataFrame([(1, "old"), (2, "Tim"), (7, "Ann")], "customer_id BIGINT, first_name STRING")
    records = changes.change_records(_log(spark, *LIFE, _event("c", 12, customer_id=9, first_name="New")), "customers")
    assert rows(changes.apply_changes(current, records, ["customer_id"])) == [(2, "Tom"), (7, "Ann"), (9, "New")]


def test_broker_columns_do_not_disturb_the_parsers(spark):
    """Messages as the broker delivers them: with key, partition, offset and record time."""
    import datetime as dt

    from basketlens.sources.topics import decode

    event = _event("c", 1, "orders", order_id=1, customer_id=5, total_price=2.5, order_date="2024-01-01T00:00:01Z")
    item = _event("c", 1, "order_items", order_item_id=1, product_id=3, quantity=2, price=1.25)
    when = dt.datetime(2024, 1, 1, 0, 5)
    frame = spark.createDataFrame(
        [(b"k", e.encode(), "t", 0, n, when, 0) for n, e in enumerate((event, item))],
        "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, timestampType INT",
    )
    messages = decode(frame)
    orders = changes.parse_orders(messages)
    assert rows(orders, "order_id", "timestamp", "offset") == [(1, 1704067201000, 0)]
    items = changes.parse_order_items(messages)
    assert rows(items, "order_item_id", "timestamp") == [(1, when)]


def test_the_merge_reads_and_parses_the_log_once(spark, tmp_path):
    shop.order_changes(spark, SMALL).write.parquet(f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log")
    current = shop.orders(spark, SMALL).select("order_id", "customer_id", "status")
    merged = changes.apply_changes(current, changes.change_records(log, "orders"), ["order_id"])
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and plan.count("Join") == 0


def test_items_count_once(spark):
    def event(op, quantity, lsn, deleted="false"):
        return (f'{{"payload":{{"order_item_id":1,"order_id":1,"product_id":7,"quantity":{quantity},"price":1.5,'
                f'"__op":"{op}","__table":"order_items","__lsn":{lsn},"__deleted":"{deleted}"}}}}',)

    log = spark.createDataFrame([event("c", 2, 1), event("u", 3, 2), event("d", 3, 3, "true")], "value string")
    assert [r.quantity for r in apps.items_of(log).collect()] == [2]
    assert sorted(r.quantity for r in apps.items_of(log, per_change=True).collect()) == [2, 3]


def test_a_batch_is_applied_by_key_and_may_be_repeated(spark):
    """The statements are run on an in-process database of this test."""
    import duckdb

    from basketlens.schemas import TABLES
    from basketlens.sinks import streams as sinks

    con = duckdb.connect()
    columns = [f.name for f in TABLES["customers"].fields if f.name != "password"]
    con.execute(f"CREATE TABLE shop ({', '.join(c + (' BIGINT PRIMARY KEY' if c == 'customer_id' else ' VARCHAR') for c in columns)})")

    def stage(rows, db, table):
        held = [tuple(None if v is None else v if isinstance(v, (bool, int)) else str(v) for v in r) for r in rows.collect()]
        con.execute(f"CREATE OR REPLACE TABLE {table} ({', '.join(c + (' BIGINT' if c == 'customer_id' else ' BOOLEAN' if c == 'deleted' else ' VARCHAR') for c in rows.columns)})")
        if held:
            con.executemany(f"INSERT INTO {table} VALUES ({', '.join('?' * len(rows.columns))})", held)

    def execute(statements):
        for statement in statements:
            con.execute(statement)

    handle = sinks.batch_upsert(None, "shop", "shop_staging", ["customer_id"], lambda b: apps.latest_rows(b, "customers"), execute, stage)
    first = _log(spark, _event("c", 1, customer_id=1, first_name="Ida", password="x"), _event("c", 2, customer_id=2, first_name="Bo"),
                 _event("u", 3, customer_id=1, first_name="Ada"), None)
    second = _log(spark, _event("d", 5, deleted="true", customer_id=2), _event("u", 4, customer_id=2, first_name="Bob"),
                  _event("c", 6, customer_id=3, first_name="Cy"))
    state = lambda: con.execute("SELECT customer_id, first_name FROM shop ORDER BY 1").fetchall()
    for _ in range(2):
        handle(changes.change_records(first, "customers"), 0)
        assert state() == [(1, "Ada"), (2, "Bo")]
    for _ in range(2):
        handle(changes.change_records(second, "customers"), 1)
        assert state() == [(1, "Ada"), (3, "Cy")]
    assert "password" not in apps.latest_rows(changes.change_records(first, "customers"), "customers").columns
