from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from basketlens.operators import checks, cleaning, incremental
from basketlens.plans import ingest
from basketlens.schemas import BIGINT, PRICE, STRING, TABLES, schema_of


def _dirty(spark):
    return spark.createDataFrame(
        [
            ("1", "nan", "0123", "2024-01-01 10:00:00+02:00", "2024-01-02", None),
            ("2.0", "None", "0456", "not a date", None, None),
            ("2.5", "Ann", None, "2024-01-01 10:00:00", "2024-01-03", None),
        ],
        "customer_id STRING, first_name STRING, phone_number STRING, created_at STRING, "
        "updated_at STRING, email STRING",
    )


def test_cleaning_to_declared_types(spark):
    cleaned = cleaning.clean_table(_dirty(spark), TABLES["customers"], "", cleaning.NULL_TEXTS)
    assert cleaned.schema.simpleString() == TABLES["customers"].simpleString()
    got = cleaned.select("customer_id", "first_name", "phone_number", "created_at", "email").collect()
    assert [tuple(r) for r in got] == [
        (1, "", "0123", dt.datetime(2024, 1, 1, 8), ""),
        (2, "", "0456", None, ""),
        (None, "Ann", "", dt.datetime(2024, 1, 1, 10), ""),
    ]


def test_nulls_can_be_kept(spark):
    cleaned = cleaning.clean_table(_dirty(spark), TABLES["customers"])
    assert [r[0] for r in cleaned.select("first_name").collect()] == ["nan", "None", "Ann"]
    assert cleaned.filter("email is null").count() == 3


def test_null_profile(spark):
    profile = {r["column_name"]: (r["nulls"], r["all_null"]) for r in cleaning.null_profile(_dirty(spark)).collect()}
    assert profile["email"] == (3, True)
    assert profile["phone_number"] == (1, False)


def test_validation_names_every_problem(spark):
    good = spark.createDataFrame([(1, 2)], "a INT, b INT")
    tables = {"good": good, "empty": good.limit(0), "short": good.drop("b")}
    required = {name: ["a", "b"] for name in tables}
    report = checks.validate_tables(tables, required)
    assert rows(report) == [("empty", 0, "", False), ("good", 1, "", True), ("short", 1, "b", False)]
    with pytest.raises(checks.ValidationError, match="empty: empty; short: missing b"):
        checks.assert_valid(report)
    assert checks.assert_valid(report, enabled=False) == {"good": 1, "empty": 0, "short": 1}


def test_orphans_and_duplicates(spark):
    child = spark.createDataFrame([(1, 10), (1, 10), (2, 20), (3, None)], "id INT, parent INT")
    parent = spark.createDataFrame([(10,)], "pid INT")
    report = checks.quality_report(
        checks.duplicate_check("c", child, ["id"]), checks.orphan_check("c", child, "parent", parent, "pid")
    )
    assert rows(report, "check_name", "violations") == [("duplicate:id", 1), ("orphan:parent", 1)]


def test_snapshots_are_isolated_and_drop_passwords(spark, tmp_path):
    people = spark.createDataFrame(
        [("7", "pw", "2024-01-01")], "customer_id STRING, password STRING, updated_at STRING"
    )

    def broken():
        raise OSError("no connection")

    readers = {
        "orders": broken, "carts": lambda: None,
        "wishlists": lambda: spark.createDataFrame([], TABLES["wishlists"]),
        "customers": lambda: people,
    }
    results = {r.table_name: r for r in ingest.snapshot_tables(readers, TABLES, str(tmp_path))}
    assert {n: r.status for n, r in results.items()} == {
        "orders": "FAILED", "carts": "SKIPPED", "wishlists": "SKIPPED", "customers": "SUCCESS"
    }
    assert "no connection" in results["orders"].error and results["customers"].row_count == 1
    # taking the table again does not double it
    ingest.snapshot_tables({"customers": lambda: people}, TABLES, str(tmp_path))
    written = spark.read.parquet(f"{tmp_path}/customers")
    assert written.count() == 1 and "password" not in written.columns


def test_incremental_load(spark):
    data = [(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2, 3, 4, 5, 678900))]
    df = spark.createDataFrame(data, "id INT, updated_at TIMESTAMP")
    assert incremental.changed_since(df, "updated_at", None).count() == 2
    assert rows(incremental.changed_since(df, "updated_at", "2024-01-01 00:00:00"), "id") == [(1,), (2,)]
    assert rows(incremental.changed_since(df, "updated_at", "2024-01-01 00:00:01"), "id") == [(2,)]
    mark = incremental.high_water_mark(df, "updated_at")
    assert mark == "2024-01-02 03:04:05.6789"
    assert rows(incremental.changed_since(df, "updated_at", mark), "id") == [(2,)]
    assert incremental.high_water_mark(df.limit(0), "updated_at") is None


def test_decimal_text(spark):
    df = spark.createDataFrame([("12.345",), ("x",)], "price STRING")
    got = df.select(cleaning.clean_column(df.price, TABLES["products"]["price"].dataType).alias("p")).collect()
    assert [r.p for r in got] == [Decimal("12.35"), None]


def _numbered(spark, n, broken=False):
    """Rows of which the last one can make the read fail."""
    value = F.col("id")
    if broken:
        value = F.when(F.col("id") == n - 1, F.raise_error(F.lit("connection lost")).cast("long")).otherwise(value)
    return spark.range(n).select(value.alias("order_id"), F.lit("1.50").alias("total_price"), F.lit("x").alias("status"))


SCHEMA = schema_of(order_id=BIGINT, total_price=PRICE, status=STRING)


def test_a_source_that_fails_midway_leaves_the_former_table(spark, tmp_path):
    path = str(tmp_path)
    assert ingest.snapshot_table("orders", lambda: _numbered(spark, 50), SCHEMA, path).row_count == 50
    failed = ingest.snapshot_table("orders", lambda: _numbered(spark, 80, broken=True), SCHEMA, path)
    assert failed.status == "FAILED" and "connection lost" in failed.error
    assert spark.read.parquet(f"{path}/orders").count() == 50
    assert ingest.snapshot_table("orders", lambda: _numbered(spark, 30), SCHEMA, path).row_count == 30
    assert spark.read.parquet(f"{path}/orders").count() == 30


def test_values_that_do_not_fit_are_counted_and_stop_the_table(spark, tmp_path):
    path = str(tmp_path)
    rows = [("3000000000", "123456789.99", "nan"), ("9" * 25, "1.00", None), ("7.5", "9" * 20, "None"), ("8.0", None, "")]
    source = spark.createDataFrame(rows, "order_id string, total_price string, status string")
    failed = ingest.snapshot_table("orders", lambda: source, SCHEMA, path)
    assert failed.status == "FAILED" and dict(failed.misfits) == {"order_id": 2, "total_price": 1}
    done = ingest.snapshot_table("orders", lambda: source, SCHEMA, path, allow_misfits=True)
    assert done.status == "SUCCESS" and dict(done.misfits) == {"order_id": 2, "total_price": 1}
    got = {(r.order_id, r.total_price and str(r.total_price), r.status) for r in spark.read.parquet(f"{path}/orders").collect()}
    assert got == {(3000000000, "123456789.99", "nan"), (None, "1.00", None), (None, None, "None"), (8, None, "")}


def test_rows_at_the_mark_are_loaded_once(spark):
    columns = "order_id long, day string, status string"
    copy = spark.createDataFrame([(1, "2000-01-01", "a"), (2, "2000-01-02", "a")], columns)
    now = spark.createDataFrame([(1, "2000-01-01", "z"), (2, "2000-01-02", "b"), (3, "2000-01-02", "a"), (4, "2000-01-03", "a")], columns)
    since = incremental.changed_since(now, "day", incremental.high_water_mark(copy, "day"))
    got = sorted(tuple(r) for r in incremental.merged(copy, since, ["order_id"], "day").collect())
    assert got == [(1, "2000-01-01", "a"), (2, "2000-01-02", "b"), (3, "2000-01-02", "a"), (4, "2000-01-03", "a")]


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_made_misfits_never_fit(spark, scale):
    """Also where the order with key 0 is among them."""
    from basketlens.queries import REGISTRY

    raw = spark.read.parquet(f"/root/testdata/{scale}/orders.parquet")
    got = {r.column_name: r.misfits for r in REGISTRY["ingest_misfits"](spark, f"/root/testdata/{scale}").collect()}
    assert got["order_id"] == raw.filter("o_orderpriority = '5-LOW'").count()
    assert raw.filter("o_orderkey = 0").count() == 1
