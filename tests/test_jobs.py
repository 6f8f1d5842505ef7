from __future__ import annotations

import dataclasses
import datetime as dt

import pytest
from conftest import SMALL, rows

from basketlens import jobs, session
from basketlens.sinks import marts
from basketlens.sources import catalog, lake
from basketlens.sources import driver_tables as shop

P = shop.PARAMS


def test_dates_written_earlier_survive(spark, tmp_path):
    tables = shop.shop(spark, SMALL)
    for day in (dt.date(2001, 8, 1), dt.date(2001, 7, 1), dt.date(2001, 7, 1)):
        report = jobs.run_job(jobs.REVENUE, tables, str(tmp_path), dataclasses.replace(P, as_of=day))
        assert report.status == "SUCCESS", report.error_message
    written = lake.read_marts(spark, f"{tmp_path}/revenue_statistics", ["revenue_monthly"])["revenue_monthly"]
    days = written.groupBy("analysis_date").count().collect()
    assert {r[0] for r in days} == {dt.date(2001, 8, 1), dt.date(2001, 7, 1)}
    assert written.groupBy("analysis_date", "order_month").count().filter("count > 1").isEmpty()


def test_a_second_run_replaces_its_day(spark, tmp_path):
    tables = shop.shop(spark, SMALL)
    for _ in range(2):
        report = jobs.run_job(jobs.SEGMENTATION, tables, str(tmp_path), P)
    written = spark.read.parquet(f"{tmp_path}/segmentation_customer")
    assert written.count() == report.records_written
    assert (tmp_path / "segmentation_customer/process_date=2001-08-01").is_dir()


def test_product_marts_and_layout(spark, tmp_path):
    report = jobs.run_job(jobs.PRODUCTS, shop.shop(spark, SMALL), str(tmp_path), P)
    assert report.status == "SUCCESS", report.error_message
    root = tmp_path / "product_analytics"
    assert list((root / "product_pricing_analytics/analysis_date=2001-08-01").glob("category_name=*"))
    written = lake.read_marts(spark, str(root), report.written)
    assert {n: df.count() for n, df in written.items()} == report.written
    assert report.records_processed == sum(report.processed.values()) > 0
    assert report.duration_seconds > 0


def test_failures_are_reported(spark, tmp_path):
    tables = shop.shop(spark, SMALL)
    tables["orders"] = tables["orders"].drop("status")
    report = jobs.run_job(jobs.REVENUE, tables, str(tmp_path), P)
    assert report.status == "FAILED" and report.records_written == 0
    assert "orders: missing status" in report.error_message
    report = jobs.run_from_lake(spark, jobs.REVENUE, f"{tmp_path}/nowhere", str(tmp_path), P)
    assert report.status == "FAILED" and "nowhere" in report.error_message


def test_lake_written_by_other_tools(spark, tmp_path):
    """Money as doubles and ids as floats are read as declared; a missing column is named."""
    from basketlens.schemas import TABLES

    orders = spark.createDataFrame(
        [(1, dt.datetime(2001, 7, 1), 5.1, "completed", 3.0, None, None)],
        "order_id BIGINT, order_date TIMESTAMP, total_price DOUBLE, status STRING, customer_id DOUBLE, "
        "payment_id DOUBLE, shipment_id DOUBLE",
    )
    orders.write.parquet(f"{tmp_path}/lake/orders")
    assert lake.read_tables(spark, f"{tmp_path}/lake", ["orders"])["orders"].schema == TABLES["orders"]
    closed = dataclasses.replace(P, completed=("completed",))
    report = jobs.run_from_lake(spark, jobs.REVENUE, f"{tmp_path}/lake", f"{tmp_path}/marts", closed)
    assert report.written == {"revenue_monthly": 1, "revenue_daily": 1}

    orders.drop("customer_id").write.parquet(f"{tmp_path}/other/orders")
    report = jobs.run_from_lake(spark, jobs.REVENUE, f"{tmp_path}/other", f"{tmp_path}/marts", closed)
    assert "missing customer_id" in report.error_message


def test_month_folders_are_pruned(spark, tmp_path):
    path = f"{tmp_path}/orders"
    marts.write_orders_by_month(shop.orders(spark, SMALL), path)
    june = spark.read.parquet(path).filter("order_month = '2000-06'")
    assert june.count() == shop.orders(spark, SMALL).filter("date_format(order_date, 'yyyy-MM') = '2000-06'").count()
    assert "PartitionFilters: [isnotnull(order_month" in june._jdf.queryExecution().toString()
    assert len(june.inputFiles()) > 0


def test_catalog_tables(spark, tmp_path):
    path = f"{tmp_path}/orders"
    marts.write_orders_by_month(shop.orders(spark, SMALL), path)
    from basketlens.schemas import BIGINT, STRING, schema_of

    catalog.create_database(spark, "shop_test", f"{tmp_path}/db")
    catalog.register_table(
        spark, "shop_test", "orders", schema_of(order_id=BIGINT, order_month=STRING), path, ["order_month"]
    )
    assert rows(catalog.list_tables(spark, "shop_test")) == [("orders",)]
    assert rows(catalog.row_counts(spark, {"orders": "shop_test.orders"})) == [("orders", 1500)]
    assert lake.preview(spark.table("shop_test.orders"), 3).count() == 3


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    from basketlens.plans import products

    catalog.create_database(spark, "facts", f"{tmp_path}/db")
    tables = shop.shop(spark, SMALL)
    for name in ("orders", "order_items"):
        marts.write_bucketed(tables[name], f"facts.{name}", f"{tmp_path}/{name}", "order_id", 4)
    facts = catalog.read_tables(spark, "facts", ("orders", "order_items"))
    sold = products.sales(facts["orders"], facts["order_items"].hint("merge"), P)
    assert "Exchange" not in sold._jdf.queryExecution().executedPlan().toString()
    assert sold.count() == products.sales(tables["orders"], tables["order_items"], P).count()


def test_monthly_marts_read_only_their_months(spark, tmp_path):
    from basketlens.plans import revenue

    orders = shop.orders(spark, SMALL)
    marts.write_orders_by_month(orders, f"{tmp_path}/orders")
    by_month = spark.read.parquet(f"{tmp_path}/orders")
    for mart in (revenue.revenue_monthly, revenue.revenue_daily):
        pruned = mart(by_month, P)
        assert rows(pruned) == rows(mart(orders, P))
        scan = pruned._jdf.queryExecution().toString().split("PartitionFilters: [")[1]
        assert "order_month" in scan[:120]


def test_reports_are_sorted(spark):
    from basketlens.plans import customers, reports

    mart = customers.customer_segmentation(shop.orders(spark, SMALL), shop.customers(spark, SMALL), P)
    spent = [r["total_spent"] for r in reports.report("customer_segmentation", mart, 5).collect()]
    assert len(spent) == 5 and spent == sorted(spent, reverse=True)
    assert spent[0] == max(r[0] for r in mart.select("total_spent").collect())
    assert reports.in_report_order("rfm", mart) is mart


def test_command_line_runs_a_batch_job(spark, tmp_path, capsys):
    from basketlens.__main__ import main

    tables = shop.shop(spark, SMALL)
    for name in ("orders", "customers"):
        from basketlens.schemas import TABLES

        declared = [f for f in TABLES[name].fields if f.name in tables[name].columns]
        tables[name].selectExpr(
            *[f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}" for f in declared]
        ).write.parquet(f"{tmp_path}/lake/{name}")
    arguments = [
        "--as-of", "2001-08-01", "batch", "segmentation_customer",
        "--source", f"{tmp_path}/lake", "--destination", f"{tmp_path}/marts",
    ]
    assert main(arguments) == 0
    assert "SUCCESS" in capsys.readouterr().out
    written = spark.read.parquet(f"{tmp_path}/marts/segmentation_customer")
    assert written.count() == tables["orders"].select("customer_id").distinct().count()


class FakeSession:
    """A session as ``shared_dir`` sees it; the setting itself is fixed once Spark has started."""

    def __init__(self, master, folder=None):
        self.master, self.folder, self.checkpoints = master, folder, None
        self.conf = self.sparkContext = self

    def get(self, key, default=None):
        return self.folder if key == "spark.checkpoint.dir" and self.folder else default

    def getConf(self):
        return self

    def getCheckpointDir(self):
        return self.checkpoints

    def setCheckpointDir(self, folder):
        self.checkpoints = folder


def test_shared_folder_comes_from_the_session(spark):
    cluster = FakeSession("yarn", "s3a://lake/tmp/")
    assert session.shared_dir(cluster) == "s3a://lake/tmp" and cluster.checkpoints
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(FakeSession("yarn"))
    assert session.scratch(spark, "x") != session.scratch(spark, "x")


def test_a_snapshot_of_all_tables_serves_every_job(spark, tmp_path):
    """The tables that the command line takes by default are those that the jobs need."""
    from basketlens import __main__ as cli
    from basketlens.plans import ingest
    from basketlens.schemas import REQUIRED_COLUMNS, TABLES

    names = cli.arguments().parse_args(["snapshot", "--url", "u", "--destination", "d"]).tables.split(",")
    assert {t for tables in REQUIRED_COLUMNS.values() for t in tables} <= set(names)
    tables = shop.shop(spark, SMALL)
    readers = {n: (lambda n=n: tables.get(n)) for n in names}
    results = ingest.snapshot_tables(readers, TABLES, str(tmp_path / "lake"), allow_misfits=True)
    assert {r.table_name for r in results if r.status == "SUCCESS"} == set(tables)
    report = jobs.run_from_lake(spark, jobs.FEATURES, str(tmp_path / "lake"), str(tmp_path / "marts"), P)
    assert report.status == "SUCCESS", report.error_message


def test_recommendations_from_the_lake(spark, tmp_path, monkeypatch):
    from basketlens import __main__ as cli
    from basketlens.sinks.marts import write_mart

    monkeypatch.setattr(cli, "build_session", lambda app: spark)
    for name in ("orders", "order_items"):
        write_mart(shop.shop(spark, SMALL)[name], f"{tmp_path}/lake/{name}")
    for more in ([], ["--reuse"]):
        cli.main(["--as-of", "2001-08-01", "--set", "recommendations=3", "--set", "als_iterations=2", "recommend", "--source", f"{tmp_path}/lake",
                  "--destination", f"{tmp_path}/marts", "--model", f"{tmp_path}/model", *more])
        written = lake.read_marts(spark, f"{tmp_path}/marts", ["recommendations"])["recommendations"]
        assert written.count() and written.filter("rank > 3").isEmpty()


def test_unknown_settings_and_missing_folders_are_refused():
    from basketlens import __main__ as cli

    for arguments in (["--set", "no_such=1", "batch", "feature_ml", "--source", "s", "--destination", "d"],):
        with pytest.raises(SystemExit):
            cli.params_of(cli.arguments().parse_args(arguments))
    stream = ["stream", "land-orders", "--servers", "s", "--checkpoint", "c"]
    with pytest.raises(SystemExit):
        cli.run_stream(cli.arguments().parse_args(stream))
    options = cli.arguments().parse_args(["--set", "revenue_window=1 minute", "--set", "alert_orders=9", *stream])
    assert (cli.params_of(options).revenue_window, cli.params_of(options).alert_orders) == ("1 minute", 9)
