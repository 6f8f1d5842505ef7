"""Command line: ``python -m basketlens <command> ...`` (``--help`` lists them)."""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt
import os
import sys

from basketlens import jobs
from basketlens.params import Params
from basketlens.plans import ingest, products, recommend
from basketlens.schemas import PRIMARY_KEYS, TABLES, topic
from basketlens.session import build_session, scratch
from basketlens.sinks.delivery import http_sender
from basketlens.sinks.marts import write_mart
from basketlens.sources import topics
from basketlens.sources.database import Database, read_snapshot
from basketlens.sources.lake import read_tables
from basketlens.streaming import apps


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="basketlens")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today())
    parser.add_argument(
        "--set", action="append", default=[], metavar="NAME=VALUE", dest="settings",
        help="a parameter, such as revenue_window='1 minute' or alert_orders=10; may be repeated",
    )
    commands = parser.add_subparsers(dest="command", required=True)

    batch = commands.add_parser("batch", help="run a batch job on lake tables")
    batch.add_argument("job", choices=sorted(jobs.JOBS))
    batch.add_argument("--source", required=True)
    batch.add_argument("--destination", required=True)
    batch.add_argument("--format", default="parquet", choices=["parquet", "delta"])

    snapshot = commands.add_parser("snapshot", help="take database tables into the lake")
    snapshot.add_argument("--url", required=True)
    snapshot.add_argument("--tables", default=",".join(TABLES))
    snapshot.add_argument("--destination", required=True)
    snapshot.add_argument("--partitions", type=int, default=16)
    snapshot.add_argument("--allow-misfits", action="store_true", help="make values null that their type cannot hold")

    recommend_ = commands.add_parser("recommend", help="recommend products to the customers of the last days")
    recommend_.add_argument("--source", required=True)
    recommend_.add_argument("--destination", required=True)
    recommend_.add_argument("--model", required=True, help="folder of the model")
    recommend_.add_argument("--reuse", action="store_true", help="use the model that is there instead of training one")

    stream = commands.add_parser("stream", help="run a stream application")
    stream.add_argument("app", choices=["revenue", "top-products", "alerts", "land-orders"])
    stream.add_argument("--servers", required=True)
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--interval", default="10 seconds")
    stream.add_argument("--sink-topic")
    stream.add_argument("--path", help="folder of landed orders, or of the log of sent alerts")
    stream.add_argument("--webhook", help="where alerts are posted; they are printed without one")
    stream.add_argument("--starting", default="latest", choices=["latest", "earliest"])
    stream.add_argument("--per-batch", type=int, help="most messages in one micro-batch")

    peek = commands.add_parser("peek", help="show the first messages of a topic")
    peek.add_argument("--servers", required=True)
    peek.add_argument("--topic", default=topic("order_items"))
    peek.add_argument("--messages", type=int, default=5)
    return parser


def params_of(options: argparse.Namespace) -> Params:
    """Parameters with the values given on the command line, in the types of the defaults."""
    given = {}
    for setting in options.settings:
        name, separator, value = setting.partition("=")
        fields = {f.name: f for f in dataclasses.fields(Params) if f.name != "as_of"}
        if not separator or name not in fields:
            raise SystemExit(f"--set {setting}: known are {', '.join(sorted(fields))}")
        kind = type(fields[name].default)
        given[name] = tuple(value.split(",")) if kind is tuple else kind(value)
    return Params(as_of=options.as_of, **given)


def run_batch(options: argparse.Namespace) -> int:
    spark = build_session(f"basketlens-{options.job}")
    report = jobs.run_from_lake(
        spark, jobs.JOBS[options.job], options.source, options.destination,
        params_of(options), options.format,
    )
    print(f"{report.job_name}: {report.status} in {report.duration_seconds:.1f} s")
    print(f"read {report.processed}, wrote {report.written}")
    if report.error_message:
        print(report.error_message, file=sys.stderr)
    return 0 if report.status == "SUCCESS" else 1


def run_snapshot(options: argparse.Namespace) -> int:
    spark = build_session("basketlens-snapshot")
    db = Database(options.url, os.environ.get("DB_USER", ""), os.environ.get("DB_PASSWORD", ""))

    def reader(table: str):
        return lambda: read_snapshot(spark, db, table, PRIMARY_KEYS[table], options.partitions)

    names = options.tables.split(",")
    results = ingest.snapshot_tables(
        {n: reader(n) for n in names}, TABLES, options.destination, options.allow_misfits
    )
    for result in results:
        misfits = " ".join(f"{column}={n}" for column, n in result.misfits.items())
        print(result.table_name, result.status, result.row_count, misfits, result.error or "")
    return 1 if any(r.status == "FAILED" for r in results) else 0


def run_recommend(options: argparse.Namespace) -> int:
    spark = build_session("basketlens-recommend")
    p = params_of(options)
    tables = read_tables(spark, options.source, ("orders", "order_items"))
    if options.reuse:
        model = recommend.load(options.model)
    else:
        model = recommend.train(products.interaction_score(tables["orders"], tables["order_items"]), p)
        recommend.save(model, options.model)
    found = recommend.served(model, recommend.active_customers(tables["orders"], p), p)
    rows = write_mart(found.lists, f"{options.destination}/recommendations")
    print(f"recommendations: {rows} rows, {found.scored:.1%} of all pairs scored")
    return 0


def run_stream(options: argparse.Namespace) -> int:
    # A folder that changed with every start would lose what the checkpoint counts as done.
    if options.path is None and (options.app == "land-orders" or options.webhook):
        raise SystemExit(f"{options.app} needs --path, the same at every start")
    spark = build_session(f"basketlens-{options.app}")
    p = params_of(options)
    table = "order_items" if options.app == "top-products" else "orders"
    messages = topics.read_topic_stream(
        spark, options.servers, topic(table), options.starting, options.app, options.per_batch
    )
    if options.app == "revenue":
        query = apps.revenue_statistics(
            apps.orders_of(messages, p), p, options.servers, options.sink_topic or "statistics_revenue",
            options.checkpoint, options.interval,
        )
    elif options.app == "top-products":
        query = apps.top_product_statistics(
            messages, p, options.servers, options.sink_topic or "statistics_top_product",
            options.checkpoint, interval=options.interval,
        )
    elif options.app == "alerts":
        send = http_sender(options.webhook) if options.webhook else None
        query = apps.order_alerts(
            apps.untimed_orders_of(messages), p, options.checkpoint, options.path, send, options.interval
        )
    else:
        query = apps.land_orders(messages, p, options.path, options.checkpoint, options.interval)
    query.awaitTermination()
    return 0


def run_peek(options: argparse.Namespace) -> int:
    spark = build_session("basketlens-peek")
    messages = topics.read_topic_head(
        spark, options.servers, options.topic, options.messages, scratch(spark, "peek")
    )
    topics.peek(messages, options.messages).show(truncate=False)
    return 0


def main(argv: list[str] | None = None) -> int:
    options = arguments().parse_args(argv)
    commands = {
        "batch": run_batch, "snapshot": run_snapshot, "recommend": run_recommend, "stream": run_stream, "peek": run_peek,
    }
    return commands[options.command](options)


if __name__ == "__main__":
    sys.exit(main())
