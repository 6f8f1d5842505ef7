"""Batch jobs: read, validate, transform, write, report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from basketlens.operators.checks import assert_valid, validate_tables
from basketlens.params import Params
from basketlens.plans import customers as customer_plans
from basketlens.plans import features as feature_plans
from basketlens.plans import products as product_plans
from basketlens.plans import revenue as revenue_plans
from basketlens.schemas import REQUIRED_COLUMNS
from basketlens.session import staged
from basketlens.sinks.marts import Layout, write_marts
from basketlens.sources.lake import read_marts, read_tables

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Job:
    """``shared`` builds the frame several marts are derived from. It is written once, as the mart
    ``shared_mart`` or else to the shared folder, and read back: losing executors later in the
    run does not recompute it."""

    name: str
    marts: Callable[[Tables, Params, DataFrame | None], dict[str, DataFrame]]
    layouts: Mapping[str, Layout]
    shared: Callable[[Tables, Params], DataFrame] | None = None
    shared_mart: str | None = None

    @property
    def required(self) -> Mapping[str, list[str]]:
        return REQUIRED_COLUMNS[self.name]


@dataclass
class RunReport:
    job_name: str
    started: dt.datetime
    finished: dt.datetime | None = None
    status: str = "RUNNING"
    error_message: str | None = None
    processed: dict[str, int] = field(default_factory=dict)
    written: dict[str, int] = field(default_factory=dict)

    @property
    def records_processed(self) -> int:
        return sum(self.processed.values())

    @property
    def records_written(self) -> int:
        return sum(self.written.values())

    @property
    def duration_seconds(self) -> float:
        return (self.finished - self.started).total_seconds() if self.finished else 0.0

    def counts(self, spark: SparkSession) -> DataFrame:
        """One row per table read or written."""
        rows = [
            (self.job_name, self.status, direction, name, rows)
            for direction, counts in (("read", self.processed), ("written", self.written))
            for name, rows in counts.items()
        ]
        return spark.createDataFrame(
            rows, "job_name STRING, status STRING, direction STRING, table_name STRING, row_count BIGINT"
        )


def run_job(
    job: Job, tables: Tables | Callable[[], Tables], destination: str, p: Params, validate: bool = True
) -> RunReport:
    """Run on tables, or on what a function reads. A failure, also of reading, ends in the
    report, not in an exception."""
    report = RunReport(job.name, _now())
    root = f"{destination}/{job.name}"
    try:
        tables = tables() if callable(tables) else tables
        used = {name: tables[name] for name in job.required}
        report.processed = assert_valid(validate_tables(used, job.required), validate)
        shared = None
        if job.shared_mart is not None:
            report.written = write_marts({job.shared_mart: job.shared(used, p)}, root, job.layouts)
            shared = read_marts(_session(used), root, [job.shared_mart])[job.shared_mart]
        elif job.shared is not None:
            shared = staged(job.shared(used, p), job.name)
        report.written |= write_marts(job.marts(used, p, shared), root, job.layouts)
        report.status = "SUCCESS"
    except Exception as failure:  # reported to the caller, who decides
        report.status, report.error_message = "FAILED", str(failure)
    finally:
        report.finished = _now()
    return report


def run_from_lake(
    spark: SparkSession, job: Job, source: str, destination: str, p: Params, fmt: str = "parquet"
) -> RunReport:
    return run_job(job, lambda: read_tables(spark, source, job.required, fmt), destination, p)


def _session(tables: Tables) -> SparkSession:
    return next(iter(tables.values())).sparkSession


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def _segmentation(t: Tables, p: Params, _: DataFrame | None) -> dict[str, DataFrame]:
    return {"customer_segmentation": customer_plans.customer_segmentation(t["orders"], t["customers"], p)}


def _revenue(t: Tables, p: Params, _: DataFrame | None) -> dict[str, DataFrame]:
    return {
        "revenue_monthly": revenue_plans.revenue_monthly(t["orders"], p),
        "revenue_daily": revenue_plans.revenue_daily(t["orders"], p),
    }


def _product_base(t: Tables, p: Params) -> DataFrame:
    return product_plans.base_product_metrics(
        t["orders"], t["order_items"], t["products"], t["categories"], p
    )


def _products(t: Tables, p: Params, base: DataFrame | None) -> dict[str, DataFrame]:
    return {
        "top_products_summary": product_plans.top_products_summary(base, p),
        "product_pricing_analytics": product_plans.product_pricing_analytics(base),
        "product_lifecycle_metrics": product_plans.product_lifecycle_metrics(base),
        "category_performance": product_plans.category_performance(base),
    }


def _matrix(t: Tables, p: Params) -> DataFrame:
    return feature_plans.user_item_interactions(
        t["orders"], t["order_items"], t["customers"], t["carts"], t["wishlists"], p
    )


def _features(t: Tables, p: Params, matrix: DataFrame | None) -> dict[str, DataFrame]:
    return {
        "user_features": feature_plans.user_features(t["customers"], matrix, t["orders"]),
        "product_features": feature_plans.product_features(t["products"], matrix, t["order_items"], p),
    }


_BY_DATE = Layout(("analysis_date",))

SEGMENTATION = Job(
    "segmentation_customer", _segmentation,
    {"customer_segmentation": Layout(("process_date", "customer_segment"), at_root=True)},
)
REVENUE = Job(
    "revenue_statistics", _revenue, {"revenue_monthly": _BY_DATE, "revenue_daily": _BY_DATE}
)
PRODUCTS = Job(
    "product_analytics", _products,
    {
        "top_products_summary": _BY_DATE,
        "product_pricing_analytics": Layout(("analysis_date", "category_name")),
        "product_lifecycle_metrics": _BY_DATE,
        "category_performance": _BY_DATE,
    },
    shared=_product_base,
)
FEATURES = Job(
    "feature_ml", _features, {}, shared=_matrix, shared_mart="user_item_interactions"
)

JOBS = {job.name: job for job in (SEGMENTATION, REVENUE, PRODUCTS, FEATURES)}
