"""Revenue marts from a state that grows by what is new, instead of from all orders of a year.

Every run adds a delta: per day and per month the sums of its completed orders, and the distinct
customers and orders as bitmaps. Deltas add up by sums and by or, so late orders of earlier days are
rows like any other, and the marts come out as if computed from all orders at once.

    path/deltas/run=2024-06-15/level=day/kind=customer/...
    path/commits/run=2024-06-15/...

A run counts when it is committed. One that is repeated under its name replaces what it wrote. Deltas
hold additions only: an order that was completed and is taken back needs its days computed anew.
"""

from __future__ import annotations

import functools

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.functions.bitmaps import distinct_words, members, united
from basketlens.functions.exact import TOTAL, total
from basketlens.params import Params
from basketlens.plans import revenue
from basketlens.schemas import BIGINT, STRING, schema_of

STATE = schema_of(
    period=T.DateType(), word=BIGINT, bits=BIGINT, orders=BIGINT, priced=BIGINT, revenue=T.DecimalType(38, 2),
    run=STRING, level=STRING, kind=STRING,
)
SETS = ("customer", "order")


class RevenueState:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    # --- adding ---

    def add(self, orders: DataFrame, p: Params, run: str) -> None:
        """Add orders that no other run has added: what arrived since the last one, whatever its date.
        Only they are read. Orders that are not completed, or without a date, do not count."""
        if any(run in replaced for replaced in self._known().values()):
            raise ValueError(f"run {run} was put into another")
        done = revenue.completed(orders, p).where("order_date IS NOT NULL")
        day = F.col("order_date").cast("date").alias("period")
        rows = done.select(day, F.col("customer_id").alias("customer"), F.col("order_id").alias("order"), "total_price")
        sums = rows.groupBy("period").agg(
            F.count("order").alias("orders"), F.count("total_price").alias("priced"), total("total_price").alias("revenue"))
        parts = [_part(sums, "day", "sums")] + [_part(distinct_words(rows, ["period"], k), "day", k) for k in SETS]
        self._write(parts, run, "day")
        # Months follow from what was just written, without another look at the orders.
        days = self._read([run]).where("level = 'day'").drop("level").withColumn("period", F.trunc("period", "month"))
        self._write(_merged(days, "month"), run, "month")
        self._commit(run, [])

    def compact(self, runs: list[str], into: str) -> None:
        """Runs become one of the name ``into``; marts stay what they are. One commit puts it in their place."""
        if into in self._known():
            raise ValueError(f"there is a run {into}")
        known = self._read([r for r in self.runs() if r in set(runs)])
        for level in ("day", "month"):
            self._write(_merged(known.where(F.col("level") == level).drop("level"), level), into, level)
        self._commit(into, runs)

    def runs(self) -> list[str]:
        """The runs that count: committed, and not put into another."""
        known = self._known()
        gone = {r for replaced in known.values() for r in replaced}
        return sorted(r for r in known if r not in gone)

    # --- marts, as in plans.revenue ---

    def revenue_monthly(self, p: Params) -> DataFrame:
        return revenue.monthly_mart(self._by_month(p), p)

    def monthly_trend(self, p: Params) -> DataFrame:
        return revenue.trend_mart(self._by_month(p))

    def revenue_daily(self, p: Params) -> DataFrame:
        start = F.date_sub(F.lit(p.as_of), p.days_back)
        days = self._read(self.runs()).where((F.col("level") == "day") & (F.col("period") >= start))
        sums = _sums(days).withColumnsRenamed({"revenue": "daily_revenue", "orders": "daily_orders", "priced": "_priced"})
        found = sums.join(_distinct(days, "customer", "daily_unique_customers"), "period", "left")
        daily = found.withColumn("daily_unique_customers", F.coalesce("daily_unique_customers", F.lit(0).cast("bigint")))
        return revenue.daily_mart(daily.withColumnRenamed("period", "order_date_only"), p)

    def _by_month(self, p: Params) -> DataFrame:
        """Whole months from the months of the state; a month that begins before the year looked back on, from its days."""
        start = F.add_months(F.lit(p.as_of), -p.months_back)
        first = F.trunc(start, "month")
        whole = F.when(first == start, first).otherwise(F.add_months(first, 1))
        level, period = F.col("level"), F.col("period")
        state = self._read(self.runs()).where(((level == "month") & (period >= whole)) | ((level == "day") & (period >= start) & (period < whole)))
        state = state.withColumn("period", F.trunc("period", "month"))
        found = _sums(state)
        for kind, name in (("customer", "unique_customer"), ("order", "total_orders")):
            found = found.join(_distinct(state, kind, name), "period", "left")
        zero = F.lit(0).cast("bigint")
        return found.select(
            F.col("period").cast("timestamp").alias("order_month"), F.coalesce("unique_customer", zero).alias("unique_customer"),
            F.coalesce("total_orders", zero).alias("total_orders"), F.col("revenue").alias("total_revenue"))

    # --- files ---

    def _read(self, runs: list[str]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], STATE)
        # Folders by name: a run that was not committed, or was put into another, is not listed.
        paths = [f"{self.path}/deltas/run={r}" for r in runs]
        return self.spark.read.schema(STATE).option("basePath", f"{self.path}/deltas").parquet(*paths)

    def _write(self, parts: list[DataFrame], run: str, level: str) -> None:
        rows = functools.reduce(DataFrame.unionByName, parts).where(F.col("level") == level).drop("level")
        if level == "day":
            # All of a repeated run goes, also its months.
            rows.withColumn("level", F.lit(level)).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
                "level", "kind").parquet(f"{self.path}/deltas/run={run}")
        else:
            rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("kind").parquet(
                f"{self.path}/deltas/run={run}/level={level}")

    def _commit(self, run: str, replaces: list[str]) -> None:
        row = self.spark.createDataFrame([(replaces,)], "replaces ARRAY<STRING>")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/run={run}")

    def _known(self) -> dict[str, list[str]]:
        try:
            commits = self.spark.read.schema("replaces ARRAY<STRING>, run STRING").parquet(f"{self.path}/commits")
        except AnalysisException:
            return {}
        return {r.run: list(r.replaces) for r in commits.collect()}  # a row per run


def _part(rows: DataFrame, level: str, kind: str) -> DataFrame:
    held = {f.name: f.dataType for f in STATE.fields if f.name not in ("run", "level", "kind")}
    columns = [F.col(n) if n in rows.columns else F.lit(None).cast(t).alias(n) for n, t in held.items()]
    return rows.select(*columns, F.lit(level).alias("level"), F.lit(kind).alias("kind"))


def _merged(state: DataFrame, level: str) -> list[DataFrame]:
    sets = [_part(united(state.where(F.col("kind") == k), ["period"]), level, k) for k in SETS]
    return [_part(_sums(state), level, "sums"), *sets]


def _sums(state: DataFrame) -> DataFrame:
    return state.where("kind = 'sums'").groupBy("period").agg(
        F.sum("orders").alias("orders"), F.sum("priced").alias("priced"), F.sum("revenue").cast(TOTAL).alias("revenue"))


def _distinct(state: DataFrame, kind: str, name: str) -> DataFrame:
    return united(state.where(F.col("kind") == kind), ["period"]).groupBy("period").agg(members().alias(name))
