"""Parquet marts: layout per mart, one writer, row counts observed while writing."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from basketlens.schemas import MONTH, SNAPSHOT


@dataclass(frozen=True)
class Layout:
    """``mode="overwrite"`` replaces only the partitions present in the data, when partitioned.
    A job with one mart writes it ``at_root``, without a folder of its own."""

    partition_by: tuple[str, ...] = ()
    mode: str = "overwrite"
    at_root: bool = False

    def path(self, root: str, name: str) -> str:
        return root if self.at_root else f"{root}/{name}"


def write_mart(df: DataFrame, path: str, layout: Layout = Layout()) -> int:
    """Write snappy parquet and return the number of rows written, without a second run.

    Partitioned marts are rebalanced on their partition columns first: each folder gets few,
    evenly sized files, and a folder with much of the data is split over several tasks.

    Folders are replaced when all rows are written, not before: a run that fails leaves the former
    ones. A mart without partitions is one folder, ``snapshot=current``, for that reason.
    """
    partition_by = layout.partition_by or (SNAPSHOT,)
    if layout.partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in layout.partition_by])
    else:
        df = df.withColumn(SNAPSHOT, F.lit("current"))
    counter = Observation()  # last before the write, so that repeated shuffle tasks count once
    counted = df.observe(counter, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.mode(layout.mode).option("compression", "snappy")
    writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic").parquet(path)
    rows = int(counter.get["rows"])
    if not rows and not layout.partition_by:
        # no folder is written for no rows: an empty one replaces what was there
        df.drop(SNAPSHOT).limit(0).write.mode("overwrite").parquet(f"{path}/{SNAPSHOT}=current")
    return rows


def write_marts(
    marts: Mapping[str, DataFrame], root: str, layouts: Mapping[str, Layout]
) -> dict[str, int]:
    written = {}
    for name, df in marts.items():
        layout = layouts.get(name, Layout())
        written[name] = write_mart(df, layout.path(root, name), layout)
    return written


def write_for_lookup(df: DataFrame, path: str, *keys: str) -> None:
    """Files in ranges of ``keys``: a lookup by the first key reads the few files and row groups
    whose range holds it. With a second key, the rows of a large first key share several files."""
    sorted_rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    sorted_rows.write.mode("overwrite").option("compression", "snappy").parquet(path)


def with_month(orders: DataFrame) -> DataFrame:
    return orders.withColumn(MONTH, F.date_format("order_date", "yyyy-MM"))


def write_orders_by_month(orders: DataFrame, path: str) -> int:
    """Orders partitioned by month, so that date-bounded reads skip folders."""
    return write_mart(with_month(orders), path, Layout((MONTH,)))


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """External bucketed table; joins of two such tables on ``key`` need no shuffle.

    For facts that several marts join again and again. A bucket cannot be split at run time, so
    keep tables with hot keys unbucketed.
    """
    df.write.mode("overwrite").format("parquet").option("path", path).bucketBy(
        buckets, key
    ).sortBy(key).saveAsTable(table)
