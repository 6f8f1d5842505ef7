"""Incremental loads by a growing column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def changed_since(df: DataFrame, column: str, last_seen: str | None) -> DataFrame:
    """Rows at or after the mark of the last load; everything on the first load. Rows at the mark
    come again, because others of the same time may have come since: write them by key, as
    ``merged`` does. The comparison with a constant reaches the parquet scan."""
    if last_seen is None:
        return df
    return df.filter(F.col(column) >= F.lit(last_seen).cast(df.schema[column].dataType))


def high_water_mark(df: DataFrame, column: str) -> str | None:
    """The largest value as text in the session zone, fit to be stored between loads."""
    return df.agg(F.max(column).cast("string").alias("mark")).first()["mark"]


def merged(current: DataFrame, loaded: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """The table with the loaded rows, by key the one with the largest ``column``; on equal values the
    loaded row. Rows that were loaded before are not doubled."""
    both = current.withColumn("_new", F.lit(0)).unionByName(loaded.withColumn("_new", F.lit(1)))
    row = F.struct(*[F.col(c) for c in current.columns if c not in keys])
    last = both.groupBy(*keys).agg(F.max_by(row, F.struct(F.col(column), F.col("_new"))).alias("_row"))
    return last.select(*keys, "_row.*").select(*current.columns)
