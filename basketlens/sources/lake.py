"""Lake tables: declared-schema scans, several tables at once, marts read back."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.schemas import MONTH, SNAPSHOT, TABLES


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Scan one lake table.

    ``fmt="delta"`` needs the Delta package in the session; parquet is always there. A declared
    schema spares the job that reads it from a footer; absent columns are then read as null.
    """
    reader = spark.read.format(fmt)
    if schema is not None and fmt == "parquet":
        reader = reader.schema(schema)
    return reader.load(path)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns that are present, in their declared types, and the month of
    partitioned orders.

    A lake filled by other tools may hold money as doubles or nullable ids as floats. Columns
    that are absent stay absent, so that validation can name them. Types that agree need no cast
    and are filtered in the scan.
    """
    declared = [f for f in schema.fields if f.name in df.columns]
    partition = [MONTH] if MONTH in df.columns else []
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in declared], *partition)


def read_tables(
    spark: SparkSession, root: str, names: Iterable[str], fmt: str = "parquet"
) -> dict[str, DataFrame]:
    return {name: conform(read_table(spark, f"{root}/{name}", fmt=fmt), TABLES[name]) for name in names}


def read_marts(spark: SparkSession, root: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Open written marts; partition folders come back as columns."""
    return {name: spark.read.parquet(f"{root}/{name}").drop(SNAPSHOT) for name in names}


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)
