"""External tables in the session catalog over lake folders."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def create_database(spark: SparkSession, database: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")


def register_table(
    spark: SparkSession,
    database: str,
    name: str,
    schema: T.StructType,
    location: str,
    partitioned_by: Iterable[str] = (),
) -> None:
    """External parquet table; partitions already on disk are picked up."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    keys = list(partitioned_by)
    clause = f" PARTITIONED BY ({', '.join(keys)})" if keys else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) "
        f"USING parquet{clause} LOCATION '{location}'"
    )
    if keys:
        spark.sql(f"MSCK REPAIR TABLE {database}.{name}")


def read_tables(spark: SparkSession, database: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Catalog tables under the names the jobs know them by; bucketing is kept."""
    return {name: spark.table(f"{database}.{name}") for name in names}


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}").select(F.col("tableName").alias("table_name"))


def row_counts(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """One row per label with the row count of its catalog table."""
    counts = [
        spark.table(table).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(label).alias("table_name"), "row_count"
        )
        for label, table in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result
