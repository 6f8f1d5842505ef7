"""Tables of a relational database, read and written through JDBC in parallel."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Database:
    url: str
    user: str
    password: str
    driver: str = "org.postgresql.Driver"

    def options(self) -> dict[str, str]:
        return {
            "url": self.url, "user": self.user, "password": self.password, "driver": self.driver,
        }


def snapshot_options(
    db: Database, table: str, key: str, bounds: tuple[int, int], partitions: int
) -> dict[str, str]:
    """Options of a full-table read split on a numeric key into ``partitions`` range scans."""
    return db.options() | {
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(partitions),
        "fetchsize": "10000",
    }


def key_bounds(spark: SparkSession, db: Database, table: str, key: str) -> tuple[int, int] | None:
    """Smallest and largest key, computed by the database; None for an empty table."""
    query = f"SELECT min({key}) AS lo, max({key}) AS hi FROM {table}"
    row = spark.read.format("jdbc").options(**db.options(), query=query).load().first()
    return None if row is None or row["lo"] is None else (int(row["lo"]), int(row["hi"]))


def read_snapshot(
    spark: SparkSession, db: Database, table: str, key: str, partitions: int
) -> DataFrame | None:
    """Whole table as a DataFrame, or None when it is empty and should be skipped."""
    bounds = key_bounds(spark, db, table, key)
    if bounds is None:
        return None
    options = snapshot_options(db, table, key, bounds, partitions)
    return spark.read.format("jdbc").options(**options).load()


def replace_rows(df: DataFrame, db: Database, table: str) -> None:
    """Make ``table`` hold these rows alone; used for staging tables."""
    df.write.format("jdbc").options(**db.options(), dbtable=table).mode("overwrite").save()


def upsert_statements(target: str, staging: str, columns: Sequence[str], keys: Sequence[str], deleted: str) -> list[str]:
    """Statements that bring ``target`` up to date from ``staging``, which has one row per key and a
    flag for rows that are gone. Run in one transaction they may be repeated without harm."""
    same = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    rest = [c for c in columns if c not in keys]
    update = f"DO UPDATE SET {', '.join(f'{c} = excluded.{c}' for c in rest)}" if rest else "DO NOTHING"
    names = ", ".join(columns)
    return [
        f"DELETE FROM {target} AS t USING {staging} AS s WHERE {same} AND s.{deleted}",
        f"INSERT INTO {target} ({names}) SELECT {names} FROM {staging} WHERE NOT {deleted} "
        f"ON CONFLICT ({', '.join(keys)}) {update}",
    ]
