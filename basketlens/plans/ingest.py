"""Snapshots of database tables into the lake, each table on its own."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from basketlens.operators.cleaning import clean_table, misfit_counts, without_columns
from basketlens.sinks.marts import write_mart

# Columns that never reach the lake.
SECRET_COLUMNS = ("password",)

Reader = Callable[[], DataFrame | None]


@dataclass(frozen=True)
class TableResult:
    """``misfits``: by column, values that the declared type could not hold."""

    table_name: str
    status: str
    row_count: int = 0
    error: str | None = None
    misfits: Mapping[str, int] = field(default_factory=dict)


def snapshot_table(
    name: str, read: Reader, schema: T.StructType, destination: str, allow_misfits: bool = False
) -> TableResult:
    """Read, clean to the declared schema and replace the lake table. An empty table leaves the
    lake as it is; a failure is a result, not an exception.

    The former table goes only when the new one is complete: a source that fails midway, or a value
    that does not fit its type, leaves it as it was. With ``allow_misfits`` such values become null
    and are counted; without, they are counted only once one has stopped the write.
    """
    source, misfits = None, {}
    try:
        source = read()
        if source is None or source.isEmpty():
            return TableResult(name, "SKIPPED")
        if allow_misfits:
            misfits = _misfits(source, schema)
        cleaned = without_columns(clean_table(source, schema, strict=not allow_misfits), *SECRET_COLUMNS)
        return TableResult(name, "SUCCESS", write_mart(cleaned, f"{destination}/{name}"), misfits=misfits)
    except Exception as failure:  # the other tables go on
        if source is not None and not allow_misfits:
            try:
                misfits = _misfits(source, schema)
            except Exception:  # the source itself fails, which the error says
                misfits = {}
        return TableResult(name, "FAILED", error=str(failure), misfits=misfits)


def _misfits(source: DataFrame, schema: T.StructType) -> dict[str, int]:
    """One row per declared column, so the list is short."""
    return {r["column_name"]: r["misfits"] for r in misfit_counts(source, schema).collect() if r["misfits"]}


def snapshot_tables(
    readers: Mapping[str, Reader], schemas: Mapping[str, T.StructType], destination: str,
    allow_misfits: bool = False,
) -> list[TableResult]:
    return [snapshot_table(n, read, schemas[n], destination, allow_misfits) for n, read in readers.items()]


def results_frame(spark: SparkSession, results: list[TableResult]) -> DataFrame:
    return spark.createDataFrame(
        [(r.table_name, r.status, r.row_count) for r in results],
        "table_name STRING, status STRING, row_count BIGINT",
    )
