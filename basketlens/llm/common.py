"""Helpers that several operators share: staged tables, ordered running totals, batches of text."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from basketlens.session import scratch, staged

__all__ = ["let", "scratch", "staged", "running_total", "text_slices", "require", "with_changes", "columns_of"]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application.

    The archive is read by the driver alone, which serves it to the executors.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def map_arrow(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once per row however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def require(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that further ones cannot clash with those of an operator."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*(F.col(f"`{n}`") for n in names))


def with_changes(docs: DataFrame, changes: DataFrame, small: bool) -> DataFrame:
    """Every row as a struct ``doc``, with the row of ``changes`` for its doc_id and text hash, if there is
    one, as ``change``. As structs, columns of either side cannot clash. ``small`` says that the
    table of changes has been found small enough to broadcast; otherwise the join shuffles."""
    left = docs.select(F.struct(*(F.col(f"`{n}`") for n in docs.columns)).alias("doc"))
    right = changes.select(F.struct("*").alias("change"))
    same = F.col("doc.doc_id").eqNullSafe(F.col("change.doc_id")) & (F.xxhash64("doc.text") == F.col("change.text_hash"))
    return left.join(F.broadcast(right) if small else right, same, "left")


def columns_of(docs: DataFrame, text: Column | None = None, changed: Column | None = None) -> list[Column]:
    """The columns of ``docs`` out of ``doc``, with ``text`` in place of the text and its length in
    n_chars where ``changed``."""
    new = {}
    if text is not None:
        new["text"] = F.when(changed, text).otherwise(F.col("doc.text"))
        if "n_chars" in docs.columns:
            kind = docs.schema["n_chars"].dataType
            new["n_chars"] = F.when(changed, F.length(text).cast(kind)).otherwise(F.col("doc.n_chars"))
    return [new.get(n, F.col(f"doc.`{n}`")).alias(n) for n in docs.columns]


def running_total(df: DataFrame, order: str, value: str, into: str) -> DataFrame:
    """Sum of ``value`` over all rows before each, by ``order``.

    Meant for one row per file or partition: all of them meet in one task.
    """
    before = W.orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn(into, F.coalesce(F.sum(value).over(before), F.lit(0).cast("long")))


def text_slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts have at most ``most`` bytes; a longer text is a slice of its own.

    Bounds the memory of a task, not what is read of a text.
    """
    texts = batch.column(column)
    start, held = 0, 0
    for i, size in enumerate(pc.binary_length(texts).to_pylist()):
        size = size or 0
        if i > start and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if batch.num_rows > start:
        yield batch.slice(start)


def fields_of(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T._parse_datatype_string(ddl))
