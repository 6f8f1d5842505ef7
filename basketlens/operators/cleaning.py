"""Cleaning of loosely typed tables to their declared types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for a missing value where a loosely typed tool wrote the table.
NULL_TEXTS = ("nan", "None")


def clean_text(col: Column, null_text: str | None = None, stand_ins: Sequence[str] = ()) -> Column:
    """Text as it is. ``stand_ins`` are texts that mean null, ``null_text`` is put for null; neither
    is changed unless asked for."""
    text = col.cast("string")
    kept = F.when(~text.isin(*stand_ins), text) if stand_ins else text
    return kept if null_text is None else F.coalesce(kept, F.lit(null_text))


def clean_whole_number(col: Column, declared: T.DataType) -> Column:
    """Whole numbers, also where nulls had turned the column into floats (``7.0``); a fraction
    is not a value of the declared type and becomes null."""
    number = col.try_cast("decimal(38,6)")
    return F.when(number == F.floor(number), number.try_cast(declared))


def clean_column(
    col: Column, declared: T.DataType, null_text: str | None = None, stand_ins: Sequence[str] = ()
) -> Column:
    """Value of the declared type, or null where there is none. Timestamps in text keep their
    instant when they name a zone and are read as UTC (the session zone) when they do not."""
    if isinstance(declared, T.StringType):
        return clean_text(col, null_text, stand_ins)
    if isinstance(declared, T.IntegralType):
        return clean_whole_number(col, declared)
    return col.try_cast(declared)


def misfit(col: Column, declared: T.DataType, stand_ins: Sequence[str] = NULL_TEXTS) -> Column:
    """Whether a value is there that the declared type cannot hold: out of range, a fraction of a
    whole number, text that is no number or date. Cleaning makes null of it."""
    if isinstance(declared, T.StringType):
        return F.lit(False)
    text = F.trim(col.cast("string"))
    present = F.coalesce((text != "") & ~text.isin(*stand_ins), F.lit(False))
    return present & clean_column(col, declared).isNull()


def clean_table(
    df: DataFrame, declared: T.StructType, null_text: str | None = None, stand_ins: Sequence[str] = (),
    strict: bool = False,
) -> DataFrame:
    """One projection to the declared types. Absent columns become nulls of their type; with
    ``strict`` a value that does not fit its type fails the job that meets it.

    Types come from the declaration and never from the values, so phone numbers keep their
    leading zeros and a column that happens to be all null keeps its type.
    """

    def column(f: T.StructField) -> Column:
        if f.name not in df.columns:
            return F.lit(None).cast(f.dataType)
        value = F.col(f"`{f.name}`")
        cleaned = clean_column(value, f.dataType, null_text, stand_ins)
        if not strict or isinstance(f.dataType, T.StringType):
            return cleaned
        refused = F.raise_error(F.lit(f"{f.name} holds a value that is no {f.dataType.simpleString()}"))
        return F.when(misfit(value, f.dataType), refused.cast(f.dataType)).otherwise(cleaned)

    return df.select(*[column(f).alias(f.name) for f in declared.fields])


def misfit_counts(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Values per column that the declared type cannot hold, from one pass over the table."""
    fields = [f for f in declared.fields if f.name in df.columns]
    counted = df.agg(*[F.count_if(misfit(F.col(f"`{f.name}`"), f.dataType)).alias(f"n{i}") for i, f in enumerate(fields)])
    cells = F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.col(f"n{i}").alias("misfits")) for i, f in enumerate(fields)
    ])
    return counted.select(F.inline(cells))


def without_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns that must not reach the lake, such as passwords."""
    return df.drop(*names)


def null_profile(df: DataFrame) -> DataFrame:
    """Null count of every column, from one pass over the table."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)]
    )
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("non_nulls"))
            for i, c in enumerate(df.columns)
        ]
    )
    return counted.select("_rows", F.inline(cells)).select(
        "column_name",
        (F.col("_rows") - F.col("non_nulls")).alias("nulls"),
        ((F.col("non_nulls") == 0) & (F.col("_rows") > 0)).alias("all_null"),
    )
