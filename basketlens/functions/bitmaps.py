"""Exact sets of integers as 64-bit words: one row per 64 neighbouring values that occur."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_words(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """The distinct values of each group as ``word`` and ``bits``, or-ed in every task before the shuffle.
    Nulls are left out, as by count(distinct). Words of several frames unite by ``united``."""
    number = F.col(value).cast("bigint")
    placed = df.where(F.col(value).isNotNull()).select(
        *by, F.shiftright(number, 6).alias("word"), number.bitwiseAND(63).cast("int").alias("place"))
    return placed.groupBy(*by, "word").agg(F.bit_or(F.expr("shiftleft(1L, place)")).alias("bits"))


def united(words: DataFrame, by: list[str]) -> DataFrame:
    return words.groupBy(*by, "word").agg(F.bit_or("bits").alias("bits"))


def members(bits: Column | str = "bits") -> Column:
    """Aggregate: how many values the words of a group hold, after they were united."""
    return F.sum(F.bit_count(bits)).cast("bigint")
