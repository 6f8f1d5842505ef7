"""Top-k, over a whole frame and per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, metric: str, ties: Sequence[str], k: int) -> DataFrame:
    """The ``k`` largest rows; ``ties`` decide among equals. Each task keeps ``k`` rows only."""
    return df.orderBy(F.desc(metric), *ties).limit(k)


def top_k_per_group(
    df: DataFrame, group: Sequence[str], metric: str, ties: Sequence[str], k: int
) -> DataFrame:
    """Rank 1..k in every group.

    The rank filter lets Spark cut each group to ``k`` rows in every task before the shuffle, so
    a group holding most of the data still sends only ``k`` rows per task.
    """
    order = Window.partitionBy(*group).orderBy(F.desc(metric), *ties)
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
