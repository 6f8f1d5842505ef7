"""Connected components of an edge table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import staged


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node``, ``component`` (its smallest node) for every node of the edges ``a``, ``b``.

    Alternates two steps: each node's larger neighbours are tied to its smallest one, then each
    node's smaller neighbours to the smallest of them. The number of edges does not grow, and the
    rounds follow the logarithm of the longest path. Every round is written to the shared folder,
    which cuts lineage. A node with very many edges is reduced by partial minima and joined back.
    """
    now = staged(
        edges.where("a IS NOT NULL AND b IS NOT NULL")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    nodes = now.select(F.col("a").alias("node")).union(now.select("b")).distinct()
    mark = _mark(now)
    for _ in range(most_rounds):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("to"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("to").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("to"))
        small = large.join(least, "a")
        small = small.select("b", "to").where("b > to").union(least.select("a", "to"))
        now = staged(small.toDF("a", "b").distinct(), "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            stars = now.withColumnRenamed("a", "node").withColumnRenamed("b", "to")
            return nodes.join(stars, "node", "left").select("node", F.coalesce("to", "node").alias("component"))
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
