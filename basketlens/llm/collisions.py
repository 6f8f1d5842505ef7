"""Near duplicates among embeddings, by counting collisions of one-dimensional projections.

Vectors are compared when their labels are equal. Equal vectors are one node with a number of rows.
Nodes that lie within half the linking angle of one of them are gathered into a ball: all of its pairs
are links, so a ball of any size needs no pairs.

A projection is a sorted list of values along a random line, cut into cells by the signs of further
projections, so that a list stays short however many vectors there are. Per projection a ball is the
interval of its members' values in a cell, and two balls collide where their intervals are closer
than the window. Pairs of balls that collide in enough projections are verified: whole balls by the
angles of their centres, then members against centres, and only what stays open by vectors.

The numbers of projections and of collisions asked for follow from the recall wanted for a pair at
the threshold itself; closer pairs collide more often.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import fields_of, map_arrow, require, staged
from basketlens.llm.components import connected_components


@dataclass(frozen=True)
class Settings:
    """``recall``: of pairs exactly at the threshold. ``window``: half width of a window, in standard
    deviations of a projected difference at the threshold. ``cell``: nodes of the largest label in a
    cell, on average. ``rounds``: times that balls are gathered."""

    threshold: float = 0.93
    recall: float = 0.998
    window: float = 2.0
    cell: int = 24
    collisions: int = 2
    rounds: int = 3
    seed: int = 12

    @property
    def angle(self) -> float:
        return math.acos(self.threshold)

    @property
    def width(self) -> float:
        return self.window * math.sqrt(2 - 2 * self.threshold)


SLACK = 1e-7  # angles closer than this to a bound are decided by the vectors


def calibrated(settings: Settings, bits: int) -> int:
    """The number of projections in which a pair at the threshold collides often enough, with the
    recall wanted, when a cell is named by ``bits`` signs."""
    one = (1 - settings.angle / math.pi) ** bits * math.erf(settings.window / math.sqrt(2))
    n = settings.collisions
    while sum(math.comb(n, i) * one**i * (1 - one) ** (n - i) for i in range(settings.collisions)) > 1 - settings.recall:
        n += 1
    return n


# --- nodes -----------------------------------------------------------------------------------

SAME = ["label", "v"]


def usable() -> Column:
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)


def rows_of(vectors: DataFrame) -> DataFrame:
    return require(vectors, "vec_id", "embedding", "label").withColumn("v", F.col("embedding").cast("array<double>")).drop("embedding")


def nodes_of(rows: DataFrame) -> DataFrame:
    """``node``, ``label``, ``v``, ``u`` (unit vector), ``rows``, ``first`` per distinct vector of a label."""
    distinct = rows.where(usable()).groupBy(*SAME).agg(F.count("*").alias("rows"), F.min("vec_id").alias("first"))
    most = F.array_max(F.transform("v", F.abs))
    scaled = F.transform("v", lambda x: x / most)  # neither too large nor too small to be squared
    length = F.sqrt(F.aggregate("s", F.lit(0.0), lambda a, x: a + x * x))
    nodes = distinct.withColumn("s", scaled).withColumn("length", length)
    unit = F.transform("s", lambda x: x / F.col("length"))
    node, kind = F.monotonically_increasing_id().alias("node"), F.xxhash64("label").alias("kind")
    return staged(nodes.select(node, "label", kind, "v", unit.alias("u"), "rows", "first"), "nodes")


def dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def angle(cosine: Column) -> Column:
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))


def projected(vectors: DataFrame, carried: list[str], lists: int, bits: int, seed: int) -> DataFrame:
    """The ``carried`` columns (longs) with, for each of ``lists`` projections, the key of the cell and
    the value there.

    Lines follow from the seed and the dimension; a key holds the dimension too, so that only vectors of
    one dimension share a cell.
    """
    ddl = ", ".join(f"{c} long" for c in carried) + ", cells array<bigint>, at array<double>"
    schema = fields_of(ddl)

    def lines(dimension: int) -> tuple[np.ndarray, np.ndarray]:
        draw = np.random.default_rng([seed, dimension])
        return draw.standard_normal((lists * bits, dimension)), draw.standard_normal((lists, dimension))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            sizes = pc.list_value_length(batch.column("u")).to_numpy()
            for d in np.unique(sizes).tolist():
                rows = pa.array(np.flatnonzero(sizes == d))
                if d not in drawn:
                    drawn[d] = lines(d)
                u = np.asarray(batch.column("u").take(rows).flatten(), float).reshape(-1, d)
                signs = (u @ drawn[d][0].T >= 0).reshape(len(u), lists, bits)
                cells = (signs * weights).sum(2, dtype=np.int64) * (1 << 20) + d
                edges = pa.array(np.arange(len(u) + 1, dtype=np.int32) * lists)
                arrays = [pa.ListArray.from_arrays(edges, pa.array(x.ravel())) for x in (cells, u @ drawn[d][1].T)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in carried), *arrays], schema=schema)

    return map_arrow(vectors.select(*carried, "u"), run, ddl)


# --- balls -----------------------------------------------------------------------------------


def gathered(nodes: DataFrame, bits: int, settings: Settings) -> DataFrame:
    """``node``, ``ball`` (the node at its centre) and ``off`` (the angle to it).

    In every round each cell of a fresh set of signs names a leader, a ball that has members before
    others, and single nodes within half the linking angle of it join. A leader does not join.
    """
    reach = settings.angle / 2 - SLACK
    keys = projected(nodes, ["node"], settings.rounds, bits, settings.seed + 1).select("node", "cells")
    now = nodes.select("node", "label", "u").join(keys, "node").select(
        "*", F.col("node").alias("ball"), F.lit(0.0).alias("off"), F.lit(False).alias("full"))
    for r in range(settings.rounds):
        now = staged(now.withColumn("cell", F.col("cells")[r]), "balls")
        centres = now.where("node = ball")
        leaders = centres.groupBy("label", "cell").agg(F.min(F.struct(~F.col("full"), "node", "u")).alias("l"))
        leaders = leaders.select("label", "cell", F.col("l.node").alias("leader"), F.col("l.u").alias("to"))
        with_one = now.where("node = ball AND NOT full").join(leaders, ["label", "cell"]).where("node <> leader")
        joins = with_one.select("node", "leader", angle(dot("u", "to")).alias("a")).where(F.col("a") <= reach)
        joins = staged(joins, "joins")
        led = joins.select(F.col("leader").alias("node")).distinct().withColumn("leads", F.lit(True))
        # A leader of this round takes members, it cannot leave for another one's ball: cells are disjoint.
        now = now.join(joins, "node", "left").join(led, "node", "left").select(
            "node", "label", "u", "cells", F.coalesce("leader", "ball").alias("ball"), F.coalesce("a", "off").alias("off"),
            (F.col("full") | F.coalesce("leads", F.lit(False))).alias("full"))
    return staged(now.select("node", "ball", "off"), "members")


# --- collisions ------------------------------------------------------------------------------


def candidates(nodes: DataFrame, members: DataFrame, bits: int, settings: Settings) -> DataFrame:
    """Pairs ``a`` < ``b`` of balls that collide in enough projections."""
    lists = calibrated(settings, bits)
    placed = nodes.select("node", "kind", "u").join(members, "node")
    each = projected(placed, ["kind", "ball"], lists, bits, settings.seed)
    each = each.select("kind", "ball", F.posexplode(F.arrays_zip("cells", "at")).alias("list", "one"))
    # A ball is one row per cell, whatever its size: the interval of its members, from partial minima.
    spans = each.groupBy("kind", "list", F.col("one.cells").alias("cell"), "ball").agg(
        (F.min("one.at") - settings.width / 2).alias("low"), (F.max("one.at") + settings.width / 2).alias("high"))
    place = lambda x: F.floor(F.col(x) / settings.width)
    spans = spans.withColumns({"first": place("low"), "last": place("high")})
    dealt = staged(spans.withColumn("place", F.explode(F.sequence("first", "last"))).drop("last"), "spans")
    a, b = dealt.alias("a"), dealt.alias("b")
    near = (F.col("a.ball") < F.col("b.ball")) & (F.col("a.low") <= F.col("b.high")) & (F.col("b.low") <= F.col("a.high"))
    once = F.col("a.place") == F.greatest("a.first", "b.first")  # intervals can share several places
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("kind", "list", "cell", "place")]
    met = a.join(b, same + [near, once]).groupBy(F.col("a.ball").alias("a"), F.col("b.ball").alias("b")).agg(F.count("*").alias("n"))
    return met.where(F.col("n") >= settings.collisions).select("a", "b")


# --- links -----------------------------------------------------------------------------------


def links(nodes: DataFrame, members: DataFrame, pairs: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Links between balls: per node the rows it links with (``node``, ``links``), and pairs of balls with
    a link (``a``, ``b``)."""
    theta = settings.angle
    within = members.groupBy("ball").agg(F.max("off").alias("radius"), F.count("*").alias("nodes"))
    counted = members.join(nodes.select("node", "rows"), "node")
    balls = within.join(counted.groupBy("ball").agg(F.sum("rows").alias("rows")), "ball")
    balls = staged(balls.join(nodes.select(F.col("node").alias("ball"), "label", "u"), "ball"), "spheres")
    side = lambda s: balls.select(*(F.col(c).alias(f"{c}_{s}") for c in balls.columns))
    p = pairs.join(side("a"), pairs.a == F.col("ball_a")).join(side("b"), pairs.b == F.col("ball_b"))
    p = p.withColumn("cosine", dot("u_a", "u_b")).withColumn("apart", angle(F.col("cosine")))
    reach = F.col("radius_a") + F.col("radius_b")
    single = (F.col("nodes_a") == 1) & (F.col("nodes_b") == 1)
    state = (
        F.when(F.col("label_a") != F.col("label_b"), "none")  # of one hash only
        .when(single, F.when(F.col("cosine") >= settings.threshold, "all").otherwise("none"))
        .when(F.col("apart") + reach <= theta - SLACK, "all").when(F.col("apart") - reach > theta + SLACK, "none").otherwise("open")
    )
    p = staged(p.select("a", "b", state.alias("state")).where("state <> 'none'"), "verified")
    both = p.select(F.col("a").alias("x"), F.col("b").alias("y"), "state").union(p.select("b", "a", "state"))
    size = balls.select(F.col("ball").alias("y"), "rows")
    whole = both.where("state = 'all'").join(size, "y").groupBy(F.col("x").alias("ball")).agg(F.sum("rows").alias("links"))
    whole = whole.join(members, "ball").select("node", "links")

    # Members of one ball against the centre of the other.
    own = members.join(nodes.select("node", "u"), "node").select(F.col("ball").alias("x"), "node", "u")
    centre = balls.select(F.col("ball").alias("y"), F.col("u").alias("c"), "radius", "rows", "nodes")
    m = both.where("state = 'open'").drop("state").join(own, "x").join(centre, "y")
    m = m.withColumn("cosine", dot("u", "c")).withColumn("apart", angle(F.col("cosine")))
    decided = (
        F.when(F.col("nodes") == 1, F.when(F.col("cosine") >= settings.threshold, "all").otherwise("none"))
        .when(F.col("apart") + F.col("radius") <= theta - SLACK, "all").when(F.col("apart") - F.col("radius") > theta + SLACK, "none").otherwise("open")
    )
    m = staged(m.select("x", "y", "node", "rows", decided.alias("state")).where("state <> 'none'"), "verified")
    some = m.where("state = 'all'")

    # What is open still: vector against vector.
    mine = nodes.select("node", "u")
    theirs = members.join(nodes.select("node", "u", "rows"), "node").select(F.col("ball").alias("y"), F.col("u").alias("w"), "rows")
    last = m.where("state = 'open'").select("x", "y", "node").join(mine, "node").join(theirs, "y")
    last = staged(last.where(dot("u", "w") >= settings.threshold).groupBy("x", "y", "node").agg(F.sum("rows").alias("rows")), "verified")

    counts = whole.union(some.select("node", F.col("rows").alias("links"))).union(last.select("node", F.col("rows").alias("links")))
    edges = p.where("state = 'all'").select("a", "b")
    for more in (some, last):
        edges = edges.union(more.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))
    return counts.groupBy("node").agg(F.sum("links").alias("links")), edges.distinct()


def near_duplicates(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` per row of ``vectors``.

    A row whose id or label is null, or whose vector is null, empty, zero or holds null or non-finite
    components, links with nothing and is kept; so are vectors of different dimensions. Repeated rows are
    vectors of their own and link with each other. An empty table gives no rows.
    """
    rows = rows_of(vectors)
    nodes = nodes_of(rows)
    most = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits = min(40, max(0, math.ceil(math.log2(max(1, most / settings.cell)))))
    members = gathered(nodes, bits, settings)
    pairs = staged(candidates(nodes, members, bits, settings), "pairs")
    outer, edges = links(nodes, members, pairs, settings)

    tied = connected_components(edges).select(F.col("node").alias("ball"), F.col("component").alias("group"))
    all_of = members.join(nodes.select("node", "rows", "first"), "node").join(tied, "ball", "left").withColumn("group", F.coalesce("group", "ball"))
    all_of = staged(all_of.select("node", "ball", "group", "rows", "first"), "grouped")
    least = all_of.groupBy("group").agg(F.min("first").alias("component_id"))
    inner = all_of.groupBy("ball").agg(F.sum("rows").alias("inner"))
    of_node = all_of.join(least, "group").join(inner, "ball").join(outer, "node", "left").select(
        "node", "component_id", (F.col("inner") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    facts = nodes.select("node", *SAME).join(of_node, "node").drop("node")
    given = rows.select("vec_id", F.when(usable(), F.col("label")).alias("label"), F.when(usable(), F.col("v")).alias("v"))
    return given.join(facts, SAME, "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
