"""Documents whose n-gram sets have a Jaccard similarity above a threshold, by prefix-tree joins.

1. Shingles are put in one global order: those of few documents in the order of their hashes, the
   most frequent ones last. Any order gives right results; this one keeps frequent passages out of
   the beginnings of sets.
2. Two sets that are similar enough share several shingles among their first ones. Shingles that
   occur among the first ones of two sets tie these sets to a block; a set with too few such
   shingles has no partner and leaves. Its weakest ties go as well, as far as similar sets have more
   of them: else passages that unrelated sets share by chance tie ever larger blocks as a corpus grows.
3. Each block is joined in a task by a prefix tree: its sets are inserted one by one, shared
   beginnings are compared once for all sets below, and a subtree is left as soon as the lengths
   that remain cannot reach the overlap needed, or when all its sets are linked already.

Equal sets are one set throughout. Overlaps are counted in full, so no link is missed or guessed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from basketlens.llm.common import columns_of, fields_of, map_arrow, require, ship, staged
from basketlens.llm.components import connected_components
from basketlens.llm.shingles import BASE, WordHashes, mix, shingle_sets


@dataclass(frozen=True)
class Settings:
    """``evidence``: the share of a set that similar sets must have in common among their first
    shingles. ``frequent``: how many shingles are known as frequent; they are broadcast, 12 bytes
    each. ``count_bits``: of a hash, by which shingles are counted. ``block``: shingles of one
    task; the sets of a larger block are tied anew by all their shingles, and a block that stays
    larger is dealt out in pairs of parts. ``broadcast_rows``: up to so many ids of
    documents in blocks are broadcast, beyond that joined by a shuffle."""

    words: int = 5
    percent: int = 75
    evidence: float = 0.15
    frequent: int = 1 << 18
    frequent_from: int = 8
    count_bits: int = 32
    block: int = 3_000_000
    broadcast_rows: int = 2_000_000

    def overlap(self, n: int) -> int:
        """The least overlap of a set of ``n`` with any similar set."""
        return -(-self.percent * n // 100)

    def shared(self, n: int) -> int:
        """Shingles that a set of ``n`` shares, among the first ones, with any similar set of at
        least its size."""
        return max(1, int(self.evidence * n))

    def first(self, n: int) -> int:
        return n - self.overlap(n) + self.shared(n)


def _sets(batch: pa.RecordBatch, words: WordHashes, settings: Settings) -> Iterator[np.ndarray]:
    return shingle_sets(batch.column("text"), words, settings.words)


def _name(one: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a whole set, as two signed 64-bit integers."""
    h = xxhash.xxh3_128_digest(one.tobytes())
    return int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True)


def _rows(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


# --- the sets ----------------------------------------------------------------------------------

NAMED = "doc_id long, n_shingles long, s1 long, s2 long"


def named_sets(docs: DataFrame, settings: Settings, carried: tuple[str, ...] = ()) -> DataFrame:
    """Per row the size and the name of its set, and the ``carried`` columns, which are longs."""
    ddl = NAMED + "".join(f", {c} long" for c in carried)
    schema = fields_of(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            found = [(len(s), *_name(s)) for s in _sets(batch, words, settings)]
            if found:
                n, s1, s2 = zip(*found)
                yield _rows(schema, batch.column("doc_id"), n, s1, s2, *(batch.column(c) for c in carried))

    return map_arrow(docs, run, ddl)


# --- 1. the order ------------------------------------------------------------------------------

COUNTS = "part int, first long, steps binary, wide boolean, more_at binary, more binary"


def _packed_counts(values: np.ndarray, counts: np.ndarray) -> tuple[int, bytes, bool, bytes, bytes]:
    """Sorted distinct values by their steps, and the counts that are not one."""
    steps = np.diff(values)
    wide = bool(len(steps)) and int(steps.max()) >= 1 << 16
    more = np.flatnonzero(counts > 1)
    return (
        int(values[0]), steps.astype("<u8" if wide else "<u2").tobytes(), wide,
        more.astype("<u4").tobytes(), (counts[more] - 1).astype("<u4").tobytes(),
    )


def frequent_shingles(docs: DataFrame, settings: Settings) -> np.ndarray:
    """The shortened hashes of the most frequent shingles, by rising frequency.

    Counted over all documents: each task sends sorted, counted and packed hashes by range, so that
    a shingle arrives once per task however often it occurs.
    """
    spark = docs.sparkSession
    bits = settings.count_bits
    parts = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = [(k << bits) // parts for k in range(1, parts)]
    schema = fields_of(COUNTS)
    least = settings.frequent_from
    keep = settings.frequent

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        seen: set[bytes] = set()
        held: list[np.ndarray] = []
        size = 0

        def send() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            at = [0, *np.searchsorted(values, np.array(cuts, np.uint64)), len(values)]
            rows = [
                (k, *_packed_counts(values[a:z], counts[a:z])) for k, (a, z) in enumerate(zip(at, at[1:])) if z > a
            ]
            return _rows(schema, *zip(*rows))

        for batch in batches:
            for one in _sets(batch, words, settings):
                name = xxhash.xxh3_128_digest(one.tobytes())
                if len(one) and name not in seen:
                    seen.add(name)
                    held.append(one >> np.uint64(64 - bits))
                    size += len(one)
                    if size >= 1_200_000:
                        yield send()
                        held, size = [], 0
        if held:
            yield send()

    def total(key, table):
        values, counts = [], []
        for row in table.to_pylist():
            steps = np.frombuffer(row["steps"], "<u8" if row["wide"] else "<u2").astype(np.uint64)
            values.append(np.cumsum(np.concatenate([np.array([row["first"]], np.uint64), steps])))
            one = np.ones(len(values[-1]), np.int64)
            one[np.frombuffer(row["more_at"], "<u4")] += np.frombuffer(row["more"], "<u4")
            counts.append(one)
        values, counts = np.concatenate(values), np.concatenate(counts)
        order = np.argsort(values, kind="stable")
        values, counts = values[order], counts[order]
        fresh = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
        sums = np.add.reduceat(counts, fresh)
        some = sums >= least
        return pa.table({"shingle": values[fresh][some].astype(np.int64), "n": sums[some]})

    ship(spark)
    found = (
        map_arrow(docs.select("text"), count, COUNTS).groupBy("part").applyInArrow(total, "shingle long, n long")
        .orderBy(F.desc("n"), "shingle").limit(keep).select("shingle")
    ).toArrow()
    return found.column("shingle").to_numpy()[::-1].astype(np.int64).view(np.uint64)


# --- 2. blocks ---------------------------------------------------------------------------------

# ``meta`` holds the size of the set, and in its lower half how often the node is known to share, with
# the mark ``STANDS`` where it stands for further sets of its task.
FIRST = "shingle long, node long, meta long"
STANDS = 1 << 31
TOGETHER = 16  # so many sets of a task that share a shingle are tied there


def first_shingles(docs: DataFrame, frequent: np.ndarray, settings: Settings) -> DataFrame:
    """Rows (shingle, node) for the first shingles of each set.

    Where many sets of one task share a shingle they are tied there: one of them stands for all, and
    each other one shares a made-up shingle with it, sent once with the number of shingles it stands
    for. So a shingle that very many sets share arrives a bounded number of times per task.
    """
    spark = docs.sparkSession
    bits = np.uint64(64 - settings.count_bits)
    order = np.argsort(frequent)
    shared = spark.sparkContext.broadcast((frequent[order], order.astype(np.int64)))
    schema = fields_of(FIRST)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = shared.value
        words = WordHashes()
        seen: set[tuple[int, int]] = set()
        firsts: list[np.ndarray] = []
        nodes: list[int] = []
        sizes: list[int] = []
        held = 0

        def send() -> Iterator[pa.RecordBatch]:
            each = np.array([len(f) for f in firsts])
            node, size = np.repeat(np.array(nodes, np.int64), each), np.repeat(np.array(sizes, np.int64), each)
            shingle = np.concatenate(firsts).view(np.int64)
            by = np.lexsort((node, shingle))
            shingle, node, size = shingle[by], node[by], size[by]
            begins = np.append(True, shingle[1:] != shingle[:-1])
            group = np.cumsum(begins) - 1
            many = (np.bincount(group) >= TOGETHER)[group]
            sent = begins | ~many
            yield _rows(schema, shingle[sent], node[sent], (size[sent] << 32) + many[sent] * (STANDS + 1))
            if not sent.all():
                first = np.flatnonzero(begins)[group]
                pairs = np.stack([node, node[first], size, size[first]], axis=1)[~sent]
                pairs, n = np.unique(pairs, axis=0, return_counts=True)
                one, to, one_size, to_size = np.ascontiguousarray(pairs.T)
                tie = mix(one.view(np.uint64) * BASE + to.view(np.uint64)).view(np.int64)
                yield _rows(schema, np.concatenate([tie, tie]), np.concatenate([one, to]),
                            np.concatenate([(one_size << 32) + n, to_size << 32]))

        for batch in batches:
            for one in _sets(batch, words, settings):
                if not len(one):
                    continue
                name = _name(one)
                if name in seen:
                    continue
                seen.add(name)
                if len(known):
                    short = one >> bits
                    at = np.searchsorted(known, short)
                    at[at == len(known)] = 0
                    common = known[at] == short
                    late = np.argsort(rank[at[common]], kind="stable")
                    ordered = np.concatenate([one[~common], one[common][late]])
                else:
                    ordered = one
                firsts.append(ordered[: settings.first(len(one))])
                nodes.append(name[0])
                sizes.append(len(one))
                held += len(firsts[-1])
                if held >= 600_000:
                    yield from send()
                    firsts, nodes, sizes, held = [], [], [], 0
        if firsts:
            yield from send()

    return map_arrow(docs.select("text"), run, FIRST)


def candidate_blocks(docs: DataFrame, named: DataFrame, settings: Settings) -> DataFrame:
    """``node``, ``block``, ``size`` of the sets that may have a similar one: only sets of one block
    can be similar. The node is half of a set's name; two sets with equal halves share a block.

    Sets of a large block meet again by all their shingles. Of these a set shares most with a similar
    one, while those that chance passages had tied share few, and leave.
    """
    blocks = _tied(docs, frequent_shingles(docs, settings), settings)
    large = blocks.where(F.col("total") > settings.block).select("node")
    if not large.limit(1).count():
        return blocks
    chosen = _texts_of(docs, named, large, settings)
    anew = _tied(chosen, np.empty(0, np.uint64), replace(settings, evidence=settings.percent / 100))
    # Other texts under a chosen doc_id are not of these blocks.
    anew = anew.join(large, "node", "left_semi")
    return staged(blocks.where(F.col("total") <= settings.block).unionByName(anew), "blocks")


def _tied(docs: DataFrame, frequent: np.ndarray, settings: Settings) -> DataFrame:
    """Blocks of the sets that share enough of their first shingles.

    Two similar sets share a number of them, and a single one is enough to tie both to a block. So each
    set drops its weakest ties, those to the nodes with which it shares least, up to less than half of
    that number: one shingle at least stays tied on both sides. What drops out is chance.
    """
    rows = first_shingles(docs, frequent, settings)
    by_shingle = W.partitionBy("shingle").orderBy("node")
    tied = F.first("node").over(by_shingle)
    follows = F.lead("node").over(by_shingle)
    known = F.col("meta").bitwiseAND(F.lit(STANDS - 1))
    found = rows.withColumns({"to": tied, "follows": follows}).select(
        "node", "to", F.shiftright("meta", 32).alias("size"),
        F.when(known > 0, known)
        .when((F.col("to") != F.col("node")) | (F.col("follows") != F.col("node")), 1).otherwise(0).alias("n"),
        (F.col("meta").bitwiseAND(F.lit(STANDS)) > 0).alias("stands"),
    ).where("n > 0")
    edges = staged(found.groupBy("node", "to").agg(
        F.sum("n").alias("n"), F.max("size").alias("size"), F.max("stands").alias("stands")), "ties")
    # A similar set may be smaller, down to the least overlap; then fewer shingles are shared.
    smaller = F.ceil(F.col("size") * settings.percent / 100)
    needed = F.greatest(F.lit(1), F.floor(F.lit(settings.evidence) * smaller - F.lit(1e-6)))
    likely = (
        edges.groupBy("node").agg(F.sum("n").alias("n"), F.max("size").alias("size"))
        .where(F.col("n") >= needed).select("node", "size")
    )
    likely = staged(likely, "likely")
    # What stands for further sets ties those as well, likely itself or not, and is never dropped.
    weakest = W.partitionBy("node").orderBy("n", "to").rowsBetween(W.unboundedPreceding, 0)
    own = (
        edges.where("node <> to AND NOT stands").join(likely.select("node"), "node", "left_semi")
        .withColumn("dropped", F.sum("n").over(weakest)).where(F.col("dropped") > F.floor((needed - 1) / 2))
    )
    ties = own.select("node", "to").union(edges.where("node <> to AND stands").select("node", "to"))
    labels = connected_components(ties.select(F.col("node").alias("a"), F.col("to").alias("b")))
    blocks = likely.join(labels, "node").select("node", F.col("component").alias("block"), "size")
    large = blocks.groupBy("block").agg(F.count("*").alias("sets"), F.sum("size").alias("total")).where("sets > 1")
    return staged(blocks.join(large, "block"), "blocks")


# --- 3. the tree -------------------------------------------------------------------------------


class Node:
    """A run of shingles, in order, that all sets below share."""

    __slots__ = ("run", "children", "sets", "longest", "least", "most", "label")

    def __init__(self, run: np.ndarray):
        self.run = run
        self.children: dict[int, Node] = {}
        self.sets: list[int] = []  # sets that end here
        self.longest = 0  # shingles below the run, at most
        self.least, self.most = 1 << 60, 0  # sizes of sets at or below
        self.label = -1  # a set of the one component of all sets below, or -2


class PrefixTree:
    """Links sets with a similarity of at least ``percent``, as they are added."""

    def __init__(self, percent: int):
        self.percent = percent
        self.root = Node(np.empty(0, np.int32))
        self.parent: list[int] = []
        self.sizes: list[int] = []

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def add(self, shingles: np.ndarray, size: int, held: np.ndarray) -> None:
        """``shingles``: those that other sets may share, as ranks in rising order; ``size`` counts
        all. ``held`` is a mask over all ranks, empty before and after."""
        me = len(self.parent)
        self.parent.append(me)
        self.sizes.append(size)
        held[shingles] = True
        self._link(me, shingles, size, held)
        held[shingles] = False
        self._insert(me, shingles, size)

    def _link(self, me: int, shingles: np.ndarray, size: int, held: np.ndarray) -> None:
        percent, total = self.percent, 100 + self.percent
        stack = [(self.root, 0)]
        while stack:
            node, overlap = stack.pop()
            if 100 * node.most < percent * size or percent * node.least > 100 * size:
                continue  # all sets below are too small or too large
            if node.label >= 0 and self.find(node.label) == self.find(me):
                continue
            run = node.run
            left = len(shingles)
            if len(run):
                overlap += int(np.count_nonzero(held[run]))
                left -= int(np.searchsorted(shingles, run[-1], side="right"))
            least = max(node.least, -(-percent * size // 100))
            if total * (overlap + min(left, node.longest)) < percent * (size + least):
                continue
            for other in node.sets:
                if total * overlap >= percent * (size + self.sizes[other]):
                    a, b = self.find(other), self.find(me)
                    self.parent[max(a, b)] = min(a, b)
            # Children that go on with a shingle of this set are looked at first.
            far, near = [], []
            for shingle, child in node.children.items():
                (near if held[shingle] else far).append((child, overlap))
            stack += far
            stack += near

    def _insert(self, me: int, shingles: np.ndarray, size: int) -> None:
        node, at = self.root, 0
        while True:
            self._pass(node, me, size, len(shingles) - at)
            if at == len(shingles):
                node.sets.append(me)
                return
            child = node.children.get(int(shingles[at]))
            if child is None:
                child = node.children[int(shingles[at])] = Node(shingles[at:].copy())
                self._pass(child, me, size, 0)
                child.sets.append(me)
                return
            n = min(len(child.run), len(shingles) - at)
            differ = np.flatnonzero(child.run[:n] != shingles[at : at + n])
            same = int(differ[0]) if len(differ) else n
            if same < len(child.run):
                upper = Node(child.run[:same])
                upper.longest = child.longest + len(child.run) - same
                upper.least, upper.most, upper.label = child.least, child.most, child.label
                child.run = child.run[same:]
                upper.children[int(child.run[0])] = child
                node.children[int(shingles[at])] = child = upper
            node, at = child, at + same

    def _pass(self, node: Node, me: int, size: int, below: int) -> None:
        node.longest = max(node.longest, below)
        node.least, node.most = min(node.least, size), max(node.most, size)
        if node.label == -1:
            node.label = me
        elif node.label >= 0 and self.find(node.label) != self.find(me):
            node.label = -2


def linked(sets: list[np.ndarray], percent: int) -> list[int]:
    """For each set the first set of its component."""
    each = [len(s) for s in sets]
    values, place, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(-n, kind="stable")  # frequent ones first, so that similar sets share their beginnings
    rank = np.empty(len(values), np.int32)
    rank[order] = np.arange(len(values), dtype=np.int32)
    alone = int((n > 1).sum())  # ranks from here on are in one set only and cannot match
    held = np.zeros(len(values) + 1, bool)
    tree = PrefixTree(percent)
    for ranks, size in zip(np.split(rank[place], np.cumsum(each)[:-1]), each):
        ranks = np.sort(ranks)
        tree.add(ranks[: np.searchsorted(ranks, alone)], size, held)
    return [tree.find(i) for i in range(len(sets))]


LINKED = "s1 long, s2 long, l1 long, l2 long"


def _texts_of(docs: DataFrame, named: DataFrame, nodes: DataFrame, settings: Settings) -> DataFrame:
    """``text`` of one row at least per set of ``nodes``, and of the rows that share its doc_id."""
    first = named.groupBy("s1", "s2").agg(F.min("doc_id").alias("doc"))
    wanted = staged(first.join(nodes.select(F.col("node").alias("s1")), "s1", "left_semi").select("doc").distinct(), "wanted")
    if wanted.count() <= settings.broadcast_rows:
        wanted = F.broadcast(wanted)
    return docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("doc")), "left_semi").select("text")


def _block_links(docs: DataFrame, named: DataFrame, blocks: DataFrame, settings: Settings) -> DataFrame:
    """Sets of blocks with the first set (``l1``, ``l2``) of their component within each task."""
    spark = docs.sparkSession
    chosen = _texts_of(docs, named, blocks, settings)
    sets_schema = "s1 long, s2 long, shingles binary"
    fields, out = fields_of(sets_schema), fields_of(LINKED)

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            rows, held = [], 0
            for one in _sets(batch, words, settings):
                rows.append((*_name(one), one.astype("<u8").tobytes()))
                held += 8 * len(one)
                if held > 8 << 20:
                    yield _rows(fields, *zip(*rows))
                    rows, held = [], 0
            if rows:
                yield _rows(fields, *zip(*rows))

    percent = settings.percent

    def join(key, table):
        names = list(dict.fromkeys(zip(table.column("s1").to_pylist(), table.column("s2").to_pylist())))
        by_name = dict(zip(zip(table.column("s1").to_pylist(), table.column("s2").to_pylist()), table.column("shingles")))
        names.sort(key=lambda n: (by_name[n].as_buffer().size, n))
        sets = [np.frombuffer(by_name[n].as_buffer(), "<u8") for n in names]
        to = linked(sets, percent)
        rows = [(*names[i], *names[k]) for i, k in enumerate(to)]
        return pa.Table.from_batches([_rows(out, *zip(*rows))])

    dealt_blocks = blocks.withColumn("s1", F.col("node"))
    if blocks.count() <= settings.broadcast_rows:
        dealt_blocks = F.broadcast(dealt_blocks)
    # A block above the limit is cut into parts, and every two parts meet in a task.
    parts = F.when(F.col("total") <= settings.block, F.lit(1)).otherwise(F.ceil(2 * F.col("total") / settings.block)).cast("int")
    dealt = (
        map_arrow(chosen, sets_of, sets_schema)
        .join(dealt_blocks, "s1").withColumn("parts", parts)
        .withColumn("part", F.pmod("s2", F.col("parts").cast("long")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .where((F.col("parts") == 1) | (F.col("other") != F.col("part")))
        .select("block", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "s1", "s2", "shingles")
    )
    ship(spark)
    return dealt.groupBy("block", "low", "high").applyInArrow(join, LINKED)


def components(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` per row: the smallest doc_id that links reach.

    Rows with null text or without words have an empty set, are linked with nothing and are their
    own component. Equal rows and rows with equal doc_id are kept, each with the component of its
    own text; a component of null ids alone is null. Further columns are ignored, an empty table
    gives no rows, and a text shorter than a shingle is one shingle as a whole.
    """
    docs = require(docs, "doc_id", "text")
    named = staged(named_sets(docs, settings), "sets")
    whole = _classes(docs, named, F.min("doc_id"), settings)
    return (
        named.join(whole, ["s1", "s2"], "left")
        .select("doc_id", "n_shingles",
                F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))
    )


def _classes(docs: DataFrame, named: DataFrame, first: Column, settings: Settings) -> DataFrame:
    """Per set ``s1``, ``s2`` that is not empty ``least``, the smallest of what ``first`` takes from the rows of each set
    of its component."""
    blocks = candidate_blocks(docs, named, settings)
    links = staged(_block_links(docs, named, blocks, settings), "links").where("s1 <> l1 OR s2 <> l2")
    text = lambda a, b: F.concat_ws(":", F.col(a), F.col(b))
    ties = links.select(text("s1", "s2").alias("node"), text("l1", "l2").alias("component"))
    if blocks.where(F.col("total") > settings.block).limit(1).count():
        ties = connected_components(ties.select(F.col("node").alias("a"), F.col("component").alias("b")))
    firsts = named.where("n_shingles > 0").groupBy("s1", "s2").agg(first.alias("first"))
    members = ties.union(ties.select("component", "component")).distinct()
    whole = (
        members.join(firsts.withColumn("node", text("s1", "s2")), "node")
        .select("s1", "s2", "component", "first")
    )
    least = whole.groupBy("component").agg(F.min("first").alias("least"))
    known = whole.join(least, "component").select("s1", "s2", "least")
    whole = firsts.join(known, ["s1", "s2"], "left").select("s1", "s2", F.coalesce("least", "first").alias("least"))
    # Written, so that both sides of the last join are plain shuffles: a set that very many rows
    # have can then be split over tasks.
    return staged(whole, "classes")


def keep_one(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest doc_id, of several texts with that
    id the one with the smallest hash.

    A document is its id and its text, so a text that shares its id with a copy stays, and of repeated
    rows one stays, of empty texts as well. Rows without an id come after all others: one stays where no
    row with an id is similar.
    """
    texts = docs.select("doc_id", "text")
    named = named_sets(texts.withColumn("text_hash", F.xxhash64("text")), settings, ("text_hash",))
    named = staged(named, "sets")
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    whole = _classes(texts, named, F.min(key), settings)
    same = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_hash") == F.col("least.text_hash"))
    copies = named.where("n_shingles > 0").join(whole, ["s1", "s2"]).where(~same).select("doc_id", "text_hash").distinct()
    copies = staged(copies, "copies")
    repeated = named.groupBy("doc_id", "text_hash").count().where("count > 1").select("doc_id", "text_hash")
    repeated = staged(_without(repeated, copies, F.col("doc_id"), F.col("text_hash"), settings), "repeated")
    rows = docs.select(F.struct(*(F.col(f"`{n}`") for n in docs.columns)).alias("doc"))
    its_id, its_hash = F.col("doc.doc_id"), F.xxhash64("doc.text")
    kept = _without(rows, copies, its_id, its_hash, settings)
    if repeated.limit(1).count():
        # Only rows that have a repeat are gathered by it, one per task before the shuffle.
        others = [f.name for f in docs.schema.fields if not isinstance(f.dataType, T.MapType)]
        nth = F.row_number().over(W.partitionBy("id", "hash").orderBy("row"))
        again = _without(kept, repeated, its_id, its_hash, settings, "left_semi").select(
            "doc", its_id.alias("id"), its_hash.alias("hash"), F.xxhash64(*(F.col(f"doc.`{n}`") for n in others)).alias("row"))
        once = again.withColumn("nth", nth).where("nth = 1").select("doc")
        kept = _without(kept, repeated, its_id, its_hash, settings).union(once)
    return kept.select(*columns_of(docs))


def _without(rows: DataFrame, documents: DataFrame, id_: Column, hash_: Column, settings: Settings, how: str = "left_anti") -> DataFrame:
    """``rows`` whose id and text hash are not (or, as a semi join, are) among ``documents``."""
    gone = documents.select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"))
    if documents.count() <= settings.broadcast_rows:
        gone = F.broadcast(gone)
    return rows.join(gone, id_.eqNullSafe(F.col("gone_id")) & (hash_ == F.col("gone_hash")), how)
