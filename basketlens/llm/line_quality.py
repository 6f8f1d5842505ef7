"""Quality rules: lines that many documents of one host share, and documents made of such lines.

Lines are normalised and hashed. A line found in too large a share of its host's documents is
removed, save from the first document that has it, and a document left with too small a share of
its words is rejected. As the limit is a share, a document is judged alike in a small and in a large
host; lines of few letters, such as numbers or closing brackets, are common anywhere and stay. Documents with equal text count once, so that copies, which are a matter
of near-duplicate search, do not make their own lines look like boilerplate.

Only DataFrame functions are used. A window of three words is compared by a 64-bit hash first, and
what seems to repeat is compared word by word.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import columns_of, let, require, staged, with_changes

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
NO_LETTER = r"[\x00-\x40\x5B-\x60\x7B-\x7F]"


@dataclass(frozen=True)
class Limits:
    """A line is removed that is in more than ``percent`` of a host's documents with words, in more than
    ``documents`` of them, and has ``letters`` letters or more once normalised. ``left``: a document
    that keeps a smaller share of its words is rejected."""

    words: int = 50
    repeat_percent: int = 50
    percent: int = 2
    documents: int = 10
    letters: int = 16
    left: float = 0.2
    broadcast_bytes: int = 32 << 20


def _shift(direction: str, value: Column, bits: Column) -> Column:
    return F.call_function(f"shift{direction}", value, bits)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")


def lines_of(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))


def repeat_words(words: Column) -> Column:
    """Words inside windows of three words that are found twice or more, all occurrences counted."""

    def covered(places: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        step = lambda a, p: F.struct((a.n + F.least(F.lit(3), p - a.last)).alias("n"), p.alias("last"))
        return F.aggregate(F.sort_array(places), start, step, lambda a: a.n)

    def exact(w: Column, places: Column) -> Column:
        """Of places whose hashes seem to repeat, those whose words do."""
        named = F.sort_array(F.transform(places, lambda p: F.struct(
            F.concat_ws(" ", w[p], w[p + 1], w[p + 2]).alias("words"), p.alias("place"))))
        return let(named, lambda a: F.transform(
            F.filter(a, lambda x, j: x.words.eqNullSafe(F.get(a, j - 1).words) | x.words.eqNullSafe(F.get(a, j + 1).words)),
            lambda x: x.place))

    def seeming(w: Column, hashes: Column) -> Column:
        """Hashes shortened to make room for their place, sorted as plain longs."""
        bits = F.length(F.bin(F.size(hashes)))
        keys = F.sort_array(F.transform(hashes, lambda h, i: _shift("left", _shift("right", h, bits), bits).bitwiseOR(i.cast("long"))))
        high = lambda x: _shift("right", x, bits)
        return let(keys, lambda k: F.transform(
            F.filter(k, lambda x, j: high(x).eqNullSafe(high(F.get(k, j - 1))) | high(x).eqNullSafe(high(F.get(k, j + 1)))),
            lambda x: (x - _shift("left", high(x), bits)).cast("int")))

    def count(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))
        some = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            covered(exact(w, seeming(w, h)))))
        return F.when(F.size(w) < 4, F.lit(0)).otherwise(some)

    return let(words, count)


def normal_line(line: Column) -> Column:
    """One form for lines that differ in case, spacing or digits."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(line)), r"\s+", " "), "[0-9]+", "0")


def lettered(line: Column, least: int) -> Column:
    """Whether a line has as many letters, which are all characters but the others of ASCII."""
    return line.rlike(f"^(?:{NO_LETTER}*+[^{NO_LETTER[1:-1]}]){{{least}}}")


def base_columns(limits: Limits = Limits()) -> dict[str, Column]:
    """Counts of the base rules on a column ``text``; null counts as empty."""
    text = F.coalesce("text", F.lit(""))
    counted = let(words_of(text), lambda w: F.struct(F.size(w).alias("n"), repeat_words(w).alias("repeat")))
    lines = let(lines_of(text), lambda x: F.size(x) - F.size(F.array_distinct(x)))
    return {
        "counted": counted,
        "word_chars": F.length(F.regexp_replace(text, f"{SPACE}+", "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long"),
        "n_dup_lines": lines.cast("long"),
    }


def with_base(df: DataFrame, limits: Limits = Limits()) -> DataFrame:
    columns = base_columns(limits)
    n, repeat = F.col("counted.n").cast("long"), F.col("counted.repeat").cast("long")
    return (
        df.withColumns(columns)
        .withColumn("n_words", n)
        .withColumn("n_repeat_words", repeat)
        .withColumn("base_failed", (n < limits.words) | (100 * repeat > limits.repeat_percent * n))
        .drop("counted")
    )


def judged(docs: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """Per row: base counts, ``base_failed``, ``kept``, and the hashes of lines to remove.

    Null texts are empty and fail the base rules; null hosts are one host; equal rows get equal
    verdicts; an empty table gives no rows. Further columns are left out.
    """
    rows = require(docs, "doc_id", "text", *({host} - {"doc_id", "text"})).withColumn("host", F.col(host))
    normal = F.transform(
        lines_of(F.coalesce("text", F.lit(""))),
        lambda line: F.struct(normal_line(line).alias("line"), F.size(words_of(line)).alias("words")),
    )
    hashed = F.transform(
        F.filter(normal, lambda x: lettered(x.line, limits.letters)),
        lambda x: F.struct(F.xxhash64(x.line).alias("line"), x.words.alias("words")),
    )
    stats = (
        with_base(rows.withColumn("text_hash", F.xxhash64("text")), limits)
        .withColumn("lines", hashed)
        .withColumn("row", F.monotonically_increasing_id())
        .select("row", "doc_id", "host", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                "n_repeat_words", "base_failed", "lines")
    )
    stats = staged(stats, "line-quality")

    each = stats.select("row", "doc_id", "host", "text_hash", F.explode("lines").alias("one"))
    each = each.select("row", "doc_id", "host", "text_hash", "one.*")
    # Copies first, so that a line of a text with many copies arrives once per task and text.
    texts = each.groupBy("host", "line", "text_hash").agg(F.min("doc_id").alias("first"))
    hosts = (
        stats.where("n_words > 0").select("host", "text_hash").distinct()
        .groupBy("host").agg(F.count("*").alias("all")).withColumnRenamed("host", "of_host")
    )
    common = (
        texts.groupBy("host", "line").agg(F.count("*").alias("documents"), F.min("first").alias("first"))
        .where(F.col("documents") > limits.documents)
        .join(hosts, F.col("host").eqNullSafe(F.col("of_host")))
        .where(100 * F.col("documents") > limits.percent * F.col("all"))
        .select(F.col("host").alias("on_host"), F.col("line").alias("common"), "first")
    )
    found = each.join(
        common, F.col("host").eqNullSafe(F.col("on_host")) & (F.col("line") == F.col("common"))
    ).where(~F.col("doc_id").eqNullSafe(F.col("first")))
    lost = found.groupBy("row").agg(F.sum("words").alias("lost"), F.collect_set("line").alias("removed"))
    left = F.col("n_words") - F.coalesce("lost", F.lit(0))
    return (
        stats.drop("lines").join(lost, "row", "left")
        .withColumn("words_left", left)
        .withColumn("kept", ~F.col("base_failed") & (left >= limits.left * F.col("n_words")))
        .drop("row", "lost")
    )


def clean(docs: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """``docs`` without rejected documents, and kept ones without their common lines.

    Changes are found by (doc_id, text hash). Their table is broadcast only below
    ``limits.broadcast_bytes``, by a sum over its rows; beyond that the join shuffles.
    """
    verdicts = judged(docs, host, limits).where("NOT kept OR removed IS NOT NULL")
    changes = staged(
        verdicts.select("doc_id", "text_hash", "kept", "removed").dropDuplicates(["doc_id", "text_hash"]), "line-changes")
    joined = with_changes(docs, changes, _bytes(changes) <= limits.broadcast_bytes)
    rest = F.array_join(
        F.filter(
            F.split("doc.text", "\n"),
            lambda line: ~F.array_contains("change.removed", F.xxhash64(normal_line(line))) | ~line.rlike(WORD),
        ),
        "\n",
    )
    kept = joined.where(F.coalesce("change.kept", F.lit(True)))
    return kept.select(*columns_of(docs, rest, F.col("change.removed").isNotNull()))


def _bytes(changes: DataFrame) -> int:
    """What the table of changes takes in memory, about."""
    lines = F.when(F.col("removed").isNull(), F.lit(0)).otherwise(F.size("removed"))
    return changes.agg(F.sum(F.lit(48) + 8 * lines)).first()[0] or 0
