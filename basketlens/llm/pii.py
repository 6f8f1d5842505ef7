"""Personal data: generators propose spans, boosted trees judge them, thresholds choose.

Four kinds have an exact base form and are always found. Beyond them generators propose spans with
high recall, which may overlap: long codes, numbers with separators, and addresses written out.
Gradient-boosted trees score each by its form and its surroundings. They learn from the documents
themselves: what a strict form proves is an example for, other candidates are examples against.
The threshold of each kind is set on documents that were not learned from, for a wanted precision.

Only DataFrame functions and the trees of Spark's machine-learning library are used.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from basketlens.llm.common import columns_of, let, require, staged, with_changes

# The base kinds in their order. A match may only begin where a run of its first
# characters begins, or where the last match ended, and runs are not given back: both leave the
# matches as they are and the time linear.
LOCAL = "[A-Za-z0-9._%+-]"
DOMAIN = "[A-Za-z0-9-]"
BASE = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@{DOMAIN}++(?:\.{DOMAIN}++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
CODE = "[A-Za-z0-9_+/-]"
PROPOSED = {
    "secret": rf"(?<!{CODE})(?=[A-Za-z_+/-]*+[0-9]){CODE}{{12,}}+",
    "number": r"(?<![0-9])[0-9](?:[ ().-]{0,2}[0-9]){6,}+",
    "address": rf"(?<!{LOCAL}){LOCAL}++ ?(?:@|\[at\]|\(at\)) ?{DOMAIN}++(?: ?(?:\.|\[dot\]|\(dot\)) ?{DOMAIN}++)++",
}
KINDS = (*BASE, *PROPOSED)
# What a text must contain for a pattern to be tried at all.
HINTS = {"email": "@", "ip": "[0-9][.][0-9]", "card": "[0-9][ -]?[0-9]", "phone": "[+][0-9]",
         "secret": "[0-9]", "number": "[0-9]", "address": r"@|\(at\)|\[at\]"}
SECRET_WORD = r"(?i)(token|passw(or)?d|passwd|pwd|secret|api.?key|access.?key|credential)\W{0,5}$"
NUMBER_WORD = r"(?i)(phone|tel|call|fax|mobile|card|account|iban|ssn|id|no)\W{0,5}$"
SPAN = "array<struct<start:int,end:int,match:string>>"


@dataclass(frozen=True)
class Training:
    """``rows``: candidates learned from at most, those with the smallest hashes; ``precision``:
    wanted of each kind on every ``fold``-th document, which is not learned from; ``least``:
    candidates of a kind needed there."""

    rows: int = 20_000
    trees: int = 12
    depth: int = 4
    fold: int = 4
    precision: float = 0.95
    least: int = 10
    broadcast_rows: int = 200_000


def located(text: Column, pattern: str, hint: str) -> Column:
    """Matches with their places, in code points: what lies between them tells where they begin."""

    def place(x: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

        def step(a: Column, i: Column) -> Column:
            begin = a.at + F.length(x.gaps[i])
            end = begin + F.length(x.found[i])
            one = F.struct(begin.alias("start"), end.alias("end"), x.found[i].alias("match"))
            return F.struct(end.alias("at"), F.array_append(a.out, one).alias("out"))

        places = F.aggregate(F.sequence(F.lit(0), F.size(x.found) - 1), start, step, lambda a: a.out)
        return F.when(F.size(x.found) == 0, F.array().cast(SPAN)).otherwise(places)

    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("gaps")
    )
    return F.when(text.rlike(hint), let(found, place)).otherwise(F.array().cast(SPAN))


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the check digit holds."""

    def total(n: Column) -> Column:
        def step(a: Column, i: Column) -> Column:
            d = F.substring(n, F.length(n) - i, F.lit(1)).cast("int")
            twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
            return a + F.when(i % 2 == 1, twice).otherwise(d)

        return F.aggregate(F.sequence(F.lit(0), F.length(n) - 1), F.lit(0), step) % 10 == 0

    return let(number, total)


def valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        n = digits(match)
        return F.when(F.length(n).between(14, 19), luhn(n)).otherwise(False)
    if kind == "phone":
        return F.length(digits(match)).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> dict[str, Column]:
    def found(kind: str) -> Column:
        return F.filter(located(text, BASE[kind], HINTS[kind]), lambda s: valid(kind, s.match))

    return {kind: found(kind) for kind in BASE}


def _places(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s.start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s.end.alias("end")))


def _proposals(text: Column, kind: str) -> Column:
    """Candidates with thirty characters on either side."""
    return F.transform(located(text, PROPOSED[kind], HINTS[kind]), lambda s: F.struct(
        F.lit(kind).alias("kind"), s.start.alias("start"), s.end.alias("end"), s.match.alias("match"),
        F.substring(text, F.greatest(s.start - 29, F.lit(1)), F.least(s.start, F.lit(30))).alias("before"),
        F.substring(text, s.end + 1, F.lit(30)).alias("after"),
    ))


def spans_of(docs: DataFrame) -> DataFrame:
    """Per row, staged without the text: ``base`` spans by kind and the ``proposed`` candidates."""
    text = F.coalesce("text", F.lit(""))
    base = base_spans(text)
    found = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"),
        *(_places(spans, kind).alias(f"at_{kind}") for kind, spans in base.items()),
        F.concat(*(_proposals(text, kind) for kind in PROPOSED)).alias("proposed"),
    )
    return staged(
        found.select(
            "doc_id", "text_hash", "proposed",
            *(F.size(f"at_{k}").cast("long").alias(f"n_{k}") for k in BASE),
            F.sort_array(F.concat(*(F.col(f"at_{k}") for k in BASE))).alias("base"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "pii-spans",
    )


# --- candidates ----------------------------------------------------------------------------------


def _share(match: Column, of: str) -> Column:
    return F.length(F.regexp_replace(match, f"[^{of}]", "")) / F.length(match)


def _with_overlap(spans: DataFrame) -> DataFrame:
    """One row per proposed span, with whether it overlaps a base span (``on_base``). Base spans come as
    rows beside the proposed ones, so that a text with very many of both costs their sum."""
    some = spans.where(F.size("proposed") > 0)
    proposed = some.select("row", "doc_id", F.explode("proposed").alias("c")).select("row", "doc_id", "c.*", F.lit(False).alias("is_base"))
    base = some.select("row", F.explode("base").alias("b")).select("row", "b.start", "b.end", F.lit(True).alias("is_base"))
    both = proposed.unionByName(base, allowMissingColumns=True)
    by_place = W.partitionBy("row").orderBy("start", "end")
    reached = F.max(F.when(F.col("is_base"), F.col("end"))).over(by_place.rowsBetween(W.unboundedPreceding, -1))
    follows = F.min(F.when(F.col("is_base"), F.col("start"))).over(by_place.rowsBetween(1, W.unboundedFollowing))
    overlap = F.coalesce(reached > F.col("start"), F.lit(False)) | F.coalesce(follows < F.col("end"), F.lit(False))
    return both.withColumn("on_base", overlap).where(~F.col("is_base")).drop("is_base")


def candidates(spans: DataFrame) -> DataFrame:
    """One row per proposed span with its features, and what a strict form says of it (``proved``)."""
    each = _with_overlap(spans)
    number = digits(F.col("match"))
    numeric = {
        "length": F.least(F.length("match"), F.lit(200)),
        "digit_share": _share(F.col("match"), "0-9"),
        "upper_share": _share(F.col("match"), "A-Z"),
        "lower_share": _share(F.col("match"), "a-z"),
        "hex_share": _share(F.col("match"), "0-9a-fA-F"),
        "n_digits": F.least(F.length(number), F.lit(60)),
        "n_separators": F.length(F.regexp_replace("match", "[A-Za-z0-9]", "")),
        "n_dots": F.length(F.regexp_replace("match", "[^.]", "")),
        "distinct_share": F.size(F.array_distinct(F.split(F.col("match"), ""))) / F.length("match"),
        "changes": F.regexp_count("match", F.lit("[A-Za-z][0-9]|[0-9][A-Za-z]")) / F.length("match"),
        "check_digit": F.when(F.length(number).between(8, 19), luhn(number)).otherwise(False).cast("int"),
        "octets": F.col("match").rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$").cast("int"),
        "plus_before": F.col("before").endswith("+").cast("int"),
        "mark_before": F.col("before").rlike("[=:] ?[\"']?$").cast("int"),
        "quote_before": F.col("before").rlike("[\"']$").cast("int"),
        "quote_after": F.col("after").rlike("^[\"']").cast("int"),
        "secret_word": F.col("before").rlike(SECRET_WORD).cast("int"),
        "number_word": F.col("before").rlike(NUMBER_WORD).cast("int"),
        "joined_before": F.col("before").rlike("[\\p{L}0-9]$").cast("int"),
        "joined_after": F.col("after").rlike("^[\\p{L}0-9]").cast("int"),
        "digits_near": F.least(F.length(digits(F.concat("before", "after"))), F.lit(20)),
        "is_secret": (F.col("kind") == "secret").cast("int"),
        "is_number": (F.col("kind") == "number").cast("int"),
    }
    strict = F.col("match").rlike("^AKIA[0-9A-Z]{16}$") | (
        (F.col("kind") == "secret") & F.col("before").rlike(SECRET_WORD) & (F.length("match") >= 16))
    features = VectorAssembler(inputCols=list(numeric), outputCol="features")
    rows = each.withColumn("proved", (F.col("on_base") | strict).cast("double"))
    rows = rows.withColumns({name: value.cast("double") for name, value in numeric.items()})
    return features.transform(rows).select("row", "doc_id", "kind", "start", "end", "match", "on_base", "proved", "features")


def judged(found: DataFrame, training: Training = Training()) -> DataFrame:
    """The candidates that the trees choose, save those on base spans. None where the documents hold
    no example for or against."""
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(training.fold)) == 0
    found = found.withColumn("held_out", fold)
    # The bound is on candidates, by hash, so it does not depend on order or partitions.
    order = F.xxhash64("doc_id", "start", "kind", "match")
    learn = found.where("NOT held_out").orderBy(order).limit(training.rows)
    seen = {r["proved"]: r["n"] for r in learn.groupBy("proved").agg(F.count("*").alias("n")).collect()}
    nothing = found.where("false").select("row", "kind", "start", "end")
    if len(seen) < 2:
        return nothing
    learn = learn.withColumn("weight", F.when(F.col("proved") == 1, 0.5 / seen[1.0]).otherwise(0.5 / seen[0.0]))
    trees = GBTClassifier(
        featuresCol="features", labelCol="proved", weightCol="weight", maxIter=training.trees,
        maxDepth=training.depth, maxBins=32, seed=7, cacheNodeIds=False, minWeightFractionPerNode=0.0,
    ).fit(learn)
    scored = trees.transform(found).withColumn("score", F.round(vector_to_array("probability")[1], 2))
    scored = staged(scored.select("row", "kind", "start", "end", "on_base", "proved", "held_out", "score"), "pii-scores")
    counts = scored.where("held_out").groupBy("kind", "score").agg(F.count("*").alias("n"), F.sum("proved").alias("good"))
    chosen = thresholds([tuple(r) for r in counts.collect()], training)
    if not chosen:
        return nothing
    high = reduce(lambda a, b: a | b, [(F.col("kind") == k) & (F.col("score") >= t) for k, t in chosen.items()])
    return scored.where(high & ~F.col("on_base")).select("row", "kind", "start", "end")


def thresholds(counts: list[tuple[str, float, int, float]], training: Training) -> dict[str, float]:
    """Per kind the least score from which on the held-out candidates reach the precision. ``counts``
    has a row per kind and score in hundredths, at most 101 per kind."""
    out = {}
    for kind in {c[0] for c in counts}:
        n = good = 0
        for _, score, some, right in sorted((c for c in counts if c[0] == kind), key=lambda c: -c[1]):
            n, good = n + some, good + right
            if score >= 0.5 and n >= training.least and good >= training.precision * n:
                out[kind] = score
    return out


def _text(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s.kind], s.start, s.end)), ",")


def personal_data(docs: DataFrame, training: Training = Training()) -> DataFrame:
    """Per row: counts of the base kinds, ``base`` and all ``spans`` (start, kind, end), and both as text.

    Null texts are empty and hold nothing; equal rows have equal spans; an empty table gives no rows;
    further columns are ignored. Places count code points; the end is exclusive.
    """
    spans = spans_of(require(docs, "doc_id", "text"))
    added = judged(candidates(spans), training)
    kinds = F.create_map(*(x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))))
    grouped = added.groupBy("row").agg(
        F.collect_set(F.struct("start", kinds[F.col("kind")].alias("kind"), "end")).alias("added"))
    all_spans = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", "added")))
    return (
        spans.drop("proposed").join(grouped, "row", "left").withColumn("spans", all_spans)
        .withColumns({"base_text": _text(F.col("base")), "spans_text": _text(F.col("spans"))})
        .drop("row", "added")
    )


def redacted(docs: DataFrame, training: Training = Training()) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; spans that overlap are one, named
    by the first. Rows are found by (doc_id, text hash); the table of changes is broadcast up to
    ``training.broadcast_rows`` rows, and joined by a shuffle beyond."""
    found = personal_data(docs, training).where(F.size("spans") > 0)
    changes = staged(found.select("doc_id", "text_hash", "spans").dropDuplicates(["doc_id", "text_hash"]), "pii-changes")
    joined = with_changes(docs, changes, changes.count() <= training.broadcast_rows)
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))

    def replaced(text: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

        def step(a: Column, s: Column) -> Column:
            fresh = F.array(F.substring(text, a.at + 1, s.start - a.at), names[s.kind])
            return F.struct(
                F.greatest(a.at, s.end).alias("at"),
                F.when(s.start < a.at, a.parts).otherwise(F.concat(a.parts, fresh)).alias("parts"),
            )

        def rest(a: Column) -> Column:
            return F.array_join(F.array_append(a.parts, F.substring(text, a.at + 1, F.length(text))), "")

        return F.aggregate("change.spans", start, step, rest)

    changed = F.col("change.spans").isNotNull()
    return joined.select(*columns_of(docs, let(F.col("doc.text"), replaced), changed))
