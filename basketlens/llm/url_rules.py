"""URL filter: listed rules by host and path, and association rules mined from labelled pages.

A listed rule decides every url that it fits; the longest one wins. All other urls are judged by
rules "these tokens, then block" that FP-growth finds in labelled pages, kept where support,
confidence and lift are high enough and no shorter rule says as much. A rule is looked up by its
rarest token in an inverted index, and holds if the url has all its tokens.

Only DataFrame functions and Spark's FP-growth are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import require, staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Mining:
    """``rows``: labelled pages learned from at most, those with the smallest hashes, and
    ``tokens``: per such page, those that lean most, of which itemsets are made; both bound the
    itemsets. Pages matched and confidence are counted over all tokens. ``support``: pages
    that a rule must have matched, as a number and as a share. ``rules``: broadcast up to so many,
    beyond that joined by a shuffle."""

    rows: int = 200_000
    tokens: int = 12
    support: int = 10
    share: float = 0.002
    confidence: float = 0.7
    lift: float = 2.0
    rules: int = 5_000


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def listed(host: Column, path: Column, rules: list[tuple[str, str]], most: int = 1000) -> Column:
    """The longest of the listed ``(verdict, rule)`` that fits, as a struct, else null. A rule is a host
    and the beginning of a path, as ``net/es/``; it fits that host and all hosts below it."""
    if len(rules) > most:
        raise ValueError(f"{len(rules)} listed rules; allow more with most")
    parts = []
    for verdict, rule in sorted(set(rules)):
        on, slash, below = rule.partition("/")
        fits = (host == on) | host.endswith(f".{on}")
        parts.append(F.when(fits & path.startswith(slash + below), F.struct(
            F.lit(len(rule)).alias("length"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    if not parts:
        return F.lit(None).cast("struct<length:int,rule:string,verdict:string>")
    # With rules of one length that both fit, which only one rule in two verdicts can be, block wins.
    return F.greatest(*parts) if len(parts) > 1 else parts[0]


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """What a url is made of: labels and ends of the host, parts of the path with numbers as one
    token, its ending, and the names of query fields."""
    label = F.split(host, r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(label)), lambda i: F.concat(F.lit("host:"), F.array_join(F.slice(label, i, F.size(label)), ".")))
    pieces = F.filter(F.split(path, "[/._~-]+"), lambda x: x != "")
    parts = F.transform(pieces, lambda x: F.concat(F.lit("path:"), F.when(x.rlike("^[0-9]+$"), F.lit("0")).otherwise(F.translate(x, UPPER, LOWER))))
    query = F.regexp_extract_all(F.coalesce(url, F.lit("")), F.lit(r"[?&]([^=&#]+)="), F.lit(1))
    labels = F.transform(label, lambda x: F.concat(F.lit("label:"), x))
    words = F.transform(F.filter(F.split(host, "[.-]"), lambda x: x != ""), lambda x: F.concat(F.lit("word:"), x))
    found = F.concat(ends, labels, words, parts, F.transform(query, lambda x: F.concat(F.lit("query:"), x)))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(found))


RULES = "tokens array<string>, rarest string, matched long, confidence double"


def mined(pages: DataFrame, labels: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """Rules from pages with a label (``page_id`` = ``doc_id``): a page of low quality or with abuse is one
    to block. ``tokens``, the ``rarest`` of them, pages ``matched``, and ``confidence``."""
    spark = pages.sparkSession
    bad = (F.coalesce("toxic", F.lit(0)) == 1) | (F.coalesce("quality", F.lit(1)) == 0)
    known = require(labels, "doc_id", "quality", "toxic").where("doc_id IS NOT NULL")
    known = known.groupBy(F.col("doc_id").alias("of_page")).agg(F.max(bad).alias("bad"))
    url = F.col("url")
    rows = (
        require(pages, "page_id", "url").join(known, F.col("page_id") == F.col("of_page"))
        .orderBy(F.xxhash64("page_id", "url")).limit(mining.rows)
        .select(F.monotonically_increasing_id().alias("row"), "bad", tokens_of(url, host_of(url), path_of(url)).alias("tokens"))
        .where(F.size("tokens") > 0)
    )
    total, n_bad = rows.agg(F.count("*"), F.sum(F.col("bad").cast("long"))).first()
    nothing = spark.createDataFrame([], RULES)
    if not total or not n_bad or n_bad == total:
        return nothing
    least = max(mining.support, mining.share * total)
    each = rows.select("row", "bad", F.explode("tokens").alias("token"))
    counts = each.groupBy("token").agg(
        F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad_n"), F.bit_xor(F.xxhash64("row")).alias("pages"))
    # Tokens of the very same pages say the same; the shortest stands for them.
    often = counts.where((F.col("n") >= least) & (F.col("bad_n") > 0)).groupBy("n", "bad_n", "pages").agg(
        F.min_by("token", F.struct(F.length("token"), "token")).alias("token"))
    # Tokens that lean towards block come first; the bound per page keeps itemsets few.
    often = often.withColumn("lean", F.col("bad_n") / F.col("n"))
    kept = staged(each.join(often, "token").groupBy("row").agg(
        F.max("bad").alias("bad"),
        F.slice(F.sort_array(F.collect_list(F.struct("lean", "token")), asc=False), 1, mining.tokens)["token"].alias("has"),
        F.collect_list(F.col("token")).alias("tokens"),
    ), "url-tokens")
    # Itemsets of pages to block; how many other pages have them is counted afterwards.
    baskets = kept.where("bad").select(F.col("has").alias("items"))
    growth = FPGrowth(itemsCol="items", minSupport=min(1.0, least * mining.confidence / n_bad), minConfidence=1.0)
    sets = growth.fit(baskets).freqItemsets.select(F.sort_array("items").alias("tokens"))
    sets = sets.withColumn("id", F.xxhash64("tokens"))
    named = sets.select("id", F.explode("tokens").alias("token")).join(often.select("token", "n"), "token")
    rarest = named.groupBy("id").agg(F.min_by("token", F.struct("n", "token")).alias("rarest"))
    sets = staged(sets.join(rarest, "id"), "url-itemsets")
    pages_of = kept.select("bad", F.col("tokens").alias("has"), F.explode("tokens").alias("token"))
    matched = (
        sets.select("id", "tokens", "rarest").join(pages_of, F.col("token") == F.col("rarest"))
        .where(F.size(F.array_except("tokens", "has")) == 0).groupBy("id").agg(
            F.count("*").alias("matched"), F.sum(F.col("bad").cast("long")).alias("hits"))
    )
    sure = F.col("confidence") >= max(mining.confidence, mining.lift * n_bad / total)
    surest = (
        sets.join(matched, "id").withColumn("confidence", F.col("hits") / F.col("matched"))
        .where((F.col("matched") >= least) & sure)
    )
    surest = staged(surest.select("id", "tokens", "rarest", "matched", "confidence"), "url-rules")
    # A rule is left out if one with some of its tokens is as sure. Most are by a single token, which
    # is looked at first: what covers a covered rule is covered by that token too.
    single = surest.where(F.size("tokens") == 1).select(F.col("rarest").alias("one"), F.col("confidence").alias("as_sure"))
    by_one = surest.where(F.size("tokens") > 1).select("id", "confidence", F.explode("tokens").alias("one")).join(single, "one")
    by_one = by_one.where(F.col("as_sure") >= F.col("confidence")).select("id").distinct()
    rules = staged(surest.join(by_one, "id", "left_anti"), "url-rules")
    shorter = rules.select(F.col("tokens").alias("less"), F.col("rarest").alias("its_rarest"), F.col("confidence").alias("as_sure"))
    tokens = rules.select("id", "tokens", "confidence", F.explode("tokens").alias("one"))
    covered = tokens.join(shorter, F.col("one") == F.col("its_rarest")).where(
        (F.size("less") < F.size("tokens")) & (F.col("as_sure") >= F.col("confidence")) & (F.size(F.array_except("less", "tokens")) == 0))
    return rules.join(covered.select("id").distinct(), "id", "left_anti").select("tokens", "rarest", "matched", "confidence")


def judged(pages: DataFrame, rules: list[tuple[str, str]], mined_rules: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """Per row ``page_id``, ``url``, ``host``, ``path``, the listed ``rule`` if one fits, the ``verdict``, and the
    tokens of the mined rule that blocked (``because``).

    A null url, or one without ``://``, has an empty host and path, fits no rule and is allowed. Equal
    rows are judged each; an empty table gives no rows; further columns are ignored.
    """
    url = F.col("url")
    rows = require(pages, "page_id", "url").withColumns({"host": host_of(url), "path": path_of(url)})
    rows = rows.withColumn("listed", listed(F.col("host"), F.col("path"), rules))
    index = staged(mined_rules, "url-index")
    if index.count() <= mining.rules:
        index = F.broadcast(index)
    open_tokens = F.when(F.col("listed").isNull(), tokens_of(url, F.col("host"), F.col("path"))).otherwise(F.array().cast("array<string>"))
    looked = (
        rows.withColumn("row", F.monotonically_increasing_id()).withColumn("has", open_tokens)
        .withColumn("token", F.explode_outer("has"))
        .join(index, F.col("token") == F.col("rarest"), "left")
        .withColumn("hit", F.when(F.size(F.array_except("tokens", "has")) == 0, F.struct("confidence", "matched", "tokens")))
    )
    # With a broadcast index the tokens of a row are in one task and one row again before the shuffle.
    one = looked.groupBy("row").agg(
        *(F.first(c).alias(c) for c in ("page_id", "url", "host", "path", "listed")), F.max("hit").alias("hit"))
    verdict = F.coalesce(F.col("listed.verdict"), F.when(F.col("hit").isNotNull(), F.lit("block")), F.lit("allow"))
    return one.select("page_id", "url", "host", "path", F.col("listed.rule").alias("rule"), verdict.alias("verdict"), F.col("hit.tokens").alias("because"))
