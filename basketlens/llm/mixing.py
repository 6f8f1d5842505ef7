"""Mixing to target weights by soft membership.

A classifier learned from the table of labels gives every document its probability of each domain.
Rates, one per document and never negative, are then fitted so that the tokens expected of each
domain match its target: least squares by projected gradient steps. A step needs the domains'
residuals alone, a handful of numbers, so each is one pass of partial sums over the documents and
no rate leaves its row. Steps are scaled by the domains' Gram matrix, without which a rare domain
would move slowly.

Only DataFrame functions and Spark's machine-learning library are used.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import columns_of, require, staged, with_changes

SPACE = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """``weights``: of all tokens wanted, by domain. ``tokens``: wanted in all; by default as many as
    leave the tokens of the ``whole`` domain as they are. ``rows``: labelled documents learned from
    at most, those with the smallest hashes. ``features``: cells of hashed word beginnings.
    ``most``: no rate is above it, so that with 1 rows are only thinned."""

    weights: dict[str, float] = field(default_factory=lambda: {"clean": 0.96, "low": 0.03, "toxic": 0.01})
    tokens: float | None = None
    whole: str = "clean"
    rows: int = 20_000
    features: int = 1 << 14
    prefix: int = 4
    steps: int = 25
    tolerance: float = 1e-4
    most: float | None = None
    broadcast_rows: int = 1_000_000

    @property
    def domains(self) -> list[str]:
        return list(self.weights)


def domain_of(quality: Column, toxic: Column) -> Column:
    """The domain that a row of labels names; null without labels."""
    return (
        F.when(toxic == 1, "toxic").when(quality == 0, "low").when(quality.isNotNull() & toxic.isNotNull(), "clean")
    )


def features(docs: DataFrame, mix: Mix, *carry: str) -> DataFrame:
    """Hashed beginnings of words, and shares of signs, over whole texts. Null texts are empty."""
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(F.lower(text), SPACE), lambda w: w != "")
    rows = docs.select(*carry, text.alias("_text"), words.alias("_words"))
    length = F.greatest(F.length("_text"), F.lit(1))
    shares = [
        F.length(F.regexp_replace("_text", f"[^{signs}]+", "")) / length for signs in ("|", "#*$%&", "!?", "0-9", "\\n", "@")
    ]
    terms = F.array_distinct(F.transform("_words", lambda w: F.substring(w, 1, mix.prefix)))
    rows = rows.select(
        *carry, F.size("_words").cast("long").alias("n_tokens"), terms.alias("_terms"),
        F.log1p(F.size("_words").cast("double")).alias("_long"),
        *(F.sqrt(s).alias(f"_share{i}") for i, s in enumerate(shares)),
    )
    rows = HashingTF(inputCol="_terms", outputCol="_hashed", numFeatures=mix.features, binary=True).transform(rows)
    inputs = ["_hashed", "_long", *(f"_share{i}" for i in range(len(shares)))]
    return VectorAssembler(inputCols=inputs, outputCol="_features").transform(rows).select(*carry, "n_tokens", "_features")


def memberships(docs: DataFrame, labels: DataFrame, mix: Mix) -> DataFrame:
    """Per row ``doc_id``, ``text_hash``, ``n_tokens``, and ``p_`` of each domain, staged. Without labels
    all domains are equally likely; with labels of one domain, that domain is certain."""
    docs = require(docs, "doc_id", "text")
    names = mix.domains
    number = F.array_position(F.array(*(F.lit(n) for n in names)), F.col("_domain")) - 1
    known = require(labels, "doc_id", "quality", "toxic").groupBy("doc_id").agg(
        domain_of(F.min("quality"), F.max("toxic")).alias("_domain"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("_domain").isin(names))
    picked = known.orderBy(F.xxhash64("doc_id")).limit(mix.rows).select(
        F.col("doc_id").alias("_doc"), number.cast("double").alias("_label"))
    lesson = features(docs.join(F.broadcast(picked), F.col("doc_id") == F.col("_doc")), mix, "_label")
    lesson = staged(lesson, "mixing-lesson")
    seen = [r[0] for r in lesson.select("_label").distinct().collect()]
    rows = docs.withColumn("text_hash", F.xxhash64("text"))
    if len(seen) < 2:
        sure = {int(seen[0])} if seen else set(range(len(names)))
        text = F.coalesce("text", F.lit(""))
        tokens = F.size(F.filter(F.split(text, SPACE), lambda w: w != "")).cast("long").alias("n_tokens")
        return staged(rows.select("doc_id", "text_hash", tokens, *(
            F.lit(1.0 / len(sure) if k in sure else 0.0).alias(f"p_{n}") for k, n in enumerate(names))), "memberships")
    model = LogisticRegression(
        featuresCol="_features", labelCol="_label", family="multinomial", maxIter=40, regParam=1e-4,
        elasticNetParam=0.0, standardization=False,
    ).fit(lesson)
    out = model.transform(features(rows, mix, "doc_id", "text_hash")).withColumn("_p", vector_to_array("probability"))
    return staged(out.select(
        "doc_id", "text_hash", "n_tokens", *(F.coalesce(F.get("_p", F.lit(k)), F.lit(0.0)).alias(f"p_{n}") for k, n in enumerate(names))),
        "memberships")


def rate_of(mix: Mix, steps: list[list[float]]) -> Column:
    """The rate after the steps: from one, each moves it by the row's memberships, never below zero and
    never above ``mix.most``. The steps are an array of numbers that one expression goes through:
    as an expression within the next, each step would cost the driver more to plan and compile."""
    if not steps:
        return F.lit(1.0)

    def move(rate: Column, step: Column) -> Column:
        for k, name in enumerate(mix.domains):
            rate = rate - F.col(f"p_{name}") * step[f"u{k}"]
        rate = F.greatest(F.lit(0.0), rate)
        return rate if mix.most is None else F.least(F.lit(float(mix.most)), rate)

    moves = [F.struct(*(F.lit(float(u)).alias(f"u{k}") for k, u in enumerate(step))) for step in steps]
    return F.aggregate(F.array(*moves), F.lit(1.0), move)


def fitted(rows: DataFrame, mix: Mix) -> tuple[list[list[float]], dict[str, float]]:
    """Steps whose rates match the targets best, and the targets in tokens."""
    names = mix.domains
    k = len(names)
    t = F.col("n_tokens").cast("double")
    p = [F.col(f"p_{n}") for n in names]
    sums = rows.agg(*(F.sum(t * x) for x in p), *(F.sum(t * x * y) for x in p for y in p)).first()
    natural = np.array([x or 0.0 for x in sums[:k]])
    total = natural.sum()
    weights = np.array([mix.weights[n] for n in names])
    if total == 0 or weights.sum() <= 0:
        return [], {n: 0.0 for n in names}
    weights = weights / weights.sum()
    whole = names.index(mix.whole)
    wanted = mix.tokens or (natural[whole] / weights[whole] if weights[whole] and natural[whole] else total)
    target = weights * wanted
    gram = np.array([x or 0.0 for x in sums[k:]]).reshape(k, k)
    scale = np.linalg.pinv(gram + 1e-9 * total * np.eye(k))

    steps: list[list[float]] = []
    residual = natural - target
    best, best_steps, pace = np.inf, [], 1.0
    for _ in range(mix.steps):
        error = float(np.abs(residual).sum() / wanted)
        if error < best:
            best, best_steps = error, list(steps)
        else:  # the projection cut off too much: go back and go on more slowly
            steps, pace = list(best_steps), pace / 2
            if pace < 1 / 64:
                break
            residual = best_residual
        if best < mix.tolerance:
            break
        best_residual = residual
        steps.append((pace * scale @ residual).tolist())
        at = rows.withColumn("_rate", rate_of(mix, steps))
        found = at.agg(*(F.sum(F.col("_rate") * t * x) for x in p)).first()
        residual = np.array([x or 0.0 for x in found]) - target
    return best_steps, dict(zip(names, target.tolist()))


def rates(docs: DataFrame, labels: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Per row ``doc_id``, ``text_hash``, ``n_tokens``, memberships, ``rate`` and ``copies``.

    ``copies`` rounds the rate up or down by the row's hash, so that on average it is the rate; equal
    rows are rounded alike. Null and empty texts have no tokens and a rate like any other; an empty
    table gives no rows; further columns are ignored.
    """
    rows = memberships(docs, labels, mix)
    steps, _ = fitted(rows, mix)
    rate = F.round(rate_of(mix, steps), 6)
    chance = (F.pmod(F.xxhash64("doc_id", "text_hash", F.lit("mix")), F.lit(1 << 20)) + 0.5) / (1 << 20)
    return rows.withColumn("rate", rate).withColumn("copies", F.floor(F.col("rate") + 1 - chance).cast("int"))


def realised(rates: DataFrame, mix: Mix = Mix()) -> dict[str, float]:
    """Tokens of each domain as the copies of ``rates`` have them, by memberships."""
    names = mix.domains
    sums = rates.agg(*(F.sum(F.col("copies") * F.col("n_tokens") * F.col(f"p_{n}")) for n in names)).first()
    return {n: x or 0.0 for n, x in zip(names, sums)}


def mixed(docs: DataFrame, labels: DataFrame, mix: Mix = Mix(), repeat: bool = False) -> DataFrame:
    """``docs`` at their rates: rows without copies go, and with ``repeat`` rows come as often as they
    have copies. Without it no row comes twice, so the rates are fitted below one. Changes are found by (doc_id, text hash) and broadcast up to
    ``mix.broadcast_rows`` rows; beyond that the join shuffles."""
    if not repeat:
        mix = replace(mix, most=min(1.0, 1.0 if mix.most is None else mix.most))
    changes = rates(docs, labels, mix).where("copies <> 1" if repeat else "copies < 1")
    changes = staged(changes.select("doc_id", "text_hash", "copies").dropDuplicates(["doc_id", "text_hash"]), "mixing-changes")
    joined = with_changes(docs, changes, changes.count() <= mix.broadcast_rows)
    copies = F.coalesce("change.copies", F.lit(1))
    kept = joined.where(copies > 0)
    if repeat:
        kept = kept.withColumn("time", F.explode(F.sequence(F.lit(1), copies)))
    return kept.select(*columns_of(docs))
