"""Toxicity by a weighted lexicon, matched by an Aho-Corasick automaton after folding.

Texts are folded: lower case, one form for letters that look alike, digits and signs inside words
read as the letters they stand for, marks that hide in words dropped. Lexicon entries begin at a
word and are whole words or beginnings of words; their weights are learned from labelled documents.
Exception phrases cover entries inside them, which then do not count. The weights found are set
against the length of the text and turned into a probability by a logistic curve.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import fields_of, map_arrow, require

# Letters that look like a-z, and signs that stand for letters inside words.
ALIKE = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ɡ": "g", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l",
    "м": "m", "н": "h", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "υ": "u", "ѵ": "v", "ѡ": "w", "х": "x",
    "у": "y", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "χ": "x", "ı": "i",
    "ł": "l", "ø": "o",
}
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
# Phrases in which a word of abuse is meant otherwise.
EXCEPTIONS = (
    "trash can", "trash bin", "trash bag", "trash collection", "clown fish", "class clown", "circus clown",
    "idiot proof", "scum line", "pond scum", "sore loser", "stupid question",
)
HIDDEN = re.compile("[­​-‏⁠﻿̀-ͯ]")
IN_WORD = re.compile(r"(?<=[^\W\d_])[0134578@$!]+(?=[^\W\d_])|(?<![^\W_])[0134578@$](?=[^\W\d_]|[0134578@$][^\W\d_])")
LETTERS = re.compile(r"[^\W\d_]+")
TABLE = str.maketrans(ALIKE)
SIGNS = str.maketrans(STANDS_FOR)


def fold(text: str) -> list[str]:
    """The words of a text in folded form. An accent stays part of its letter."""
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).translate(TABLE)
        text = HIDDEN.sub("", text)
    text = IN_WORD.sub(lambda m: m[0].translate(SIGNS), text)
    return LETTERS.findall(text)


@dataclass(frozen=True)
class Training:
    """Bounds of what is learned from: rows of either label, those with the smallest hashes. Half
    of them teach the lexicon, half the curve. ``prefixes``: lengths of word beginnings tried. An
    entry is in ``least`` toxic rows at least and in ``share`` of them, which bounds the lexicon: it
    has at most the entries of ``1 / share`` average toxic rows."""

    toxic: int = 5_000
    clean: int = 10_000
    prefixes: tuple[int, ...] = (4, 5, 6, 7)
    least: int = 3
    share: float = 0.01
    weight: float = 2.5
    exceptions: tuple[str, ...] = EXCEPTIONS


@dataclass(frozen=True)
class Model:
    """Lexicon entries begin with a space; whole words end with one."""

    lexicon: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float, float] = (-4.0, 0.0, 0.0)

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for entry, weight in self.lexicon.items():
            found.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            found.add_word(f" {phrase} ", (len(phrase) + 2, 0.0))
        found.make_automaton()
        return found

    def score(self, total: float, words: int) -> float:
        """Weight found per word, and how much was found at all, as a probability."""
        a, b, c = self.curve
        x = a + b * math.log1p(100 * total / (words + 20)) + c * math.log1p(total)
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, x))))


def weigh(words: list[str], automaton: ahocorasick.Automaton) -> tuple[float, int]:
    """Weight of the entries found, one per word at most, and how many."""
    if not words or not len(automaton):
        return 0.0, 0
    text = f" {' '.join(words)} "
    best: dict[int, float] = {}
    covered: list[tuple[int, int]] = []
    for end, (length, weight) in automaton.iter(text):
        begin = end - length + 1
        if weight:
            best[begin] = max(weight, best.get(begin, 0.0))
        else:
            covered.append((begin, end))
    if covered and best:
        best = outside(best, covered)
    return math.fsum(best.values()), len(best)


def outside(best: dict[int, float], covered: list[tuple[int, int]]) -> dict[int, float]:
    """The places that lie in none of the intervals, by one search each among merged intervals."""
    begins: list[int] = []
    ends: list[int] = []
    for a, z in sorted(covered):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], z)
        else:
            begins.append(a)
            ends.append(z)

    def free(place: int) -> bool:
        k = bisect_right(begins, place) - 1
        return k < 0 or place >= ends[k]

    return {i: w for i, w in best.items() if free(i)}


def entries_of(words: list[str], prefixes: tuple[int, ...]) -> set[str]:
    some = set(words)
    out = {f" {w} " for w in some if len(w) > 2}
    for n in prefixes:
        out |= {f" {w[:n]}" for w in some if len(w) > n}
    return out


def held_out(doc_id) -> F.Column:
    """Rows whose labels are never used."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2


def learned_rows(docs: DataFrame, labels: DataFrame, training: Training) -> DataFrame:
    """Texts to learn from, with their label and a half. The ids are bounded, so they are broadcast."""
    one = require(labels, "doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    one = one.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id")
    picked = one.where("toxic = 1").orderBy(order).limit(training.toxic).unionByName(
        one.where("toxic = 0").orderBy(order).limit(training.clean))
    picked = picked.withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int"))
    docs = require(docs, "doc_id", "text")
    return docs.join(F.broadcast(picked.withColumnRenamed("doc_id", "_doc")), F.col("doc_id") == F.col("_doc")).select(
        "text", "toxic", "half")


def learn(docs: DataFrame, labels: DataFrame, training: Training = Training()) -> Model:
    rows = learned_rows(docs, labels, training)
    sizes = {r["toxic"]: r["n"] for r in rows.where("half = 0").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return Model(exceptions=training.exceptions)
    spark = docs.sparkSession

    def counted(texts: DataFrame, known: frozenset | None) -> DataFrame:
        shared = None if known is None else spark.sparkContext.broadcast(known)
        schema = fields_of("entry string, n long")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            only = shared and shared.value
            held: Counter = Counter()
            for batch in batches:
                for text in batch.column("text").to_pylist():
                    found = entries_of(fold(text or ""), training.prefixes)
                    held.update(found if only is None else found & only)
                if len(held) > 1_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array(list(held.values()), pa.int64())], schema=schema)
                    held = Counter()
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array(list(held.values()), pa.int64())], schema=schema)

        return map_arrow(texts.select("text"), run, "entry string, n long").groupBy("entry").agg(F.sum("n").alias("n"))

    lesson = rows.where("half = 0")
    tried = counted(lesson.where("toxic = 1"), None).where(F.col("n") >= max(training.least, training.share * n_toxic))
    in_toxic = {r["entry"]: r["n"] for r in tried.collect()}
    in_clean = {r["entry"]: r["n"] for r in counted(lesson.where("toxic = 0"), frozenset(in_toxic)).collect()}
    weights = {
        e: math.log((n + 0.5) / (n_toxic + 1)) - math.log((in_clean.get(e, 0) + 0.5) / (n_clean + 1))
        for e, n in in_toxic.items()
    }
    lexicon = chosen(weights, training)
    # A word that starts like an entry but is not abuse where it is found.
    covered = [e for e, w in weights.items() if e[-1] == " " and w < 0.5 and any(e[:k] in lexicon for k in range(5, len(e)))]
    model = Model(lexicon, (*training.exceptions, *(e.strip() for e in covered)))
    return Model(model.lexicon, model.exceptions, curve(rows.where("half = 1"), model))


def chosen(weights: dict[str, float], training: Training) -> dict[str, float]:
    """Entries of enough weight; one that a shorter entry covers as well is left out."""
    high = (e for e, w in weights.items() if w >= training.weight)
    kept: dict[str, float] = {}
    for entry in sorted(high, key=lambda e: (len(e), e)):
        shorter = [kept[entry[:k]] for k in range(2, len(entry)) if entry[:k] in kept]
        if not shorter or max(shorter) < weights[entry] - 0.5:
            kept[entry] = weights[entry]
    return kept


def curve(rows: DataFrame, model: Model) -> tuple[float, float, float]:
    """The logistic curve through the bounded rows kept for it, by Newton steps with a small ridge."""
    found = np.array([tuple(r) for r in weighed(rows, model, "toxic").select("total", "words", "toxic").collect()], float)
    if not len(found):
        return model.curve
    total, words, y = found.T
    x = np.stack([np.ones(len(y)), np.log1p(100 * total / (words + 20)), np.log1p(total)], axis=1)
    b = np.zeros(3)
    ridge = np.diag([1e-3, 1e-2, 1e-2])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        b += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ b)
    return tuple(b.tolist())


def weighed(rows: DataFrame, model: Model, *carry: str) -> DataFrame:
    """``carry`` columns with the weight found, the entries found, and the number of words."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    out = ", ".join(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in carry) + ", total double, hits int, words int"
    schema = fields_of(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value.automaton()
        for batch in batches:
            found = []
            for text in batch.column("text").to_pylist():
                words = fold(text or "")
                found.append((*weigh(words, automaton), len(words)))
            if found:
                total, hits, words = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(n) for n in carry), pa.array(total, pa.float64()), pa.array(hits, pa.int32()), pa.array(words, pa.int32())],
                    schema=schema)

    return map_arrow(rows.select("text", *carry), run, out)


def scored(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """Per row ``held_out``, ``score`` and ``predicted``. Null and empty texts hold nothing and get the
    score of nothing found; equal texts get equal scores; an empty table gives no rows; further
    columns are ignored."""
    a, b, c = model.curve
    total, words = F.col("total"), F.col("words")
    x = F.lit(a) + F.lit(b) * F.log1p(100 * total / (words + 20)) + F.lit(c) * F.log1p(total)
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), x))))
    return weighed(require(docs, "doc_id", "text"), model, "doc_id").select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), score.alias("score"),
        (score >= threshold).cast("int").alias("predicted"), "hits", "words")
