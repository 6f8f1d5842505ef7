"""Queries of the operators over the driver tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm import binary_tokens, collisions, divergence, jaccard_join, license_scan, line_quality, lloyd, mixing, nearest, packing, pii, toxicity, url_rules
from basketlens.session import pin_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
# The tokenizer files are read by their path and never copied.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def query(fn):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return fn(pin_utc(spark), sf)

    QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def oracle_sql() -> dict[str, str]:
    folder = Path(__file__).resolve().parent / "oracle"
    return {f.stem: f.read_text() for f in sorted(folder.glob("*.sql")) if f.stem in QUERIES}


@query
def op2_binary_tokens(spark, sf):
    return binary_tokens.write_and_digest(table(spark, sf, "documents"), BYTE_BPE, end_id=2)


@query
def op10_best_fit_packing(spark, sf):
    packed = packing.pack_documents(table(spark, sf, "documents"), WORD_BPE, end_id=0)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op5_line_quality(spark, sf):
    verdicts = line_quality.judged(table(spark, sf, "documents"), host="source")
    return verdicts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.coalesce(F.size("removed"), F.lit(0)).alias("lines_removed"),
    )


@query
def op6_ngram_jaccard(spark, sf):
    return jaccard_join.components(table(spark, sf, "documents"))


@query
def op7_personal_data(spark, sf):
    found = pii.personal_data(table(spark, sf, "documents"))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2("base_text", 256).alias("base_sha256"), F.col("spans_text").alias("spans"),
    )


@query
def op8_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    model = toxicity.learn(docs, table(spark, sf, "labels"))
    return toxicity.scored(docs, model, threshold=0.3)


@query
def op9_one_bit_neighbours(spark, sf):
    return nearest.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op1_license_scan(spark, sf):
    return license_scan.scan(table(spark, sf, "documents"))


# The listed rules.
URL_RULES = [
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
    ("block", "net/es/"), ("block", "net/fr/"),
]


@query
def op4_url_rules(spark, sf):
    pages = table(spark, sf, "pages")
    rules = url_rules.mined(pages, table(spark, sf, "labels"))
    return url_rules.judged(pages, URL_RULES, rules).select("page_id", "host", "path", "rule", "verdict")


@query
def op3_soft_mixing(spark, sf):
    found = mixing.rates(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return found.drop("text_hash")


@query
def op11_dimension_lloyd(spark, sf):
    return lloyd.clusters(table(spark, sf, "embeddings"))


@query
def op12_collision_neighbours(spark, sf):
    return collisions.near_duplicates(table(spark, sf, "embeddings"))


@query
def op13_source_divergence(spark, sf):
    return divergence.audited(table(spark, sf, "documents"))
