"""From raw documents to packed training sequences, stage by stage.

Each stage takes what its predecessor kept, written as Parquet and read again. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketlens.llm import jaccard_join, line_quality, mixing, packing, pii
from basketlens.llm.queries import WORD_BPE, table
from basketlens.session import pin_utc, scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines that many documents of a source share go from the others."""
    return line_quality.clean(docs, host="source")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays: five-word shingles, similarity 0.75."""
    return jaccard_join.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to the name of its kind."""
    return pii.redacted(docs)


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at the rates of the wanted mix; clean documents stay as they are, others become rare."""
    return mixing.mixed(docs, table(spark, sf_dir, "labels"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: per piece its place and its token ids. The stages before have left
    the executors little memory beside their heap, so workers remember fewer pieces of text."""
    return packing.pack_documents(docs, WORD_BPE, end_id=0, keep=300_000)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard", near_duplicates),
    ("personal_data", personal_data),
    ("target_mix", target_mix),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents below ``sf_dir``."""
    docs = table(pin_utc(spark), sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        if k:
            path = scratch(spark, f"pipeline-{k}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
        docs = stage(spark, docs, sf_dir)
    return docs


# Similarity joins and packing have no SQL form; the pipeline is tested against brute force.
ORACLE_SQL = None
