"""The pipeline, stage by stage, against plain versions on a small table."""

from __future__ import annotations

from test_jaccard_join import brute as components
from test_line_quality import verdicts
from test_pii import base
from test_tokens import check_packed

import corpus_pipeline
from basketlens.llm import line_quality, mixing
from basketlens.session import scratch

SMALL = "/root/testdata/sf0.001"


def written(spark, df):
    path = scratch(spark, "stage")
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_every_stage(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "ngram_jaccard", "personal_data", "target_mix", "best_fit_packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = written(spark, stage(spark, docs, SMALL))
        after = docs.collect()
        if name != "best_fit_packing":
            assert docs.columns == columns
            texts = {r.doc_id: r.text for r in after}
        if name == "quality_rules":
            rows = [(r.doc_id, r.text, r.source) for r in before]
            kept = {i for (i, _, _), v in zip(rows, verdicts(rows, line_quality.Limits())) if v[1]}
            assert set(texts) == kept and len(kept) < len(before)
        if name == "ngram_jaccard":
            assert set(texts) == {i for i, _, c in components([(r.doc_id, r.text) for r in before]) if i == c}
        if name == "personal_data":
            assert set(texts) == {r.doc_id for r in before}
            assert not any(base(t) for t in texts.values()) and any(base(r.text) for r in before)
            assert all(texts[r.doc_id] == r.text for r in before if not any(c.isdigit() or c == "@" for c in r.text))
            assert all(len(r.text) == r.n_chars for r in after if r.text != {b.doc_id: b.text for b in before}[r.doc_id])
        if name == "target_mix":
            labels = spark.read.parquet(f"{SMALL}/labels.parquet")
            copies = {r.doc_id: r.copies for r in mixing.rates(
                spark.createDataFrame(before, docs.schema), labels, mixing.Mix(most=1.0)).collect()}
            assert set(texts) == {i for i, n in copies.items() if n}
        if name == "best_fit_packing":
            check_packed(after, [(r.doc_id, r.text) for r in before])


def test_run_is_the_stages_in_turn(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = written(spark, stage(spark, docs, SMALL))
    digest = lambda found: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found)
    assert digest(rows) == digest(docs.collect())


ODD = (
    "doc_id long, text string, lang string, source string, n_chars long, change string, doc string, copy long, "
    "text_hash string, row int, lines string, p_clean double, length int, kept boolean"
)


def test_stages_on_odd_rows_and_clashing_columns(spark):
    extra = ("c", "d", 7, "t", 1, "l", 0.5, 3, True)
    long = " ".join(f"word{i} x@y.zz" for i in range(9000))
    texts = [None, "", " \n", "short", "short", long, long + " more", "ñé " * 80, "one 1.2.3.4 two"] + [f"plain text number {i} " * 20 for i in range(3)]
    rows = [(i, t, "en", "s", len(t or ""), *extra) for i, t in enumerate(texts)]
    rows += [(None, "without an id " * 30, None, None, None, *(None,) * 9), (5, long, "en", "s", len(long), *extra)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, ODD)
        for name, stage in corpus_pipeline.STAGES:
            one = stage(spark, docs, SMALL)
            if name != "best_fit_packing":
                assert one.columns == docs.columns and one.schema.simpleString() == docs.schema.simpleString()
            assert one.count() <= (len(data) if name != "best_fit_packing" else 10**6)
            if name == "ngram_jaccard" and data:
                assert sorted((r.doc_id for r in one.collect()), key=str) == sorted([0, 1, 2, 3, 5, 7, 8, 9, 10, 11, None], key=str)
