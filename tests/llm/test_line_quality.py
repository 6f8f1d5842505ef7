"""Quality rules against a plain Python version."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from basketlens.llm import line_quality as quality
from basketlens.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, host string, line string, words int"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def base(text):
    text = text or ""
    w = words(text)
    at = defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i : i + 3])].append(i)
    repeat = len({i + k for places in at.values() if len(places) > 1 for i in places for k in range(3)})
    lines = [x for x in text.split("\n") if words(x)]
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeat,
        len(w) < 50 or 100 * repeat > 50 * len(w),
    )


def normal(line):
    return re.sub("[0-9]+", "0", re.sub(r"[ \t\n\x0b\f\r]+", " ", line.strip(" ").lower()))


def verdicts(rows, limits):
    """(lines removed, kept) of each (doc_id, text, host) in turn."""
    texts, first, hosts = defaultdict(set), {}, defaultdict(set)
    for doc_id, text, host in rows:
        if words(text or ""):
            hosts[host].add(text)
        for x in {normal(x) for x in (text or "").split("\n") if words(x)}:
            texts[host, x].add(text)
            first[host, x] = min(first.get((host, x), doc_id), doc_id)
    out = []
    for doc_id, text, host in rows:
        gone = [
            x for x in (text or "").split("\n")
            if words(x) and len(texts[host, normal(x)]) > limits.documents and first[host, normal(x)] != doc_id
            and 100 * len(texts[host, normal(x)]) > limits.percent * len(hosts[host])
            and sum(c.isascii() <= c.isalpha() for c in normal(x)) >= limits.letters
        ]
        n = len(words(text or ""))
        left = n - sum(len(words(x)) for x in gone)
        out.append((len({normal(x) for x in gone}), not base(text)[-1] and left >= limits.left * n))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "en", len(t or ""), "h", "l", 1) for i, t, s in rows], SCHEMA)


def results(df):
    return sorted(
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed,
         len(r.removed or []), r.kept) for r in df.collect()
    )


def expected(rows, limits):
    return sorted(
        (i, *base(t), *v) for (i, t, s), v in zip(rows, verdicts(rows, limits))
    )


def own(i):
    return BODY.replace("w", chr(97 + i) + "v")


def unlike(i):
    """A text of its own, line by line."""
    name = "".join(LETTERS[int(c)] for c in str(i))
    return "\n".join(" ".join(f"{name}{LETTERS[k]}{LETTERS[j]}" for j in range(12)) for k in range(6))


SHARED = "this line is on every page of the site and says nothing"
LETTERS = "abcdefghijkl"
BODY = "\n".join(" ".join(f"w{LETTERS[k]}{LETTERS[j]}" for j in range(12)) for k in range(6))


def test_lines_of_many_documents(spark):
    limits = quality.Limits(documents=3)
    rows = [(i, f"{SHARED} {i}\n{own(i)}", "a") for i in range(8)]
    rows += [(20 + i, "\n".join([SHARED + " 7"] * 1 + [f"This LINE is on  every page of the site and says nothing {i}"] * 6), "a") for i in range(6)]
    rows += [(40 + i, BODY, "a") for i in range(9)]  # copies
    rows += [(60, None, "a"), (61, "", None), (62, " \n\t", None), (63, BODY, None), (63, BODY, None), (64, "x " * 30000, "b")]
    df = quality.judged(frame(spark, rows), limits=limits)
    assert results(df) == expected(rows, limits)
    kept = {r.doc_id for r in df.collect() if r.kept}
    assert {40 + i for i in range(9)} <= kept and set(range(8)) <= kept and 22 not in kept


def test_clean_removes_lines_and_documents(spark):
    limits = quality.Limits(documents=3)
    rows = [(i, f"{SHARED}\n{own(i)}\n", "a") for i in range(8)] + [(9, None, "a")]
    for bound in (0, 1 << 20):
        done = quality.clean(frame(spark, rows), limits=quality.Limits(documents=3, broadcast_bytes=bound))
        assert done.columns == frame(spark, rows).columns
        texts = {r.doc_id: (r.text, r.n_chars) for r in done.collect()}
        assert set(texts) == set(range(8))
        assert texts[0][0] == rows[0][1]  # the first keeps its line
        assert all(texts[i] == (rows[i][1][len(SHARED) + 1 :], len(rows[i][1]) - len(SHARED) - 1) for i in range(1, 8))


def test_the_limit_follows_the_host_and_short_lines_stay(spark):
    limits = quality.Limits(documents=3, percent=20)
    rows = []
    for host, n in (("small", 40), ("large", 400), (None, 80)):
        for i in range(n):
            some = [f"{SHARED} {i}"] * (i % 4 == 0) + ["only in one of ten documents of it"] * (i % 10 == 0)
            rows.append((len(rows), "\n".join([*some, "}", "References", "--- 1 ---", "ñéñéñéñéñéñéñéñé", unlike(len(rows))]), host))
    rows += [(len(rows) + i, " \n", "small") for i in range(300)]  # no words, so they do not count
    df = quality.judged(frame(spark, rows), limits=limits)
    assert results(df) == expected(rows, limits)
    got = {r.doc_id: len(r.removed or []) for r in df.collect()}
    for begin, n in ((0, 40), (40, 400), (440, 80)):
        assert [got[begin + i] for i in range(1, n)] == [1 + (i % 4 == 0) for i in range(1, n)]


def test_no_documents(spark):
    assert quality.judged(frame(spark, [])).count() == 0
    assert quality.clean(frame(spark, [])).count() == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t#ñ\x0b\x1c", max_size=60), min_size=1, max_size=12))
def test_base_counts(spark, texts):
    rows = [(i, t, "a") for i, t in enumerate(texts)]
    got = quality.with_base(frame(spark, rows)).collect()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(r.text)


def test_query_over_all_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    rows = [(d.doc_id, d.text, d.source) for d in docs]
    got = {tuple(r)[:8] for r in QUERIES["op5_line_quality"](spark, SMALL).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()}
    limits = quality.Limits()
    assert got == {(i, *base(t), v[1]) for (i, t, s), v in zip(rows, verdicts(rows, limits))}
