"""Personal data: base spans against Python's patterns, added spans on made texts."""

from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from basketlens.llm import pii
from basketlens.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, n_chars long, start int, kind string, spans string, row long"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(n):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(n)))) % 10 == 0


def good(kind, m):
    n = re.sub("[^0-9]", "", m)
    return {
        "email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.split(".")),
        "card": 14 <= len(n) <= 19 and luhn(n), "phone": 10 <= len(n) <= 15,
    }[kind]


def base(text):
    spans = [
        (m.start(), list(PATTERNS).index(k), m.end())
        for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if good(k, m[0])
    ]
    return sorted(spans)


def frame(spark, texts):
    return spark.createDataFrame([(i, t, len(t or ""), 1, "k", "s", 2) for i, t in enumerate(texts)], SCHEMA)


def as_text(spans):
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)


ODD = [
    None, "", " ", "a@b.c", "x a.b+c@d-e.f.g, y", "a@b.com_z@q.org", "a@b@c.de", "@a.b", "é1.2.3.4é", "1.2.3.4.5.6.7.8",
    "256.1.1.1 0001.02.3.255", "4111 1111 1111 1111", "4111-1111 1111  1111", "4111111111111112", "+1 (632) 555-4827.",
    "+1+12345678901", "+12 ", "ñ" * 50 + " +44 20 7946 0958", "9" * 5000, "a." * 3000, "1." * 3000, "a@" * 2000, "+1" * 3000,
    "same a@b.cc", "same a@b.cc", "card 79927398713 378282246310005",
]


def test_base_spans_of_odd_texts(spark):
    got = {r.doc_id: r for r in pii.personal_data(frame(spark, ODD)).collect()}
    for i, text in enumerate(ODD):
        spans = base(text)
        assert got[i].base_text == as_text(spans), text
        assert [got[i][f"n_{k}"] for k in PATTERNS] == [sum(s[1] == j for s in spans) for j in range(4)]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.text(alphabet="a1@.+- 4é(2", max_size=40), min_size=1, max_size=60))
def test_base_spans(spark, texts):
    df = frame(spark, texts)
    columns = pii.base_spans(df["text"])
    for r in df.select("text", *(c.alias(k) for k, c in columns.items())).collect():
        got = sorted((s.start, list(PATTERNS).index(k), s.end) for k in PATTERNS for s in r[k])
        assert got == base(r.text)


def made():
    texts = []
    for i in range(800):
        code = hashlib.sha1(str(i).encode()).hexdigest()
        texts.append([
            f"some words token = \"{code}\" and more {i}", f"call +1 (632) 555-{4000 + i} now", f"plain words only {i} of them",
            f"see part number 12-{i}-555-0{i % 10}1-9 in the list", f"the build-{i}-of-all-things-there is done",
        ][i % 5])
    return texts


def test_trees_add_secrets_and_leave_plain_texts(spark):
    texts = made()
    got = {r.doc_id: r for r in pii.personal_data(frame(spark, texts)).collect()}
    for i, text in enumerate(texts):
        names = {s.split(":")[0] for s in got[i].spans_text.split(",") if s}
        assert set(got[i].base_text.split(",")) <= set(got[i].spans_text.split(",")) | {""}
        assert names == ([{"secret"}, {"phone"}, set(), set(), set()][i % 5])
    start = texts[0].index('"') + 1
    assert got[0].spans_text == f"secret:{start}:{start + 40}"


@pytest.mark.parametrize("rows", [0, 1000])
def test_redacted_texts(spark, rows):
    texts = made() + [None, "", "a@b.cc, 1.2.3.4", "x", "x"]
    done = pii.redacted(frame(spark, texts), pii.Training(broadcast_rows=rows))
    assert done.columns == frame(spark, []).columns
    got = {r.doc_id: (r.text, r.n_chars) for r in done.collect()}
    assert got[0][0] == 'some words token = "[SECRET]" and more 0' and got[0][1] == len(got[0][0])
    assert got[1][0] == "call [PHONE] now" and got[2][0] == texts[2]
    assert got[800][0] is None and got[802][0] == "[EMAIL], [IP]" and got[803] == ("x", 1)


def test_no_documents(spark):
    assert pii.personal_data(frame(spark, [])).count() == 0
    assert pii.redacted(frame(spark, [])).count() == 0


def test_thresholds_hold_the_precision():
    counts = [("secret", 0.9, 50, 50.0), ("secret", 0.7, 50, 46.0), ("secret", 0.6, 50, 10.0), ("number", 0.9, 5, 5.0)]
    assert pii.thresholds(counts, pii.Training(precision=0.95, least=20)) == {"secret": 0.7}


def test_query_over_all_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op7_personal_data"](spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        spans = base(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(as_text(spans).encode()).hexdigest()
        assert set(as_text(spans).split(",")) <= set(r.spans.split(",")) | {""}
