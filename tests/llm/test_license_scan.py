"""Licence notices planted in texts, with changed wording, versions and places."""

from __future__ import annotations

import random
import re
import textwrap

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from basketlens.llm import license_scan as licenses
from basketlens.llm.license_templates import TEMPLATES
from basketlens.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, license string, start int, wording string"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "l", 1, "w") for i, t in enumerate(texts)], SCHEMA)


def found(text):
    return [f for a, z in licenses.blocks(text, 2) for f in licenses.judge(text, a, z, licenses.Settings())]


@pytest.mark.parametrize("name,text", [(n, t) for n, texts in TEMPLATES.items() for t in texts])
def test_every_template_finds_itself(name, text):
    body = f"some words before it\n{text}\nand some words after it"
    got = [f for f in found(body) if f.confirmed]
    assert [(f.license, f.differing) for f in got] == [(name, 0)]
    assert body[got[0].start : got[0].end] in text


@pytest.mark.parametrize("name,text", [(n, t) for n, texts in TEMPLATES.items() for t in texts])
def test_every_template_is_found_when_wrapped(name, text):
    for width in range(40, 81):
        body = "some words before it\n" + textwrap.fill(text, width, break_on_hyphens=False, break_long_words=False) + "\nand some words after it"
        got = [f for f in licenses.notices(body) if f.confirmed]
        assert [(f.license, f.differing) for f in got] == [(name, 0)], width


def test_the_unlicense_as_published():
    text = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.

In jurisdictions that recognize copyright laws, the author or authors"""
    assert [f.license for f in licenses.notices(text) if f.confirmed] == ["Unlicense"]


def test_versions_are_told_apart():
    assert [f.license for f in found("This work is licensed under the GNU General Public License, version 2.")] == ["GPL-2.0"]
    assert [f.license for f in found("Licensed under CC BY-NC 4.0.")] == ["CC-BY-NC-4.0"]
    assert not found("Licensed under CC BY-NC 3.0.")[0].differing == 0


def test_two_notices_in_one_block():
    got = found("Released under the MIT License. Licensed under CC BY-NC 4.0.\nAll rights reserved.")
    assert [(f.license, f.confirmed) for f in got] == [("MIT", True), ("CC-BY-NC-4.0", True), ("proprietary", True)]


def test_changed_words_are_named():
    text = TEMPLATES["MIT"][2].replace("free of charge", "at no cost")
    (one,) = [f for f in found(text) if f.confirmed]
    assert one.license == "MIT" and one.differing == 3 and "+at no cost" in one.wording and "-free of charge" in one.wording


def test_talk_about_licences_is_not_a_notice():
    for text in ("He lost his driving license yesterday and paid for it.", "The copyright of the song was sold twice that year."):
        assert not any(f.confirmed for f in found(text))


def brute(a, b):
    """Fewest single-word edits that turn the best part of ``a`` into ``b``."""
    row = [0] * (len(a) + 1)
    for i, w in enumerate(b, 1):
        row = _next(row, a, w, i)
    return min(row)


def _next(row, a, w, i):
    out = [i]
    for j, v in enumerate(a, 1):
        out.append(min(row[j - 1] + (v != w), row[j] + 1, out[-1] + 1))
    return out


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abcdef"), max_size=8), st.integers(0, 3), st.integers(0, 10**6))
def test_differences_are_at_least_the_least(around, edits, seed):
    r = random.Random(seed)
    template = licenses.words_of(TEMPLATES["ISC"][1])
    block = list(template)
    for _ in range(edits):
        i = r.randrange(len(block))
        block[i : i + r.choice([0, 1])] = r.choice([[], ["zz"]])
    n, _, _, _ = licenses.differences((*around, *block, *around), template)
    assert brute((*around, *block, *around), template) <= n <= 2 * edits


def test_scan_of_odd_texts(spark):
    texts = [None, "", " ", "License", "a " * 50000 + "\nReleased under the MIT License.\n" + "b " * 50000,
             "é\nAll rights reserved.", "é\nAll rights reserved.", "license " * 2000]
    rows = sorted((r.doc_id, r.license, r.start) for r in licenses.scan(frame(spark, texts)).where("confirmed").collect())
    assert rows == [(4, "MIT", 100001), (5, "proprietary", 2), (6, "proprietary", 2)]
    assert licenses.scan(frame(spark, [])).count() == 0


def test_query_finds_all_planted_notices(spark):
    notices = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT", "All rights reserved.": "proprietary",
               "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "Licensed under the Apache License, Version 2.0.": "Apache-2.0"}
    expected = sorted(
        (r.doc_id, m.start(), name) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()
        for text, name in notices.items() for m in re.finditer(re.escape(text), r.text or ""))
    got = sorted((r.doc_id, r.start, r.license) for r in QUERIES["op1_license_scan"](spark, SMALL).where("confirmed").collect())
    assert got == expected and got
