"""Licence notices in texts, by how much a known wording helps to compress them.

Blocks of lines or sentences that speak of licences are candidates. Each is compressed alone and
with every template as a raw dictionary; templates are ranked by the bytes they save, set against
what they would save on their own wording. The best few are then compared word by word, and the
one with the fewest differing words wins if these are few enough. Numbers are words, so versions
that differ are never taken for each other.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import cache
from itertools import islice

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import fields_of, map_arrow, require
from basketlens.llm.license_templates import TEMPLATES

# Words of one wording may be on two lines.
SPEAKS = (
    r"(?i)licen[sc]e|copyright|rights reserved|redistribut|public domain|creative commons|\bcc[- ](?:by|0)\b|"
    r"free of charge|free software|gnu general public|warrant(?:y|ies)|permission (?:is|to)"
).replace("[- ]", "[-@]").replace(" ", r"[\x20\x09-\x0D]+").replace("@", r"\x20\x09-\x0D")
SPEAKS_RE = re.compile(SPEAKS)
SEGMENT = re.compile(r"[^\n]+?(?:[.!?;:](?=\s)|(?=\n)|\Z)")
WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")


@dataclass(frozen=True)
class Settings:
    """``gap``: segments between two that speak of licences, within one block; wrapped wordings are
    also looked for by ``reach``, in words. ``ranked``: templates
    compared word by word. ``differing``: words that may differ, as a share of a template's words."""

    gap: int = 2
    ranked: int = 4
    differing: float = 0.15
    level: int = 12


@dataclass(frozen=True)
class Template:
    name: str
    text: str
    words: tuple[str, ...]
    with_it: zstandard.ZstdCompressor
    own: int  # bytes saved on its own wording


def _compressor(level: int, raw: bytes | None = None) -> zstandard.ZstdCompressor:
    options = {"level": level, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if raw is None:
        return zstandard.ZstdCompressor(**options)
    return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT), **options)


@cache
def templates(level: int) -> tuple[Template, ...]:
    out = []
    for name, texts in TEMPLATES.items():
        for text in texts:
            raw = normal(text).encode()
            with_it = _compressor(level, raw)
            own = len(_compressor(level).compress(raw)) - len(with_it.compress(raw))
            out.append(Template(name, text, words_of(text), with_it, max(1, own)))
    return tuple(out)


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def words_of(text: str) -> tuple[str, ...]:
    return tuple(WORD.findall(text.lower()))


def blocks(text: str, gap: int, near: int = 600) -> Iterator[tuple[int, int]]:
    """Places of blocks: segments that speak of licences, with at most ``gap`` others between two, and
    as many before and after, of at most ``near`` characters, which may belong to the wording."""
    spans = [m.span() for m in SEGMENT.finditer(text)]
    begins = [a for a, _ in spans]
    speaking = sorted({i for m in SPEAKS_RE.finditer(text) for i in range(
        max(0, bisect_right(begins, m.start()) - 1), bisect_right(begins, m.end() - 1))})
    while speaking:
        last = next((k for k in range(1, len(speaking)) if speaking[k] - speaking[k - 1] > gap + 1), len(speaking))
        first, end = speaking[0], speaking[last - 1]
        speaking = speaking[last:]
        for _ in range(gap):
            if first and spans[first - 1][1] - spans[first - 1][0] <= near:
                first -= 1
            if end + 1 < len(spans) and spans[end + 1][1] - spans[end + 1][0] <= near:
                end += 1
        yield spans[first][0], spans[end][1]


@cache
def reach(differing: float) -> int:
    """The most words in a row of a template, of which some may differ, without a key word."""
    most = 0
    for text in (normal(t) for texts in TEMPLATES.values() for t in texts):
        places = [0, *(p for m in SPEAKS_RE.finditer(text) for p in m.span()), len(text)]
        most = max(most, *(len(WORD.findall(text[a:z])) for a, z in zip(places[::2], places[1::2])))
    return int((1 + differing) * most) + 2


def wide_blocks(text: str, words: int) -> Iterator[tuple[int, int]]:
    """Places of key words with at most ``words`` others between two, and as many before and after,
    however they are dealt out over lines."""
    held: tuple[int, int] | None = None

    def widened(begin: int, end: int) -> tuple[int, int]:
        before = [m.start() for m in WORD.finditer(text, max(0, begin - 60 * words), begin)][-words:]
        after = [m.end() for m in islice(WORD.finditer(text, end, end + 60 * words), words)]
        return (before or [begin])[0], (after or [end])[-1]

    for m in SPEAKS_RE.finditer(text):
        if held and sum(1 for _ in islice(WORD.finditer(text, held[1], m.start()), words + 1)) <= words:
            held = held[0], m.end()
        else:
            if held:
                yield widened(*held)
            held = m.span()
    if held:
        yield widened(*held)


def saved(block: str, level: int = 12) -> list[tuple[float, int, int]]:
    """(share, bytes saved, template) by falling share. The share sets the bytes that a template
    saves against those it saves on its own wording, or on the whole block if that is shorter."""
    raw = normal(block).encode()
    alone = len(_compressor(level).compress(raw))
    ranked = []
    for i, t in enumerate(templates(level)):
        bytes_ = alone - len(t.with_it.compress(raw))
        ranked.append((bytes_ / t.own, bytes_, i))
    return sorted(ranked, key=lambda r: (-r[0], -r[1], r[2]))


def differences(block: tuple[str, ...], template: tuple[str, ...]) -> tuple[int, list[str], int, int]:
    """Words that differ between the template and the part of the block that answers to it, how they
    differ, and that part's place in words. Words before and after the part do not count."""
    if not block:
        return len(template), ["-" + " ".join(template)], 0, 0
    same = SequenceMatcher(None, block, template, autojunk=False)
    runs = [m for m in same.get_matching_blocks() if m.size]
    if not runs:
        return len(template), ["-" + " ".join(template)], 0, 0
    first, last = runs[0], runs[-1]
    begin, end = max(0, first.a - first.b), min(len(block), last.a + last.size + len(template) - last.b - last.size)
    n, how = 0, []
    for tag, a, z, b, y in SequenceMatcher(None, block[begin:end], template, autojunk=False).get_opcodes():
        if tag != "equal":
            n += max(z - a, y - b)
            how += [f"+{' '.join(block[begin + a:begin + z])}"] * (z > a) + [f"-{' '.join(template[b:y])}"] * (y > b)
    return n, how, begin, end


@dataclass(frozen=True)
class Found:
    start: int
    end: int
    license: str
    saved_bytes: int
    saved_share: float
    differing: int
    template_words: int
    wording: str
    confirmed: bool


def judge(text: str, begin: int, end: int, settings: Settings) -> list[Found]:
    """Licences of one block: the best template by wording; then the words it did not answer to are
    looked at again, so that a block with two notices gives two."""
    level = settings.level
    ranked = saved(text[begin:end], level)
    words = [(m[0].lower(), m.start() + begin, m.end() + begin) for m in WORD.finditer(text[begin:end])]
    out: list[Found] = []
    free = [(0, len(words))]
    best_left = None
    while free:
        a, z = free.pop()
        part = tuple(w for w, _, _ in words[a:z])
        if len(part) < 3 or not SPEAKS_RE.search(text[words[a][1] : words[z - 1][2]]):
            continue
        if out:  # the rest of a block is ranked anew
            ranked = saved(text[words[a][1] : words[z - 1][2]], level)
        choices = []
        for share, bytes_, i in ranked[: settings.ranked]:
            t = templates(level)[i]
            n, how, b, e = differences(part, t.words)
            choices.append((n > settings.differing * len(t.words), n / len(t.words), n, -share, t.name, t, bytes_, how, b, e))
        failed, _, n, share, _, t, bytes_, how, b, e = min(choices, key=lambda c: c[:5])
        one = Found(words[a + b][1] if e > b else begin, words[a + e - 1][2] if e > b else end, t.name, bytes_, round(-share, 6), n, len(t.words), "; ".join(how), not failed)
        if failed:
            best_left = best_left or one
            continue
        out.append(one)
        free += [(a + e, z), (a, a + b)]
    return sorted(out, key=lambda f: f.start) or ([best_left] if best_left else [])


def notices(text: str, settings: Settings = Settings()) -> list[Found]:
    """Notices confirmed in wide blocks, and what blocks of segments give besides."""
    spans = list(blocks(text, settings.gap))
    whole: list[Found] = []
    for begin, end in wide_blocks(text, reach(settings.differing)):
        if not any(a <= begin and end <= z for a, z in spans):
            whole += [f for f in judge(text, begin, end, settings) if f.confirmed]
    whole = [f for i, f in enumerate(whole) if all(f.start >= o.end or o.start >= f.end for o in whole[:i])]
    other = [f for a, z in spans for f in judge(text, a, z, settings)]
    other = [f for f in other if all(f.start >= o.end or o.start >= f.end for o in whole)]
    return sorted(whole + other, key=lambda f: f.start)


ROWS = (
    "doc_id long, start int, end int, license string, saved_bytes int, saved_share double, differing int, "
    "template_words int, wording string, confirmed boolean"
)


def scan(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per notice found, or per block that no template explains (``confirmed`` false, with the
    nearest template). Places count code points of the whole text.

    Null and empty texts, blocks of fewer than three words, and texts that do not speak of licences
    give no rows; equal rows give equal rows each; an empty table gives none; further columns are
    ignored.
    """
    schema = fields_of(ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                rows += [(doc_id, *vars(f).values()) for f in notices(text, settings)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    # The condition runs in the JVM, so that only texts with a candidate reach Python.
    return map_arrow(require(docs, "doc_id", "text").where(F.col("text").rlike(SPEAKS)), run, ROWS)
