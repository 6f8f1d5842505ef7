"""Lexicon scores: folding, matching against plain search, and accuracy on rows not learned from."""

from __future__ import annotations

import random
import time
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from basketlens.llm import toxicity
from basketlens.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, words int, toxic int, source string"


def test_folding():
    assert toxicity.fold("You 1D10T!") == ["you", "idiot"]
    assert toxicity.fold("іdіоt ｉｄｉｏｔ m0r0n$$$ tr@sh st​upid Été 2.0") == [
        "idiot", "idiot", "moron", "trash", "stupid", "été"]


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.text(alphabet="abc", min_size=1, max_size=4), max_size=12),
    st.dictionaries(st.text(alphabet="abc", min_size=1, max_size=3), st.floats(0.5, 5), max_size=6),
    st.lists(st.text(alphabet="abc", min_size=1, max_size=3), max_size=2),
)
def test_weights_against_plain_search(words, entries, phrases):
    model = toxicity.Model({f" {e}": w for e, w in entries.items()}, tuple(phrases))
    total = 0.0
    for w in words:
        if w not in phrases:  # a phrase of one word covers that word
            total += max([x for e, x in entries.items() if w.startswith(e)], default=0.0)
    assert abs(toxicity.weigh(words, model.automaton())[0] - total) < 1e-9


def test_phrases_cover_their_words():
    model = toxicity.Model({" trash": 2.0, " clown ": 1.0}, toxicity.EXCEPTIONS)
    automaton = model.automaton()
    assert toxicity.weigh(toxicity.fold("Put it in the TRASH can."), automaton) == (0.0, 0)
    assert toxicity.weigh(toxicity.fold("trash can of trash"), automaton) == (2.0, 1)
    assert toxicity.weigh(toxicity.fold("clowns clown"), automaton) == (1.0, 1)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 60), max_size=20), st.lists(st.tuples(st.integers(0, 50), st.integers(0, 12)), max_size=12))
def test_places_outside_of_phrases(places, spans):
    spans = [(a, a + n) for a, n in spans]
    got = toxicity.outside(dict.fromkeys(places, 1.0), spans)
    assert set(got) == {i for i in places if not any(a <= i < z for a, z in spans)}


def test_very_many_phrases_in_one_text():
    automaton = toxicity.Model({" trash": 2.0}, toxicity.EXCEPTIONS).automaton()

    def seconds(n):
        words = ["trash", "can", "trash"] * n
        begin = time.process_time()
        assert toxicity.weigh(words, automaton) == (2.0 * n, n)
        return time.process_time() - begin

    few, many = min(seconds(2_500) for _ in range(3)), min(seconds(40_000) for _ in range(2))
    assert many < 60 * max(few, 0.005)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 0, "s") for i, t in rows], SCHEMA)


def made(n=1500):
    r = random.Random(4)
    plain = [f"{a}{b}{c}" for a in "bdfgk" for b in ("ala", "ero", "inu") for c in ("ton", "lem", "ver", "sk")]
    bad = ["gralbo", "gralbu", "gralbix", "stonk"]
    rows, labels = [], []
    for i in range(n):
        toxic = int(r.random() < 0.2)
        words = r.choices(plain, k=r.randrange(20, 120))
        if toxic:
            for _ in range(max(1, len(words) // 20)):
                words[r.randrange(len(words))] = r.choice(bad).replace("a", r.choice("a4@а")).replace("o", r.choice("o0"))
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    return rows, labels


def test_rows_that_were_not_learned_from(spark):
    rows, labels = made()
    docs = frame(spark, rows + [(9001, None), (9002, ""), (9003, "gralbo " * 20000), (9004, "x"), (9004, "x"), (None, "gralbix")])
    said = spark.createDataFrame([(i, 1, t) for i, t in labels] + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs, said)
    assert {" gral", " gralb", " gralbo", " gralb "} & set(model.lexicon)
    got = {r.doc_id: r for r in toxicity.scored(docs, model).collect()}
    assert got[9001].score == got[9002].score < 0.3 and got[9003].predicted == 1 and got[9004].predicted == 0
    right = 0
    for i, toxic in labels:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= got[i].score <= 1 and got[i].predicted == int(got[i].score >= 0.3)
        right += got[i].held_out and got[i].predicted == toxic
    assert right >= 0.98 * sum(got[i].held_out for i, _ in labels)


def test_labels_of_held_out_rows_change_nothing(spark):
    rows, labels = made(400)
    other = [(i, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in labels]
    docs = frame(spark, rows)
    one, two = (toxicity.learn(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, other))
    assert one == two


def test_nothing_to_learn_from(spark):
    docs = frame(spark, [(1, "some words"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.scored(docs, toxicity.learn(docs, none)).collect()
    assert len(got) == 2 and all(r.predicted == 0 for r in got)
    assert toxicity.scored(frame(spark, []), toxicity.Model()).count() == 0


def test_query_over_all_documents(spark):
    rows = {r.doc_id: r for r in QUERIES["op8_toxicity"](spark, SMALL).collect()}
    said = spark.read.parquet(f"{SMALL}/labels.parquet").collect()
    assert len(rows) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    unseen = [(rows[x.doc_id].score, x.toxic) for x in said if rows[x.doc_id].held_out]
    good = [s for s, t in unseen if t], [s for s, t in unseen if not t]
    pairs = [(a > b) + 0.5 * (a == b) for a in good[0] for b in good[1]]
    assert sum(pairs) / len(pairs) > 0.75  # forty toxic rows teach the words of one language
