import random
import zlib

import numpy as np
import pytest

from poolwright.llm import language_id as m
from tests.llm import hard

WORDS = {"en": "the of and that with from have this".split(), "de": "der die und nicht mit auch sich eine".split(), "fr": "le les des une dans pour avec est".split()}


def prose(lang, rng, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


def greedy(sample, text):
    """Phrases of a text, each the longest that occurs in the sample, or one unseen byte."""
    n = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample:
            size += 1
        n, at = n + 1, at + size
    return n


def test_phrases_equal_a_search_for_the_longest_match():
    rng = random.Random(1)
    for _ in range(200):
        sample = bytes(rng.choice(b"abcd ") for _ in range(rng.randint(1, 40)))
        text = bytes(rng.choice(b"abcde ") for _ in range(rng.randint(0, 60)))
        model = m.Model({"x": sample})
        blocks = np.zeros((max(1, len(text)), 1), np.int32)
        blocks[: len(text), 0] = model.codes[np.frombuffer(text, np.uint8)]
        assert m.phrases(model.tables[0], blocks)[0] == greedy(sample, text)


def test_costs_take_all_blocks_of_a_text(monkeypatch):
    monkeypatch.setattr(m, "BLOCK", 8)
    monkeypatch.setattr(m, "STEP_BYTES", 64)
    model = m.Model({"x": b"abcabd", "y": b"zzz"})
    texts = [b"abcabdabcabd", b"", b"zzzzzzzzzzzzzzzzz", b"a"]
    flat, bounds = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    costs = model.costs(flat, bounds)
    for k, sample in enumerate((b"abcabd", b"zzz")):
        for i, text in enumerate(texts):
            wanted = sum(greedy(sample, text[a : a + 8]) for a in range(0, len(text), 8))
            assert costs[k, i] == (pytest.approx(wanted * np.log2(len(sample)) / len(text)) if text else np.inf)


def test_held_out_documents_are_recognised_and_not_learned_from(spark):
    rng = random.Random(2)
    rows = [(i, prose(lang, rng, rng.randint(3, 60)), lang) for i in range(300) for lang in [rng.choice(list(WORDS))]]
    # wrong labels of held-out rows must not matter
    rows = [(i, t, "fr" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    truth = {i: next(k for k, w in WORDS.items() if t.split()[0] in w) for i, t, _ in rows}
    got = m.predict_documents(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in got]) > 0.98


def test_hard_rows(spark):
    got = m.predict_documents(hard.table(spark)).collect()
    assert len(got) == len(hard.rows())
    for r in got:
        assert 0 <= r.score <= 1
    by = {r.doc_id: r for r in got}
    assert {by[i].lang_pred for i in (4, 5, 6, 11)} == {"und"} and by[4].score == 0
    assert by[7].lang_pred == by[9].lang_pred == "en"


def test_nothing_labelled(spark):
    assert m.predict_documents(hard.empty(spark)).collect() == []
    only = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in m.predict_documents(only).collect()] == [("und", 0.0)]
