import random
import zlib

import numpy as np
import pytest

from poolwright.llm import toxic_passages as m
from poolwright.llm.common import utf8
from tests.llm import hard
import pyarrow as pa


def maximal(scores):
    """All maximal segments by their recursive definition: the best one, then both sides of it."""
    def best(a, b):
        found = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += scores[j]
                # of equal sums the shortest, of those the first
                if total > 0 and (found is None or total > found[0] + 1e-9 or (abs(total - found[0]) <= 1e-9 and j + 1 - i < found[2] - found[1])):
                    found = (total, i, j + 1)
        return found

    def split(a, b):
        found = best(a, b)
        if found is None:
            return []
        return split(a, found[1]) + [(found[1], found[2], found[0])] + split(found[2], b)

    return split(0, len(scores))


def test_segments_equal_the_recursive_definition():
    rng = random.Random(1)
    for _ in range(400):
        # irregular fractions: no two sums are equal
        scores = [rng.uniform(-3, 3) for _ in range(rng.randint(0, 25))]
        got = m.segments(np.array(scores))
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in maximal(scores)]
        assert [s for *_, s in got] == pytest.approx([s for *_, s in maximal(scores)])


def test_tokens_share_their_beginnings():
    flat, bounds = utf8(pa.array(["Alphabet alphabets, alp", None, "alphabet"]))
    found, at, starts, ends = m.tokens(flat, bounds)
    assert at.tolist() == [0, 3, 3, 4] and (ends - starts).tolist() == [8, 9, 3, 8]
    assert found[-1, 0] == found[-1, 3] and found[-1, 0] != found[-1, 1]
    assert (found[:-1, 0] == found[:-1, 1]).all() and (found[:, 2] != found[:, 0]).any()


STEMS = ("zork", "quibble", "vexat")


def corpus(seed, n):
    """Clean words of many syllables; toxic texts hold two to four words of a few stems with any ending."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(("ba", "do", "li", "mu", "ten", "sor")) for _ in range(rng.randint(1, 4)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(0, 120))]
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(rng.randint(2, 4)):
                words.insert(rng.randint(0, len(words)), rng.choice(STEMS) + word())
        rows.append((i, " ".join(words) + "."))
        held = zlib.crc32(str(i).encode()) % 4 == 2
        # labels of held-out rows are wrong: they must not be learned from
        labels.append((i, int(toxic) if not held else int(not toxic), toxic))
    return rows, labels


def test_held_out_documents_are_told_apart(spark):
    rows, truth = corpus(2, 1500)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, label) for i, label, _ in truth], "doc_id long, toxic int")
    got = {r.doc_id: r for r in m.score_documents(docs, labels).collect()}
    assert len(got) == 1500
    toxic = {i: t for i, _, t in truth}
    held = [i for i in got if got[i].held_out]
    assert held and all(zlib.crc32(str(i).encode()) % 4 == 2 for i in held)
    assert np.mean([got[i].predicted for i in held if toxic[i]]) > 0.9
    assert np.mean([got[i].predicted for i in held if not toxic[i]]) < 0.03
    found = m.passages(docs, m.fit(docs, labels)).collect()
    text = dict(rows)
    for r in found:
        assert text[r.doc_id].encode()[r.first_byte : r.end_byte].decode() == r.passage and r.chance < m.LEVEL
    assert np.mean([any(s in r.passage for s in STEMS) for r in found]) > 0.95


def test_evidence_grows_with_passages_and_steps_rise():
    law = m.Law(rate=1.0, place=0.0, width=1.0)
    one = law.evidence([(0, 1, 12.0)], 100)
    assert law.evidence([], 100) == 0 < law.evidence([(0, 1, 3.0)], 100) < one < law.evidence([(0, 1, 12.0), (5, 6, 12.0)], 100)
    steps = m._steps([(0.0, 0, 90), (0.0, 1, 1), (1.0, 0, 5), (1.0, 1, 5), (2.0, 0, 6), (2.0, 1, 4), (3.0, 1, 9)])
    assert [p for _, p in steps] == sorted(p for _, p in steps) and len(steps) == 3


def test_one_label_or_none(spark):
    docs = hard.table(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in m.score_documents(docs, none).collect()} == {0.0}
    ones = spark.createDataFrame([(i, 1) for i in range(20)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    assert {r.score for r in m.score_documents(docs, ones).collect()} == {1.0}
    assert m.passages(docs, m.fit(docs, none)).collect() == []


def test_hard_rows(spark):
    rows, truth = corpus(3, 600)
    # ids of the learned rows lie apart from those of the hard ones, but for labels that repeat and clash
    learned = spark.createDataFrame([(i + 100, t, "x", 1.0) for i, t in rows], "doc_id long, text string, toxic string, score double")
    labels = spark.createDataFrame([(i + 100, int(t)) for i, _, t in truth] + [(100, 0), (100, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    model = m.fit(learned, labels)
    got = m.score(hard.table(spark), model).collect()
    assert len(got) == len(hard.rows()) and all(0 <= r.score < m.THRESHOLD for r in got)
    assert m.score(hard.empty(spark), model).collect() == []
    assert m.score_documents(hard.empty(spark), labels).collect() == []
