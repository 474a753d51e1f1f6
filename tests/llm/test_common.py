import random
import re

import numpy as np
import pyarrow as pa

from poolwright.llm import common as m
from tests.llm import hard


def texts(seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("aBé \t\n\x0b\x0c\r日") for _ in range(rng.randint(0, 40))) for _ in range(60)] + ["", " ", "A", None]


def test_words_of_texts_are_those_of_the_rule():
    for seed in range(20):
        rows = texts(seed)
        flat, bounds = m.utf8(pa.array(rows, pa.string()))
        hashes, at = m.word_hashes(flat, bounds)
        words = [re.findall("[^\x20\x09-\x0d]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) for t in rows]
        assert np.diff(at).tolist() == [len(w) for w in words]
        by: dict[str, int] = {}
        for word, h in zip([x for w in words for x in w], hashes.tolist()):
            assert by.setdefault(word, h) == h  # equal words, equal hashes
        assert len(set(by.values())) == len(by)


def test_shingles_do_not_cross_texts():
    rows = ["a b c d", "a b", "b a", "a", "", "c d a b c"]
    sets = [set(s.tolist()) for s in m.shingles(*m.utf8(pa.array(rows)), 3)]
    assert [len(s) for s in sets] == [2, 1, 1, 1, 0, 3]
    assert len(sets[0] & sets[5]) == 1 and sets[1] != sets[2] and not sets[1] & sets[3]


def test_slices_hold_every_row_once():
    rows = [t for t in texts(1)] + ["x" * 5000]
    batch = pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], ["text"])
    for most in (1, 50, 1 << 20):
        parts = list(m.in_slices(iter([batch, batch.slice(3, 7), batch.slice(0, 0)]), "text", most))
        assert [t for p in parts for t in p.column("text").to_pylist()] == rows + rows[3:10]
        for p in parts:
            assert p.num_rows == 1 or sum(len((t or "").encode()) for t in p.column("text").to_pylist()) <= most


def test_a_sliced_array_keeps_its_own_bytes():
    a = pa.array(["ab", None, "é", "cd"]).slice(1, 3)
    flat, bounds = m.utf8(a)
    assert bytes(flat) == "écd".encode() and bounds.tolist() == [0, 0, 2, 4]


def test_settings_are_put_back(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    with m.frugal(spark, 1234):
        assert spark.conf.get(name) == "1234"
    assert spark.conf.get(name) == before


def test_a_missing_column_is_null(spark):
    df = hard.table(spark).drop("text")
    assert df.select(m.column(df, "text", "string").alias("t")).filter("t is not null").count() == 0
    assert df.select(m.column(df, "DOC_ID", "long").alias("d")).filter("d = 9").count() == 1
