import hashlib
import random
from collections import Counter

import pytest

from poolwright.llm import suffix_dedup as m
from tests.llm import hard


def brute_force(texts):
    """(bytes, removed bytes, runs, digest of the rest) of each text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + m.WINDOW] for d in data for i in range(len(d) - m.WINDOW + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - m.WINDOW + 1):
            if seen[d[i : i + m.WINDOW]] > 1:
                gone[i : i + m.WINDOW] = b"\1" * m.WINDOW
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(c for c, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_array():
    rng = random.Random(1)
    for _ in range(2000):
        text = [rng.randint(1, rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, 40))] + [0]
        assert m.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_trie_paths_share_nodes_up_to_the_common_prefix():
    rng = random.Random(2)
    for _ in range(400):
        strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 7))) for _ in range(rng.randint(1, 9))]
        paths = m.trie_paths(strings)
        for a, p in zip(strings, paths):
            assert [d for d, _ in p] == sorted({d for d, _ in p}) and (not a or p[-1][0] == len(a))
            for b, q in zip(strings, paths):
                assert all((node in q) == (node[0] <= m.common_prefix(a, b)) for node in p)


def passages(rng, n):
    line = lambda k: "".join(rng.choice("abcdefgh é") for _ in range(k))
    shared = [line(rng.choice([90, 150, 199, 200, 201, 230, 400, 900])) for _ in range(14)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(shared)
            if rng.random() < 0.3:
                k = rng.randrange(len(p))
                p = p[:k] + rng.choice(["", "X", "YZ"]) + p[k + 1 :]
            parts += [p, line(rng.randint(0, 120))]
        out.append("".join(parts))
    out += ["ab" * 300, "ab" * 700, "a" * 199, "a" * 200, "a" * 201, "b" * 400, line(3000), None, "", out[0], out[0]]
    return out


@pytest.mark.parametrize("group", [1, 3, 2000])
def test_removed_bytes_equal_brute_force(spark, monkeypatch, group):
    """Groups that are compared by suffix arrays, in ranges, and by counts of windows."""
    monkeypatch.setattr(m, "GROUP", group)
    texts = passages(random.Random(group), 60)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: tuple(r)[1:] for r in m.dedup_digests(rows).collect()}
    wanted = brute_force(texts)
    assert sum(w[1] for w in wanted) > 5000
    assert [got[i] for i in range(len(texts))] == wanted


def test_texts_longer_than_a_block():
    rng = random.Random(6)
    data = "".join(rng.choice("abcd") for _ in range(700))
    import numpy as np

    old, m.BLOCK = m.BLOCK, 128
    try:
        h, _, place = m.anchors(np.frombuffer(data.encode(), np.uint8))
    finally:
        m.BLOCK = old
    covered = sorted(s for p in place.tolist() for s in range(p >> 16, (p >> 16) + (p & 255)))
    assert covered == list(range(len(data) - m.WINDOW + 1))
    whole = m.anchors(np.frombuffer(data.encode(), np.uint8))
    owner = {s: (int(x), (p >> 16) + ((p >> 8) & 255)) for x, p in zip(whole[0], whole[2].tolist()) for s in range(p >> 16, (p >> 16) + (p & 255))}
    assert all(owner[s] == (int(x), (p >> 16) + ((p >> 8) & 255)) for x, p in zip(h, place.tolist()) for s in range(p >> 16, (p >> 16) + (p & 255)))


def test_hard_rows(spark):
    texts = [r[1] for r in hard.rows()]
    got = m.dedup_digests(hard.table(spark)).collect()
    assert sorted(tuple(r) for r in got if r.doc_id is not None) == sorted((r[0], *w) for r, w in zip(hard.rows(), brute_force(texts)) if r[0] is not None)
    assert len(got) == len(texts) and m.dedup_digests(hard.empty(spark)).collect() == []


def test_without_repeats(spark):
    docs = hard.table(spark)
    kept = m.without_repeats(docs)
    assert kept.schema == docs.schema
    rows = kept.collect()
    gone = [w for w, r in zip(brute_force([r[1] for r in hard.rows()]), hard.rows()) if w[0] and w[0] == w[1]]
    assert len(rows) == len(hard.rows()) - len(gone)
    assert all(r.n_chars is None or r.n_chars == len(r.text) for r in rows)
    assert {r.doc_id for r in rows if r.text is None} == {4, None}
    assert m.without_repeats(hard.empty(spark)).collect() == []


def test_without_repeats_keeps_columns_of_any_name(spark):
    same = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(400))
    rows = [(1, "a " + same, "x", 5, 7), (2, "b " + same, "y", 6, 8), (3, None, "z", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, Text string, dedup_text string, dedup_k1 long, row long")
    kept = m.without_repeats(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [(1, "a", "x", 5, 7), (2, "b", "y", 6, 8), (3, None, "z", None, None)]
