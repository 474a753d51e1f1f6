import random
import re
from fractions import Fraction

import numpy as np
import pytest

from poolwright.llm import jaccard_join as m
from poolwright.llm.components import components
from tests.llm import hard


def shingle_set(text, size):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if len(words) >= size else frozenset([tuple(words)] if words else [])


def brute_force(rows, size, threshold):
    """(doc_id, n_shingles, component) of each row, by comparing all pairs."""
    sets = [shingle_set(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) * threshold.denominator >= threshold.numerator * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted(((doc, len(sets[i]), least.get(find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows)), key=str)


def family(rng, words, n, edits):
    """Texts that differ from one base in a few words each."""
    base = [rng.choice(words) + str(rng.randint(0, 99)) for _ in range(rng.randint(5, 200))]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(len(own))] = rng.choice(words)
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize(("size", "threshold"), [(3, Fraction(9, 10)), (5, Fraction(8, 10)), (1, Fraction(1, 2))])
def test_components_equal_brute_force(spark, size, threshold):
    rng = random.Random(size)
    texts = [t for _ in range(25) for t in family(rng, ["ab", "Cd", "ef", "gh"], rng.randint(1, 9), 4)]
    rows = [(i, t) for i, t in enumerate(rng.sample(texts, len(texts)))]
    got = m.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size, threshold)
    assert sorted(map(tuple, got.drop("class_key").collect()), key=str) == brute_force(rows, size, threshold)


def test_similar_sets_share_a_signature():
    """Pairs right at the threshold, of all sizes, over band edges too."""
    rng = np.random.default_rng(1)
    for threshold in (Fraction(9, 10), Fraction(8, 10), Fraction(1, 2)):
        bands = m.Bands(threshold)
        for n in [*range(1, 60), 97, 250, 1001, 5000]:
            a = np.unique(rng.integers(0, 1 << 63, n, np.uint64))
            most = int(n * (1 - threshold) / threshold)  # elements that b may have more
            for more in {0, most // 2, most}:
                b = np.unique(np.concatenate([a, rng.integers(0, 1 << 63, more, np.uint64)]))
                if len(a) * threshold.denominator < threshold.numerator * len(b) or len(a) == len(b):
                    continue
                sigs, owner = m.signatures([a, b], bands)
                assert set(sigs[owner == 0]) & set(sigs[owner == 1]), (threshold, n, more)
            swap = int(n * (1 - threshold) / (1 + threshold))  # elements exchanged between sets of one size
            c = np.unique(np.concatenate([a[swap:], rng.integers(0, 1 << 63, swap, np.uint64)]))
            if swap:
                sigs, owner = m.signatures([a, c], bands)
                assert set(sigs[owner == 0]) & set(sigs[owner == 1]), (threshold, n, swap)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(7)
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)] + [(5, 5), (None, 1)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(links, "a long, b long"))
    assert {(r.node, r.root) for r in got.collect()} == {(x, find(x)) for x in root if x != 5 or True}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_hard_rows(spark):
    got = m.near_duplicates(hard.table(spark), 3, Fraction(9, 10)).drop("class_key").collect()
    assert sorted(map(tuple, got), key=str) == brute_force([r[:2] for r in hard.rows()], 3, Fraction(9, 10))
    assert m.near_duplicates(hard.empty(spark)).collect() == []


def test_one_of_each(spark):
    docs = hard.table(spark)
    kept = m.one_of_each(docs)
    assert kept.columns == docs.columns
    rows = [r[:2] for r in hard.rows()]
    with_words = {c for d, n, c in brute_force(rows, 5, Fraction(8, 10)) if n}
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(d for d, t in got if shingle_set(t, 5)) == sorted(with_words)
    assert sum(not shingle_set(t, 5) for _, t in got) == sum(not shingle_set(t, 5) for _, t in rows)
    assert m.one_of_each(hard.empty(spark)).collect() == []


def test_key_filter_holds_every_key_and_few_others(spark):
    rng = np.random.default_rng(9)
    keys, others = (rng.integers(-(1 << 63), (1 << 63) - 1, 5000) for _ in range(2))
    made = m.key_filter(spark.createDataFrame([(int(k),) for k in keys], "key long"))
    assert m.may_hold(made, keys).all() and m.may_hold(made, others).mean() < 0.05
    assert not m.may_hold(m.key_filter(spark.createDataFrame([], "key long")), others).any()


@pytest.mark.parametrize(("named", "members"), [(1, 2048), (3, 7), (32, 2048)])
def test_pairs_under_many_signatures_leave_at_least_once(spark, monkeypatch, named, members):
    """All possible pairs of different components under one signature, however many signatures a member names and however it is split."""
    monkeypatch.setattr(m, "NAMED", named)
    monkeypatch.setattr(m, "MEMBERS", members)
    rng = random.Random(11)
    threshold = Fraction(1, 2)
    sets = {k: np.array(sorted(rng.sample(range(40), 24)), np.uint64) for k in range(1, 31)}
    under = {k: {rng.randint(-6, 6) for _ in range(6)} for k in sets}
    rows = [(sig, k, k // 2, len(s), bytearray(m.sketch(s))) for k, s in sets.items() for sig in sorted(under[k])]
    got = m.pairs_of_open(spark.createDataFrame(rows, "sig long, key long, root long, n_shingles long, sketch binary"), threshold).collect()
    words = {k: m.folded([m.sketch(s)])[0] for k, s in sets.items()}
    possible = {
        (a, b) for a in sets for b in sets if b < a and b // 2 != a // 2 and under[a] & under[b]
        and m.may_link(np.array([np.bitwise_count(words[a] ^ words[b]).sum()], np.int64), np.array([24]), np.array([24]), threshold)[0]}
    assert {(r.a, r.b) for r in got} == possible and possible


def test_a_pair_leaves_under_its_lowest_signature():
    s = m.sketch(np.arange(50, dtype=np.uint64))
    rows = [(1, 1, 50, s, 0, [-5, 3, 9]), (2, 2, 50, s, 0, [-7, 3, 9]), (3, 3, 50, s, 0, [9])]
    pairs = lambda sig, held: {(int(a), int(b)) for x, y in m._pairs_apart(sig, held, Fraction(4, 5)) for a, b in zip(x, y)}
    assert pairs(3, rows[:2]) == {(2, 1)} and pairs(9, rows) == {(3, 1), (3, 2)}


def test_sketches_are_shuffled_under_their_signatures_once(spark):
    members = spark.createDataFrame([(7, k, k) for k in range(1, 6)], "sig long, key long, root long")
    sketches = spark.createDataFrame([(k, 24, bytearray(m.sketch(np.arange(24, dtype=np.uint64)))) for k in range(1, 6)], "key long, n_shingles long, sketch binary")
    plan = m.pairs_of_open(members, Fraction(4, 5), sketches)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    moved = re.findall(r"\) Exchange\s*\nInput \[\d+\]: \[([^\n]*)\]", plan)
    assert sum("sketch#" in x and "sig#" in x for x in moved) == 1 and len(moved) > 1


def test_signatures_are_sorted_in_pieces(spark, monkeypatch):
    texts = [" ".join(f"w{(i if i % 9 else 0) % (40 + k % 3)}" for i in range(60)) for k in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    whole = {(r.doc_id, r.component_id) for r in m.near_duplicates(docs).collect()}
    monkeypatch.setattr(m, "SIGNED", 1)
    assert {(r.doc_id, r.component_id) for r in m.near_duplicates(docs).collect()} == whole and len({c for _, c in whole}) < 30
