import math
import random
import re

import pytest
import xxhash

from poolwright.llm import ratio_rules as m
from tests.llm import hard

WORD = re.compile("[^\x20\x09-\x0d]+")


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def hash_of(word):
    return signed(xxhash.xxh64(word.encode(), seed=42).intdigest())


def pair_hash(a, b):
    first = xxhash.xxh64((a % (1 << 64)).to_bytes(8, "little"), seed=42).intdigest()
    return signed(xxhash.xxh64((b % (1 << 64)).to_bytes(8, "little"), seed=first).intdigest())


def features(text):
    h = [hash_of(w) for w in WORD.findall(text or "")]
    return [x % m.BUCKETS for x in h] + [pair_hash(a, b) % m.BUCKETS for a, b in zip(h, h[1:])]


def base(text):
    text = text or ""
    words = WORD.findall(text)
    at = {}
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i : i + 8]), []).append(i)
    repeated = {k for v in at.values() if len(v) > 1 for i in v for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)


def brute_force(rows, trusted):
    """Counts, verdicts and scores of all rows."""
    raw, target = [m.SMOOTH] * m.BUCKETS, [m.SMOOTH] * m.BUCKETS
    for i, t in rows:
        for f in features(t):
            raw[f] += 1
            target[f] += i in trusted
    w = [round(1e6 * (math.log(b / sum(target)) - math.log(a / sum(raw)))) for a, b in zip(raw, target)] if trusted & {i for i, _ in rows} else [0] * m.BUCKETS
    out = []
    for i, t in rows:
        f = features(t)
        counts = base(t)
        failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
        out.append((i, *counts, failed, math.floor(sum(w[x] for x in f) / len(f)) if f else None))
    scores = sorted(r[7] // m.BIN for r in out if r[0] in trusted and r[7] is not None and not r[6])
    least = -(1 << 62)
    if scores:
        tail = scores[: math.ceil(m.TAIL * len(scores))]
        others = max(1, len(tail) - 1)
        chi_square = (1 - 2 / (9 * 2 * others) - m.Z * math.sqrt(2 / (9 * 2 * others))) ** 3  # Wilson and Hilferty, a degree of freedom
        excess = sum(tail[-1] - x for x in tail) / others / chi_square
        least = math.floor((tail[-1] - excess * math.log(m.TAIL / m.QUANTILE)) * m.BIN)
    return sorted((*r[:7], not r[6] and (r[7] or 0) >= least, None if r[7] is None else r[7] / 1e6) for r in out)


def compared(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return sorted(map(tuple, m.judge(docs, table).collect()))


def texts():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(["ba", "du", "kiß", "lo"]) for _ in range(rng.randint(1, 3)))
    rows = []
    for i in range(80):
        t = " ".join(word() for _ in range(rng.randint(0, 120)))
        if i % 5 == 1:
            t += "\n" + t
        if i % 7 == 2:
            t = "\x0b".join(w + rng.choice(["%%%", "$", "<"]) for w in t.split()) + " \t"
        if i % 11 == 3:
            t = "same line\n" * rng.randint(1, 9) + "\n \n" + t
        rows.append((i, t))
    return rows


def test_all_columns_equal_brute_force(spark):
    rows = texts()
    trusted = {i for i, _ in rows if i % 7 != 2 and i < 60}
    labels = [(i, int(i in trusted), 0) for i, _ in rows] + [(3, 0, 0), (4, 1, 1)]
    assert compared(spark, rows, labels) == brute_force(rows, trusted - {3, 4})


def test_windows_that_repeat_next_to_each_other(spark):
    rows = [(i, t) for i, t in enumerate(["a " * n for n in range(30)] + ["a b c d e f g h " * n for n in range(4)] + ["a b c d e f g h i a b c d e f g h", "1 2 3 4 5 6 7 8 9 2 3 4 5 6 7 8 9 1"])]
    got = [r[:7] for r in compared(spark, rows, [])]
    assert got == [r[:7] for r in brute_force(rows, set())]


def test_junk_falls_and_trusted_text_stays(spark):
    rng = random.Random(5)
    good = [(i, " ".join(rng.choice("der die das und oder nicht mit von zu auf".split()) for _ in range(80))) for i in range(60)]
    odd = ["".join(rng.choice("qxzjw#%$") for _ in range(6)) for _ in range(30)]
    junk = [(100 + i, " ".join(rng.choice(odd) for _ in range(80))) for i in range(10)]
    got = compared(spark, good + junk, [(i, 1, 0) for i in range(30)])
    assert all(r[7] == (r[0] < 100) for r in got)


def test_symbol_stuffed_copies_of_trusted_text_fall(spark):
    """Half of a copy's words are trusted ones, the others carry symbols."""
    rng = random.Random(6)
    words = "der die das und oder nicht mit von zu auf im am aus bei nach seit".split()
    good = [(i, " ".join(rng.choice(words) for _ in range(60))) for i in range(1200)]
    stuffed = [(2000 + i, " ".join(w + rng.choice("$%#*") * 3 if k % 2 else w for k, w in enumerate(t.split()))) for i, t in good[:200]]
    got = compared(spark, good + stuffed, [(i, 1, 0) for i, _ in good])
    assert sum(not r[7] for r in got if r[0] < 2000) <= 2
    assert not any(r[7] for r in got if r[0] >= 2000)


@pytest.mark.parametrize("n", [50, 1000, 5000])
def test_threshold_is_one_rule_for_few_and_many_trusted_scores(n):
    """Exponential tails lose about the share that is asked for, whatever the number of scores; clearly lower scores fall."""
    rng = random.Random(n)
    lost = []
    for _ in range(200):
        bins = {}
        for _ in range(n):
            x = math.floor(-rng.expovariate(1 / 40))
            bins[x] = bins.get(x, 0) + 1
        least = m.tail_bound(bins) / m.BIN
        lost.append(math.exp(least / 40))
    assert sorted(lost)[100] < m.QUANTILE
    assert sum(x <= m.QUANTILE for x in lost) >= 180
    assert n < 1000 or sorted(lost)[100] > m.QUANTILE / 10


def test_threshold_of_no_or_equal_scores():
    assert m.tail_bound({}) == -(1 << 62)
    assert m.tail_bound({7: 1}) == m.tail_bound({7: 4000}) == 7 * m.BIN


def test_hard_rows(spark):
    rows = [r[:2] for r in hard.rows()]
    got = m.judge(hard.table(spark), spark.createDataFrame([(1, 1, None), (None, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")).collect()
    wanted = brute_force([(i if i is not None else -1, t) for i, t in rows], {1})
    assert sorted((r.doc_id if r.doc_id is not None else -1, *tuple(r)[1:]) for r in got) == wanted
    assert m.judge(hard.empty(spark), spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect() == []


def test_no_python_in_the_plan(spark):
    df = m.judge(hard.table(spark), spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int"))
    assert "Python" not in df._jdf.queryExecution().toString() and "Arrow" not in df._jdf.queryExecution().toString()
    pytest.importorskip("xxhash")
