import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from poolwright.llm import kneser_ney as m
from tests.llm import hard


def symbols(text):
    return [0] * (m.ORDER - 1) + m.CLASSES[np.frombuffer(text.encode(), np.uint8)].tolist()


class Plain:
    """Interpolated modified Kneser-Ney straight from its definition."""

    def __init__(self, texts):
        self.counts = {m.ORDER: Counter()}
        for t in texts:
            s = symbols(t)
            for i in range(m.ORDER - 1, len(s)):
                self.counts[m.ORDER][tuple(s[i - m.ORDER + 1 : i + 1])] += 1
        for n in range(m.ORDER - 1, 0, -1):
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        self.cut, self.total, self.gamma = {}, {}, {}
        for n, counts in self.counts.items():
            few = Counter(counts.values())
            if min(few[k] for k in (1, 2, 3, 4)):
                y = few[1] / (few[1] + 2 * few[2])
                cut = [max(m.LEAST, min(k, k - (k + 1) * y * few[k + 1] / few[k])) for k in (1, 2, 3)]
            else:
                cut = [0.5, 0.75, 0.9]
            self.cut[n] = cut
            total, left = defaultdict(int), defaultdict(float)
            for g, c in counts.items():
                total[g[:-1]] += c
                left[g[:-1]] += cut[min(c, 3) - 1]
            self.total[n], self.gamma[n] = total, {k: left[k] / total[k] for k in total}

    def p(self, gram):
        n = len(gram)
        if not n:
            return 1 / m.SYMBOLS
        lower = self.p(gram[1:])
        if gram[:-1] not in self.total[n]:
            return lower
        c = self.counts[n][gram]
        return max(c - self.cut[n][min(c, 3) - 1], 0) / self.total[n][gram[:-1]] + self.gamma[n][gram[:-1]] * lower if c else self.gamma[n][gram[:-1]] * lower

    def mean(self, text):
        s = symbols(text)
        return -sum(math.log(self.p(tuple(s[i - m.ORDER + 1 : i + 1]))) for i in range(m.ORDER - 1, len(s))) / (len(s) - m.ORDER + 1)


def prose(rng, n):
    return " ".join("".join(rng.choice(["ba", "du", "ki", "lo", "st"]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_perplexities_equal_the_definition(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, 40) + ".", "aa" if i % 3 else "bb") for i in range(40)] + [(90, "Zeß  §$ x", "aa"), (91, "b", "bb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    plain = {lang: Plain([t for i, t, x in rows if x == lang and i < 30]) for lang in ("aa", "bb")}
    got = {r.doc_id: r for r in m.classify(docs, labels).collect()}
    for i, t, lang in rows:
        assert math.log(got[i].perplexity) == pytest.approx(plain[lang].mean(t), abs=0.01), t
    assert all(got[i].kept for i in range(40)) and not got[90].kept


def test_probabilities_of_a_context_add_up(spark):
    rng = random.Random(2)
    rows = spark.createDataFrame([("aa", prose(rng, 200))], "lang string, text string")
    packed = m.tables(m.model(m.count_grams(rows))).collect()[0].packed
    table = np.exp(np.frombuffer(bytes(packed), np.float16).astype(float)).reshape(-1, m.SYMBOLS)
    assert np.allclose(table.sum(1), 1, atol=0.02)


def test_junk_in_a_language_without_latin_letters(spark):
    """Cyrillic words of one half of the alphabet against words of the same shape from the other half."""
    rng = random.Random(3)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(3, 8)))
    text = lambda letters: " ".join(word(letters) for _ in range(60))
    rows = [(i, text("абвгдежз"), "ru") for i in range(60)] + [(100 + i, text("ийклмноп"), "ru") for i in range(20)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(50)], "doc_id long, quality int, toxic int")
    got = m.classify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), labels).collect()
    assert all(r.kept == (r.doc_id < 100) for r in got) and len(got) == 80


def test_hard_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, None), (9, 1, 0), (9, 0, 0), (None, 1, 0), (7, None, None)], "doc_id long, quality int, toxic int")
    got = m.classify(hard.table(spark), labels).collect()
    assert len(got) == len(hard.rows())
    for r in got:
        assert (r.perplexity is None) == (r.threshold is None) or r.lang != "en"
    by = {r.doc_id: r for r in got}
    assert not by[4].kept and not by[5].kept and by[1].kept
    assert m.classify(hard.empty(spark), labels).collect() == []
    assert all(r.kept for r in m.classify(hard.table(spark).filter("text <> ''"), labels.filter("false")).collect())


def test_tasks_hold_few_of_many_languages(spark, monkeypatch):
    """More languages than a task holds: tables are read again, and every document meets its own language's."""
    monkeypatch.setattr(m, "HELD", 2)
    words = {f"l{k}": [chr(97 + (3 * k + j) % 26) * (1 + j % 3) for j in range(4)] for k in range(6)}
    rows = [(i, " ".join(words[f"l{i % 6}"][(i + j) % 4] for j in range(40)), f"l{i % 6}") for i in range(240)]
    labels = [(i, 1, 0) for i in range(240)]
    docs = spark.createDataFrame(rows + [(900, rows[1][1], "l0"), (901, "text", "none")], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in m.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert all(got[i].kept and got[i].perplexity < 3 for i in range(240))
    assert not got[900].kept and got[900].perplexity > 10 and got[901].kept and got[901].perplexity is None


def test_every_byte_is_a_symbol(spark):
    """Texts that differ in single characters, not in their kind, have different probabilities."""
    base = "the year 1987 brought 44 more; see http://a.b/c_d for it. "
    rows = [(i, base * 3, "aa") for i in range(20)] + [(50, base.replace("1987", "3052") * 3, "aa"), (51, base.upper() * 3, "aa"), (52, base.replace(";", "!").replace("/", "-") * 3, "aa")]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.perplexity for r in m.classify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), labels).collect()}
    assert len(set(m.CLASSES.tolist())) == 256 and all(got[i] > 1.2 * got[0] for i in (50, 51, 52))
