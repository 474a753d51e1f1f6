"""Quality rules: plain counts, and a log-likelihood ratio of hashed n-grams.

Words and pairs of words are hashed into ``BUCKETS`` buckets. Two multinomials over the
buckets are counted, one of trusted text and one of the whole corpus; a document's
score is the mean over its n-grams of the logarithm of their ratio. Length thus
does not matter, and text unlike the trusted one scores low. The threshold is the
``QUANTILE`` of the trusted documents' scores, read off the tail of their lowest ``TAIL``: how far these
lie below the highest of them, on average, is the scale of an exponential tail. The upper 95 % bound of that
scale is taken, so clean text stays where few scores show it. The rule is the same for few and many trusted documents, takes
all of them, and draws nothing at random.

Only DataFrame expressions: a document's words stay in its row, and only bucket
counts are shuffled. Weights and score bins are whole numbers (millionths), so sums do
not depend on their order. The bucket table, of fixed size, is all that reaches the driver.

Null and empty texts have no words; they fail the base rules and have no score. Rows
may repeat; each is judged alike. Without trusted text every score is that of the
corpus against itself, 0, and only the base rules decide.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poolwright.llm.common import column
from poolwright.session import materialize

BUCKETS = 10_000
#: Added to every bucket's count.
SMOOTH = 1.0
#: Share of trusted documents that may fall below the threshold, and the share of the lowest that show the tail.
QUANTILE, TAIL = 0.001, 0.1
#: Normal quantile of the scale's upper bound, one-sided 95 %.
Z = 1.645
#: Scores are counted in bins of this many millionths.
BIN = 1000
#: Bytes of trusted ids that may be broadcast; more are joined by a shuffle.
BROADCAST_BYTES = 64 << 20

BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once a row, also where it is used inside lambdas."""
    return F.transform(F.array(value), then)[0]


def words_of(text: Column) -> Column:
    """Runs of characters that are no white space."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK_CLASS + "+"))


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def buckets(hashes: Column) -> Column:
    """Buckets of the words and of the pairs of neighbouring words of a text."""
    m = F.lit(BUCKETS).cast("long")
    singles = F.transform(hashes, lambda h: F.pmod(h, m).cast("int"))
    pairs = F.transform(F.sequence(F.lit(1), F.size(hashes) - 1), lambda i: F.pmod(F.xxhash64(hashes[i - 1], hashes[i]), m).cast("int"))
    return F.when(F.size(hashes) > 1, F.concat(singles, pairs)).otherwise(singles)


def repeated_words(hashes: Column, size: int = 8) -> Column:
    """Words within windows of ``size`` words that occur twice or more."""
    windows = F.transform(F.sequence(F.lit(0), F.size(hashes) - size), lambda i: F.xxhash64(*[hashes[i + k] for k in range(size)]))

    def count(found: Column) -> Column:
        placed = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(placed, lambda p: let(F.sort_array(F.transform(F.filter(p, lambda x, i: twin(p, x, i)), lambda x: x["i"])), covered))

    def twin(p: Column, x: Column, i: Column) -> Column:
        return F.when(i > 0, p[F.greatest(i - 1, F.lit(0))]["h"] == x["h"]).otherwise(False) | F.when(
            i + 1 < F.size(p), p[F.least(i + 1, F.size(p) - 1)]["h"] == x["h"]).otherwise(False)

    def covered(places: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(-size).alias("last"))
        return F.aggregate(places, start, lambda a, x: F.struct((a["n"] + F.least(F.lit(size), x - a["last"])).alias("n"), x.alias("last")), lambda a: a["n"])

    some = let(windows, lambda v: F.when(F.size(F.array_distinct(v)) == F.size(v), F.lit(0)).otherwise(count(v)))
    return F.when(F.size(hashes) <= size, F.lit(0)).otherwise(some)


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def base_counts(text: Column) -> dict[str, Column]:
    """Counts of a text that need no words."""
    return {
        "word_chars": F.char_length(F.regexp_replace(text, BLANK_CLASS + "+", "")).cast("long"),
        "n_symbols": (F.char_length(text) - F.char_length(F.regexp_replace(text, "[#*$%&|<>]+", ""))).cast("long"),
        "n_dup_lines": duplicate_lines(text).cast("long"),
    }


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids whose labels all say good and not toxic."""
    rows = labels.select(column(labels, "doc_id", "long").alias("trusted_id"), column(labels, "quality", "int").alias("q"), column(labels, "toxic", "int").alias("t"))
    good = (F.col("q") == 1) & (F.coalesce("t", F.lit(0)) == 0)
    return rows.filter("trusted_id is not null").groupBy("trusted_id").agg(F.min(F.coalesce(good, F.lit(False)).cast("int")).alias("good")).filter("good = 1").select("trusted_id")


def flagged(rows: DataFrame, trusted: DataFrame) -> DataFrame:
    """``rows`` with ``trusted``; ids are broadcast where their counted size allows."""
    trusted = materialize(trusted, "trusted")
    if trusted.count() * 16 <= BROADCAST_BYTES:
        trusted = F.broadcast(trusted)
    return rows.join(trusted, rows["doc_id"] == trusted["trusted_id"], "left").withColumn("trusted", F.col("trusted_id").isNotNull()).drop("trusted_id")


def weights(rows: DataFrame) -> list[int]:
    """Logarithm, in millionths, of the ratio of trusted to corpus share of every bucket."""
    each = rows.select("trusted", F.explode(let(word_hashes(words_of(F.col("text"))), buckets)).alias("bucket"))
    counts = each.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum(F.col("trusted").cast("long")).alias("target")).collect()
    raw, target = [SMOOTH] * BUCKETS, [SMOOTH] * BUCKETS
    for r in counts:
        raw[r["bucket"]] += r["raw"]
        target[r["bucket"]] += r["target"]
    all_raw, all_target = sum(raw), sum(target)
    if all_target == SMOOTH * BUCKETS:
        return [0] * BUCKETS
    return [round(1e6 * (math.log(t / all_target) - math.log(r / all_raw))) for r, t in zip(raw, target)]


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts, score and verdict of every row."""
    rows = docs.select(column(docs, "doc_id", "long").alias("doc_id"), F.coalesce(column(docs, "text", "string"), F.lit("")).alias("text"))
    rows = flagged(rows, trusted_ids(labels))
    table = F.from_json(F.lit(json.dumps(weights(rows))), "array<bigint>")

    def from_words(words: Column) -> Column:
        return let(word_hashes(words), lambda h: F.struct(
            F.size(h).cast("long").alias("n_words"), repeated_words(h).cast("long").alias("n_repeat_words"),
            let(buckets(h), lambda b: F.when(F.size(b) > 0, F.aggregate(b, F.lit(0).cast("long"), lambda a, x: a + table[x]) / F.size(b))).alias("mean")))

    text = F.col("text")
    found = rows.select("doc_id", "trusted", *[c.alias(n) for n, c in base_counts(text).items()], from_words(words_of(text)).alias("w"))
    found = found.select(
        "doc_id", "trusted", F.col("w.n_words").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        F.col("w.n_repeat_words").alias("n_repeat_words"), F.floor("w.mean").cast("long").alias("score_millionths"))
    found = materialize(found, "judged")
    least = threshold(found)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (F.coalesce("score_millionths", F.lit(0)) >= least)).alias("kept"), (F.col("score_millionths") / 1e6).alias("score"))


def threshold(found: DataFrame) -> int:
    """Score, in millionths, below which a document is dropped: from all trusted scores, counted in bins."""
    scored = found.filter("trusted and score_millionths is not null and n_words >= 20 and 100 * n_repeat_words <= 30 * n_words")
    # a mean log ratio is bounded by the counts, so bins are few
    bins = scored.groupBy(F.floor(F.col("score_millionths") / BIN).alias("bin")).count().collect()
    return tail_bound({r["bin"]: r["count"] for r in bins})


def tail_bound(bins: dict[int, int]) -> int:
    """The ``QUANTILE`` of binned scores under an exponential tail, in millionths; lower than any score where there is none."""
    if not bins:
        return -(1 << 62)
    held = math.ceil(TAIL * sum(bins.values()))
    left, below = held, 0
    for edge in sorted(bins):
        below += min(left, bins[edge]) * edge
        left -= min(left, bins[edge])
        if not left:
            break
    # the highest of the tail is its edge; the others show the scale, a chi-square over its degrees of freedom
    others = max(1, held - 1)
    spread = 1 / (9 * others)
    scale = (held * edge - below) / others / (1 - spread - Z * math.sqrt(spread)) ** 3
    return math.floor((edge - scale * math.log(TAIL / QUANTILE)) * BIN)
