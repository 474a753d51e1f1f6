"""Toxic passages by maximum-scoring segments of token log-odds.

**Weights.** A token is a run of letters. Documents that hold it, and its first bytes, are counted by label
in a fixed number of hashed buckets, over all labelled rows that may be learned from. A word's
log-odds come from a chain of Dirichlet priors: the share of toxic documents
among those with the word is smoothed by the share of its longest beginning, that one by the
next shorter, the shortest by the share in all documents. So words never seen lean on their stem, and rare ones stay near 0.

**Passages.** A linear scan (all maximal scoring segments, Ruzzo and Tompa) finds the runs of tokens whose
scores, less ``DRIFT`` a token, add up highest. Tokens of a negative score between two
positive ones are summed by array operations, so the loop runs over positive tokens only.

**Calibration.** The best segment of a clean text of n tokens follows an extreme-value law in
lambda * S - ln n. Lambda makes the clean tokens' mean of exp(lambda * s) one; place and width are
fitted to the clean labelled documents. Segments whose tail probability is below ``LEVEL`` are passages.
Several passages of a document are aggregated by the law of the sum of its r best ones. The probability of a label is a
rising step function of that evidence, interpolated.

Labelled rows are scored for the calibration by weights that leave out their own third of the documents.

Rows: a null text is empty; an empty one has no evidence. Null labels are not learned from; of several labels of one id the
highest counts, and repeated rows count as often as they stand. Null ids carry no label. Without both labels
among the learned rows every score is the share of toxic ones (0 without labels). Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolwright.llm.common import BASE, INVERSE, column, in_slices, mixed, powers, utf8, word_bounds
from poolwright.session import materialize

#: Buckets of hashed tokens: their number bounds the model whatever the corpus.
BUCKETS = 1 << 20
#: Bytes of the beginnings of a word that its prior goes through.
STEMS = (4, 5, 7)
#: Documents that a prior counts for.
PRIOR = 4.0
DRIFT = 0.3
#: Scores of one token stay within.
MOST = 7.0
LEVEL = 0.01
HELD_OUT = 2
FOLDS = (0, 1, 3)
#: Labels are broadcast up to this many bytes, counted at 16 a row; beyond they are joined by a shuffle.
BROADCAST_BYTES = 128 << 20
THRESHOLD = 0.3
#: Width of the bins that scores and evidence are counted in.
BIN = 0.05
STEP = 0.25
MOST_EVIDENCE = 80.0

LETTERS = np.zeros(256, bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True


# --- tokens ---------------------------------------------------------------------


def tokens(flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of every token (a row per length of beginning, the whole word last), tokens before each text, begin and end of tokens."""
    starts, ends, at = word_bounds(flat, bounds, LETTERS)
    n = len(flat)
    table = np.arange(1, 257, dtype=np.uint64)
    table[65:91] += np.uint64(32)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(table[flat] * powers(BASE, n), out=sums[1:])
    back = powers(INVERSE, n)[starts] if n else np.zeros(0, np.uint64)
    out = np.empty((len(STEMS) + 1, len(starts)), np.int32)
    for k, size in enumerate((*STEMS, None)):
        stop = ends if size is None else np.minimum(starts + size, ends)
        value = (sums[stop] - sums[starts]) * back + np.uint64((k + 1) * 0xD6E8FEB86659FD93 % (1 << 64))
        out[k] = (mixed(value) % np.uint64(BUCKETS)).astype(np.int32)
    return out, at, starts, ends


def labelled(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> DataFrame:
    """Rows (fold, toxic, text) to learn from: labelled, and not held out."""
    known = labels.select(column(labels, "doc_id", "long").alias("label_id"), column(labels, label, "int").alias("toxic")).filter("label_id is not null and toxic is not null")
    known = known.groupBy("label_id").agg((F.max("toxic") > 0).cast("int").alias("toxic")).withColumn("fold", fold_of(F.col("label_id")))
    known = materialize(known.filter(F.col("fold") != HELD_OUT), "known")
    if known.count() * 16 <= BROADCAST_BYTES:
        known = F.broadcast(known)
    rows = docs.select(column(docs, "doc_id", "long").alias("doc_id"), F.coalesce(column(docs, "text", "string"), F.lit("")).alias("text"))
    return rows.join(known, rows["doc_id"] == known["label_id"]).select("fold", "toxic", "text")


def fold_of(doc_id) -> F.Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)).cast("int")


def count_documents(rows: DataFrame) -> np.ndarray:
    """Documents per (fold, label, bucket), and their numbers in the last bucket; one small table whatever the corpus."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((len(FOLDS), 2, BUCKETS + 1), np.int32)
        for batch in in_slices(batches, "text", 1 << 20):
            found, at, _, _ = tokens(*utf8(batch.column("text")))
            for i, (fold, toxic) in enumerate(zip(batch.column("fold").to_pylist(), batch.column("toxic").to_pylist())):
                own = held[FOLDS.index(fold), toxic]
                own[np.unique(found[:, at[i] : at[i + 1]])] += 1
                own[BUCKETS] += 1
        for f in range(len(FOLDS)):
            for toxic in range(2):
                some = np.flatnonzero(held[f, toxic])
                for a in range(0, len(some), 1 << 16):
                    part = some[a : a + (1 << 16)]
                    places = (f * 2 + toxic) * (BUCKETS + 1) + part
                    yield pa.RecordBatch.from_arrays([pa.array(places.astype(np.int32)), pa.array(held[f, toxic][part].astype(np.int64))], ["place", "n"])

    sums = rows.mapInArrow(run, "place int, n long").groupBy("place").agg(F.sum("n").alias("n"))
    out = np.zeros(len(FOLDS) * 2 * (BUCKETS + 1), np.float32)
    found = sums.toArrow()  # at most one row a place
    out[found.column("place").to_numpy()] = found.column("n").to_numpy()
    return out.reshape(len(FOLDS), 2, BUCKETS + 1)


# --- weights --------------------------------------------------------------------


class Weights:
    """Log-odds of tokens from document counts (clean, toxic) by bucket."""

    def __init__(self, counts: np.ndarray) -> None:
        self.toxic, self.all = counts[1], counts[0] + counts[1]
        self.share = float(self.toxic[BUCKETS] / max(self.all[BUCKETS], 1))

    def scores(self, found: np.ndarray) -> np.ndarray:
        """Score of every token of one text, ``DRIFT`` taken off; a word counts at its first place, as documents were counted by words they hold."""
        share = np.full(found.shape[1], self.share, np.float32)
        for level in found:
            share = (self.toxic[level] + PRIOR * share) / (self.all[level] + PRIOR)
        share = np.clip(share, 1e-6, 1 - 1e-6)
        odds = np.log(share / (1 - share)) - math.log(self.share / (1 - self.share))
        first = np.zeros(found.shape[1], bool)
        first[np.unique(found[-1], return_index=True)[1]] = True
        return np.where(first, np.clip(odds, -MOST, MOST), 0.0).astype(np.float64) - DRIFT


# --- segments -------------------------------------------------------------------


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (begin, end, score) in linear time, in order of place."""
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    up = scores > 0
    begins = np.flatnonzero(up & ~np.concatenate([[False], up[:-1]]))
    ends = np.flatnonzero(up & ~np.concatenate([up[1:], [False]])) + 1
    kept: list[list] = []  # begin, end, sum before it, sum at its end
    #: for each kept one the nearest earlier one whose sum before it is lower (-1: none)
    lower: list[int] = []
    for a, b, left, right in zip(begins.tolist(), ends.tolist(), sums[begins].tolist(), sums[ends].tolist()):
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= left:
                j = lower[j]
            if j < 0 or kept[j][3] >= right:
                kept.append([a, b, left, right])
                lower.append(j)
                break
            # the earlier one starts lower and ends lower: both are one with all between
            a, left = kept[j][0], kept[j][2]
            del kept[j:], lower[j:]
    return [(a, b, right - left) for a, b, left, right in kept]


@dataclass
class Law:
    """Extreme-value law of the best segment, and the rising steps from evidence to probability."""

    rate: float = 1.0
    place: float = 0.0
    width: float = 1.0
    steps: tuple[tuple[float, float], ...] = ((0.0, 0.0),)

    def excess(self, score: float, n: int) -> float:
        """Where a segment of a text of n tokens stands in the law of clean texts."""
        return (self.rate * score - math.log(max(n, 1)) - self.place) / self.width

    def chance(self, excess: float) -> float:
        """Probability that a clean text has such a segment."""
        return -math.expm1(-math.exp(min(-excess, 50.0)))

    def evidence(self, found: list[tuple[int, int, float]], n: int) -> float:
        """Negative log-probability of the r best passages in a clean text, for the r that stands out most."""
        if not found:
            return 0.0
        ordered = sorted((self.excess(s, n) for _, _, s in found), reverse=True)
        best, total = -math.log(max(self.chance(ordered[0]), 1e-300)), 0.0
        for r, x in enumerate(ordered, 1):
            if self.chance(x) >= LEVEL:
                break
            total += x
            if r > 1:
                best = max(best, total - (r - 1) * math.log(total) + math.lgamma(r + 1) + math.lgamma(r))
        return min(best, MOST_EVIDENCE)

    def probability(self, evidence: float) -> float:
        at, p = zip(*self.steps)
        return float(np.interp(evidence, at, p))


def bins_of(rows: DataFrame, make, schema: str) -> list:
    """Small counts over rows (fold, toxic, text): ``make`` turns a batch into rows, which are summed."""
    keys = [c.split()[0] for c in schema.split(", ")]
    return rows.mapInArrow(make, f"{schema}, n long").groupBy(*keys).agg(F.sum("n").alias("n")).collect()


@dataclass
class Model:
    counts: np.ndarray
    law: Law
    both: bool

    def weights(self) -> Weights:
        return Weights(self.counts.sum(axis=0))


def _apart(counts: np.ndarray, fold: int) -> Weights:
    """Weights that have not seen a fold."""
    return Weights(counts.sum(axis=0) - counts[FOLDS.index(fold)])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    """Counts, law and steps from all labelled rows that are not held out; what reaches the driver is bounded by ``BUCKETS`` and bins."""
    spark = docs.sparkSession
    rows = materialize(labelled(docs, labels, label), "labelled")
    counts = count_documents(rows)
    of_label = counts[:, :, BUCKETS].sum(axis=0)
    apart = [counts[:, :, BUCKETS].sum(axis=0) - counts[f, :, BUCKETS] for f in range(len(FOLDS))]
    if not all((n > 0).all() for n in (of_label, *apart)):
        share = float(of_label[1] / max(of_label.sum(), 1))
        return Model(counts, Law(steps=((0.0, share),)), False)
    shared = spark.sparkContext.broadcast(counts)
    clean = rows.filter("toxic = 0")

    def scored(batches: Iterator[pa.RecordBatch]):
        held: dict[int, Weights] = {}
        for batch in in_slices(batches, "text", 1 << 20):
            found, at, _, _ = tokens(*utf8(batch.column("text")))
            for i, (fold, toxic) in enumerate(zip(batch.column("fold").to_pylist(), batch.column("toxic").to_pylist())):
                if fold not in held:
                    held[fold] = _apart(shared.value, fold)
                yield toxic, held[fold].scores(found[:, at[i] : at[i + 1]])

    def counted(names, values: dict) -> pa.RecordBatch:
        places = list(values)
        return pa.RecordBatch.from_arrays([*[pa.array([p[k] for p in places], pa.int32()) for k in range(len(names))], pa.array(list(values.values()), pa.int64())], [*names, "n"])

    def token_bins(batches):
        low = round(MOST / BIN) + 20
        held = np.zeros(2 * low + 1, np.int64)
        for _, s in scored(batches):
            held += np.bincount(np.round(s / BIN).astype(int) + low, minlength=len(held))
        yield counted(["bin"], {(int(k) - low,): int(held[k]) for k in np.flatnonzero(held)})

    law = Law(rate=_rate([(r["bin"] * BIN, r["n"]) for r in bins_of(clean, token_bins, "bin int")]))

    def best_bins(batches):
        held: dict = {}
        for _, s in scored(batches):
            best = max((x for _, _, x in segments(s)), default=0.0)
            key = (round((law.rate * best - math.log(max(len(s), 1))) / BIN),)
            held[key] = held.get(key, 0) + 1
        yield counted(["bin"], held)

    law.place, law.width = _place([(r["bin"] * BIN, r["n"]) for r in bins_of(clean, best_bins, "bin int")])

    def evidence_bins(batches):
        held: dict = {}
        for toxic, s in scored(batches):
            key = (toxic, int(law.evidence(segments(s), len(s)) / STEP))
            held[key] = held.get(key, 0) + 1
        yield counted(["toxic", "bin"], held)

    law.steps = _steps([(r["bin"] * STEP, r["toxic"], r["n"]) for r in bins_of(rows, evidence_bins, "toxic int, bin int")])
    shared.destroy()
    return Model(counts, law, True)


def _rate(bins: list[tuple[float, int]]) -> float:
    """The rate at which clean tokens' exp(rate * score) has mean 1; 1 where no clean token scores above 0."""
    total = sum(n for _, n in bins)
    mean = sum(s * n for s, n in bins)
    if not total or mean >= 0 or max(s for s, _ in bins) <= 0:
        return 1.0
    low, high = 1e-3, 1e-3
    grown = lambda rate: sum(n * math.exp(min(rate * s, 600)) for s, n in bins) / total
    while grown(high) < 1 and high < 64:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if grown(middle) < 1 else (low, middle)
    return high


def _place(bins: list[tuple[float, int]]) -> tuple[float, float]:
    """Place and width of the law, from the quantiles 0.5 and 0.95 of the clean documents."""
    total, below, found = sum(n for _, n in bins), 0, []
    wanted = [0.5, 0.95]
    for x, n in sorted(bins):
        below += n
        while wanted and below >= wanted[0] * total:
            found.append(x)
            wanted.pop(0)
    half, most = -math.log(-math.log(0.5)), -math.log(-math.log(0.95))
    width = max((found[1] - found[0]) / (most - half), 0.25)
    return found[0] - width * half, width


def _steps(bins: list[tuple[float, int, int]]) -> tuple[tuple[float, float], ...]:
    """Rising shares of label 1 by evidence: neighbours that fall are pooled, each pool stands at its mean evidence."""
    pools: list[list[float]] = []  # toxic, all, evidence summed
    by: dict[float, list[int]] = {}
    for x, toxic, n in bins:
        by.setdefault(x, [0, 0])[toxic] += n
    for x in sorted(by):
        clean, toxic = by[x]
        pools.append([toxic, clean + toxic, x * (clean + toxic)])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    # a pool of few documents is not taken to be certain
    return tuple((e / n + STEP / 2, (t + 0.01) / (n + 0.02)) for t, n, e in pools)


# --- use ------------------------------------------------------------------------


def _apply(docs: DataFrame, model: Model, each, schema: str) -> DataFrame:
    """Rows that ``each(batch, texts)`` makes of (doc_id, segments, tokens, places); the model is bounded by ``BUCKETS``."""
    shared = docs.sparkSession.sparkContext.broadcast(model.counts.sum(axis=0)) if model.both else None
    law = model.law

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(shared.value) if shared is not None else None
        for batch in in_slices(batches, "text", 1 << 20):
            flat, bounds = utf8(batch.column("text"))
            found, at, starts, ends = tokens(flat, bounds)
            out = []
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                a, b = int(at[i]), int(at[i + 1])
                parts = segments(weights.scores(found[:, a:b])) if weights is not None else []
                out += each(law, doc_id, parts, b - a, (flat, int(bounds[i]), starts[a:b], ends[a:b]))
            names = [c.split()[0] for c in schema.split(", ")]
            kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string()}
            columns = [pa.array([r[k] for r in out], kinds[c.split()[1]]) for k, c in enumerate(schema.split(", "))]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text"))
    return rows.mapInArrow(run, schema)


def passages(docs: DataFrame, model: Model) -> DataFrame:
    """Every significant passage: doc_id, first byte, byte after the last, text, score, tail probability in clean texts."""
    def each(law, doc_id, parts, n, place):
        flat, base, starts, ends = place
        for a, b, score in parts:
            chance = law.chance(law.excess(score, n))
            if chance < LEVEL:
                first, last = int(starts[a]), int(ends[b - 1])
                yield doc_id, first - base, last - base, flat[first:last].tobytes().decode("utf-8", "replace"), float(score), float(chance)

    return _apply(docs, model, each, "doc_id long, first_byte long, end_byte long, passage string, score double, chance double")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, probability of label 1, evidence and significant passages."""
    def each(law, doc_id, parts, n, place):
        evidence = law.evidence(parts, n)
        yield doc_id, law.probability(evidence), evidence, sum(law.chance(law.excess(s, n)) < LEVEL for _, _, s in parts)

    return _apply(docs, model, each, "doc_id long, score double, evidence double, n_passages long")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and prediction of every row; learned from labels of rows that are not held out."""
    found = score(docs, fit(docs, labels))
    held_out = F.coalesce(fold_of(F.col("doc_id")) == HELD_OUT, F.lit(False))
    return found.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence", "n_passages")
