"""Hard negatives by threshold joins over an inverted index with norm bounds.

Anchors and rows meet in blocks: a task holds a block of rows and reads the anchors, a block at a
time, from the shared folder; neither side is broadcast or shuffled to the other. Within a pair of
blocks the join finds all pairs whose inner product reaches the anchor's threshold:

- The index lists rows by groups of dimensions, strongest first. A row leaves the lists from the group on where the norm
  of what is left, times the largest such norm of the anchors, stays below the least threshold (suffix-norm bound).
- Partial scores accumulate group by group. A pair is pruned once its partial
  score plus the product of both remaining norms is below the anchor's threshold.
- What is left is completed exactly.

A window is a range of scores of one anchor of which the first rows are wanted. Its threshold starts high and is lowered
from round to round until the window is full or its lower end is reached; only open windows take
part in the next round, and a round returns no more than the wanted rows of a window and block.

Components are whole numbers, so scores are exact: by floating point below 2**53, by Python's integers beyond (a score
that a long cannot hold becomes the nearest one it can). Vectors of unequal lengths are compared as if the shorter ended in zeros.

Rows with a null id, label or vector, and those with a null or non-finite component (times the scale), take no part. Equal rows
(id, label and vector) count once; rows that share an id but differ are rows of their own, and no row
is a positive of an anchor with its id. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from poolwright.llm.common import column, frugal
from poolwright.llm.warc import file_system
from poolwright.session import materialize

SCALE = 256
#: Dimensions of a group, rows and anchors of a block, and the share of pairs below which they are completed one by one.
GROUP = 8
ROWS = 8192
ANCHORS = 256
FEW = 0.1
EXACT = float(1 << 53)
LONG = (1 << 63) - 1
#: Anchors that a task keeps; more are read again for every block of rows.
KEPT = 1 << 14
#: Thresholds of the rounds: for positives as shares of the product of norms, for windows as shares of their width from the top.
NORM_SHARES = (0.5, 0.25, 0.0)
WIDTH_SHARES = (0.125, 0.5)


# --- vectors --------------------------------------------------------------------


def packed(values: np.ndarray) -> tuple[int, bytes]:
    """Whole numbers in as few bytes each as they need."""
    most = np.abs(values).max() if len(values) else 0
    kind = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
    return kind, values.astype({2: "<i2", 4: "<i4", 8: "<f8"}[kind]).tobytes()


def unpacked(kinds: list[int], vectors: list[bytes], width: int = 0) -> np.ndarray:
    """A matrix of vectors, the shorter filled with zeros."""
    parts = [np.frombuffer(v, {2: "<i2", 4: "<i4", 8: "<f8"}[k]) for k, v in zip(kinds, vectors)]
    out = np.zeros((len(parts), max([width, *map(len, parts)])))
    for row, part in zip(out, parts):
        row[: len(part)] = part
    return out


def quantised(vectors: DataFrame, vector: str, scale: int) -> DataFrame:
    """Rows (vec_id, label, kind, vector, norm) that take part, each once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for vec_id, label, part in zip(batch.column("vec_id").to_pylist(), batch.column("label").to_pylist(), batch.column("vector")):
                if part.values.null_count:
                    continue
                with np.errstate(over="ignore", invalid="ignore"):
                    values = np.floor(part.values.to_numpy(zero_copy_only=False) * float(scale))
                if np.isfinite(values).all():
                    out.append((vec_id, label, *packed(values), float(np.linalg.norm(values / SCALE))))
            columns = [pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "kind", "vector", "norm"])

    rows = vectors.select(
        column(vectors, "vec_id", "long").alias("vec_id"), column(vectors, "label", "long").alias("label"), column(vectors, vector, "array<double>").alias("vector"))
    rows = rows.filter("vec_id is not null and label is not null and vector is not null")
    return rows.mapInArrow(run, "vec_id long, label long, kind int, vector binary, norm double").dropDuplicates(["vec_id", "label", "vector"])


# --- the join of two blocks -----------------------------------------------------


def pairs_above(a: np.ndarray, x: np.ndarray, low: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in ``a`` and ``x`` and the score of all allowed pairs whose score reaches the anchor's ``low``."""
    if not len(a) or not len(x):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        size = np.sqrt((a * a).sum(axis=1)).max() * np.sqrt((x * x).sum(axis=1)).max()
    if not size < EXACT:
        return _large_pairs(a, x, low, allowed)
    strength = (a * a).sum(axis=0) * (x * x).sum(axis=0)
    order = np.argsort(-strength, kind="stable")
    a, x = a[:, order], x[:, order]
    edges = list(range(0, a.shape[1], GROUP)) + [a.shape[1]]
    groups = len(edges) - 1
    # norms of what is left from each group on
    rest_a = np.stack([np.sqrt((a[:, e:] ** 2).sum(axis=1)) for e in edges])
    rest_x = np.stack([np.sqrt((x[:, e:] ** 2).sum(axis=1)) for e in edges])
    slack = 1e-6 + 1e-9 * size
    covered = rest_x * rest_a.max(axis=1)[:, None] + slack < low.min()
    depth = np.where(covered.any(axis=0), covered.argmax(axis=0), groups)
    # lists: rows that are indexed in a group stand first
    by_depth = np.argsort(-depth, kind="stable")
    x, rest_x, depth, allowed = x[by_depth], rest_x[:, by_depth], depth[by_depth], allowed[:, by_depth]
    partial = np.zeros((len(a), len(x)))
    alive, done = allowed, groups
    for g in range(groups):
        listed = int(np.searchsorted(-depth, -g, "left"))  # rows with depth > g
        if listed:
            partial[:, :listed] += a[:, edges[g] : edges[g + 1]] @ x[:listed, edges[g] : edges[g + 1]].T
        if 2 * (g + 1) >= groups or not listed:
            left = np.minimum(depth, g + 1)
            bound = partial + rest_a[left].T * rest_x[left, np.arange(len(x))]
            alive = allowed & (bound + slack >= low[:, None])
            if np.count_nonzero(alive) <= FEW * alive.size:
                done = g + 1
                break
    at_a, at_x = np.nonzero(alive)
    score = partial[at_a, at_x]
    open_ = np.flatnonzero(np.minimum(depth[at_x], done) < groups)
    for k in range(0, len(open_), 1 << 15):
        some = open_[k : k + (1 << 15)]
        score[some] = np.einsum("ij,ij->i", a[at_a[some]], x[at_x[some]])
    reached = score >= low[at_a]
    return at_a[reached], by_depth[at_x[reached]], score[reached].astype(np.int64)


def _large_pairs(a: np.ndarray, x: np.ndarray, low: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for scores that floating point cannot hold: a row at a time, by exact integers."""
    whole = [[int(v) for v in row] for row in x.tolist()]
    out = []
    for i, row in enumerate(a.tolist()):
        own = [int(v) for v in row]
        for j in np.flatnonzero(allowed[i]).tolist():
            score = max(-LONG - 1, min(LONG, sum(u * v for u, v in zip(own, whole[j]))))
            if score >= low[i]:
                out.append((i, j, score))
    return tuple(np.array([r[k] for r in out], np.int64) for k in range(3))


def first_of_windows(at_a: np.ndarray, score: np.ndarray, ids: np.ndarray, windows: list[list[tuple[int, int, int]]], want: int) -> Iterator[tuple[int, int, int]]:
    """(anchor's place, window's number, pair's place) of the first ``want`` pairs of every window, best score first, of equal ones the smallest id."""
    order = np.lexsort((ids, -score.astype(np.float64), at_a)) if not len(score) or np.abs(score.astype(np.float64)).max() < EXACT else np.array(
        sorted(range(len(score)), key=lambda k: (at_a[k], -int(score[k]), ids[k])), np.int64)
    falling, owner = score[order], at_a[order]
    bounds = np.searchsorted(owner, np.arange(len(windows) + 1))
    for i, own in enumerate(windows):
        part = falling[bounds[i] : bounds[i + 1]][::-1]  # rising
        for number, high, low in own:
            end = int(np.searchsorted(part, high, "right"))
            start = max(int(np.searchsorted(part, low, "left")), end - want)
            for k in range(len(part) - end, len(part) - start):
                yield i, number, int(order[bounds[i] + k])


# --- rounds ---------------------------------------------------------------------

FOUND = "anchor_id long, anchor_key long, number int, score long, vec_id long"


def read_blocks(path: str) -> Iterator[list[dict]]:
    """Blocks of the rows that Spark has written to a shared folder."""
    files, root = file_system(path)
    for info in sorted(files.get_file_info(pyarrow.fs.FileSelector(root)), key=lambda i: i.path):
        if info.base_name.endswith(".parquet"):
            with files.open_input_file(info.path) as source:
                for batch in pq.ParquetFile(source).iter_batches(ANCHORS):
                    yield batch.to_pylist()


def joined(rows: DataFrame, probes: DataFrame, same: bool, want: int) -> DataFrame:
    """Of every window of ``probes`` the first rows of each block of ``rows``; labels are equal (``same``) or differ."""
    path = materialize(probes, "probes").inputFiles()
    path = path[0].rsplit("/", 1)[0] if path else None

    def blocks() -> Iterator[tuple]:
        for block in read_blocks(path):
            own = [[(w["number"], w["high"], w["low"]) for w in r["windows"]] for r in block]
            low = np.array([float(min(l for _, _, l in w)) for w in own])
            yield block, unpacked([r["kind"] for r in block], [r["vector"] for r in block]), np.array([r["label"] for r in block]), np.array([r["anchor_id"] for r in block]), low, own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list | None = None
        for batch in gathered(batches):
            ids, labels = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy()
            x = unpacked(batch.column("kind").to_pylist(), batch.column("vector").to_pylist())
            seen, n = [], 0
            for item in kept if kept is not None else blocks():
                block, a, own_labels, own_ids, low, windows = item
                n += len(block)
                if kept is None and n <= KEPT:
                    seen.append(item)
                width = max(a.shape[1], x.shape[1])
                wide = [np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m for m in (a, x)]
                equal = own_labels[:, None] == labels[None, :]
                allowed = equal & (own_ids[:, None] != ids[None, :]) if same else ~equal
                at_a, at_x, score = pairs_above(*wide, low, allowed)
                out = [(block[i]["anchor_id"], block[i]["anchor_key"], number, int(score[k]), int(ids[at_x[k]])) for i, number, k in first_of_windows(at_a, score, ids[at_x], windows, want)]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], [c.split()[0] for c in FOUND.split(", ")])
            if kept is None and n <= KEPT:
                kept = seen

    if path is None:
        return rows.sparkSession.createDataFrame([], FOUND)
    return rows.select("vec_id", "label", "kind", "vector").mapInArrow(run, FOUND)


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of about ``ROWS`` rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            held.append(batch.slice(a, ROWS))
            if sum(b.num_rows for b in held) >= ROWS:
                yield pa.concat_batches(held)
                held = []
    if held:
        yield pa.concat_batches(held)


WINDOW = ["anchor_id", "anchor_key", "number"]


def fill_windows(rows: DataFrame, anchors: DataFrame, windows: DataFrame, thresholds: list[Column], same: bool, want: int) -> DataFrame:
    """The first ``want`` rows (score, vec_id, rank) of every window (``WINDOW``, high, floor).

    A round joins the open windows at one of ``thresholds`` (expressions over window and anchor), the last at ``floor``. A window
    is closed when it is full or its threshold has come down to its floor.
    """
    best = W.partitionBy(*WINDOW).orderBy(F.desc("score"), "vec_id")
    open_, out = windows, None
    for threshold in [*thresholds, F.col("floor")]:
        tried = materialize(open_.join(anchors, ["anchor_id", "anchor_key"]).withColumn("low", F.greatest("floor", threshold)), "windows")
        probes = tried.groupBy("anchor_id", "anchor_key").agg(
            F.first("label").alias("label"), F.first("kind").alias("kind"), F.first("vector").alias("vector"), F.collect_list(F.struct("number", "high", "low")).alias("windows"))
        found = joined(rows, probes, same, want).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= want)
        found = materialize(found, "found")
        filled = found.filter(F.col("rank") == want).select(*WINDOW)
        open_ = materialize(tried.filter("low > floor").join(filled, WINDOW, "left_anti").select(*windows.columns), "open")
        closed = found.join(open_.select(*WINDOW), WINDOW, "left_anti")
        out = closed if out is None else out.union(closed)
        if open_.isEmpty():
            break
    return out


def mine(vectors: DataFrame, is_anchor: Column, vector: str = "embedding", scale: int = SCALE, positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on ``vec_id`` and ``label``. An anchor's positives are its best ``positives`` rows of the same label; the negatives of a
    positive are the best ``negatives`` rows of other labels whose score lies within ``least`` and ``most`` hundredths of the positive's.
    """
    with frugal(vectors.sparkSession):
        rows = materialize(quantised(vectors, vector, scale), "vectors")
        sizes = rows.agg(F.count("*").alias("n"), F.max("norm").alias("norm")).first()
        # blocks go to different tasks
        rows = materialize(rows.repartition(max(1, -(-sizes["n"] // ROWS))), "rows")
        anchors = rows.filter(is_anchor).select(
            F.col("vec_id").alias("anchor_id"), F.xxhash64("vec_id", "label", "vector").alias("anchor_key"), "label", "kind", "vector", "norm")
        anchors = materialize(anchors, "anchors")
        everything = anchors.select("anchor_id", "anchor_key", F.lit(0).alias("number"), F.lit(LONG).alias("high"), F.lit(-LONG - 1).alias("floor"))
        # norms are kept in units of the scale, so their product does not overflow
        reach = F.col("norm") * F.lit(sizes["norm"] or 0.0) * float(SCALE * SCALE)
        shares = [F.least(F.floor(reach * share).cast("decimal(38,0)"), F.lit(LONG).cast("decimal(38,0)")).cast("long") if share else F.lit(0).cast("long") for share in NORM_SHARES]
        near = materialize(fill_windows(rows, anchors, everything, shares, True, positives), "positives")
        pairs = near.select("anchor_id", "anchor_key", F.col("rank").alias("number"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
        high = F.floor(F.col("positive_score").cast("decimal(38,0)") * most / 100).cast("long")
        floor = F.ceil(F.col("positive_score").cast("decimal(38,0)") * least / 100).cast("long")
        windows = pairs.select(*WINDOW, high.alias("high"), floor.alias("floor")).filter("floor <= high")
        width = F.col("high") - F.col("floor")
        found = fill_windows(rows, anchors, windows, [F.col("high") - F.floor(width * share).cast("long") for share in WIDTH_SHARES], False, negatives)
        out = found.join(pairs, WINDOW).select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        return materialize(out, "negatives")


def mine_embeddings(embeddings: DataFrame) -> DataFrame:
    """The stated anchors (ids divisible by 100) after every label of an id divisible by 7 has moved on by one."""
    vec_id, label = column(embeddings, "vec_id", "long"), column(embeddings, "label", "long")
    rows = embeddings.select(
        vec_id.alias("vec_id"), F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), column(embeddings, "embedding", "array<double>").alias("embedding"))
    return mine(rows, F.col("vec_id") % 100 == 0).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


EMBEDDINGS_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [FLOOR(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT * FROM scores WHERE same QUALIFY ROW_NUMBER() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT * FROM (
  SELECT p.anchor_id, p.vec_id AS positive_id, CAST(ROW_NUMBER() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
         s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
WHERE rank <= 5"""
