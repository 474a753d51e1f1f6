"""Language identification by cross-parsing entropy.

For each language a bounded sample of labelled text becomes a suffix automaton.
A text is parsed greedily into the longest phrases that occur in that sample:
the fewer phrases, the closer the language. Phrase counts are normalised by the
length of text and sample (a phrase costs the bits of a place in the sample), so
samples of different size compare fairly.

Only letters count: everything else is one space, letters are lower-cased. Texts
are parsed whole, in blocks of ``BLOCK`` bytes; a phrase ends with its block, so
blocks of all texts of a batch are parsed in step by array operations.

Bound of the fit: of every language ``rows`` labelled texts, spread by the hash of
the text, and ``total`` bytes of sample over all languages. A null text, or one
without a letter, gets ``und`` and score 0, as does every text if nothing is labelled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poolwright.llm.common import column, utf8

UNKNOWN = "und"
BLOCK = 256
#: Bytes that are parsed in step.
STEP_BYTES = 4 << 20


def letters(text: Column) -> Column:
    """Lower-case letters of a text, all else one space."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "))


def automaton(text: bytes, codes: np.ndarray, width: int) -> np.ndarray:
    """Suffix automaton of ``text`` as a table: state x symbol -> state, 0 for none. The root is 1."""
    steps: list[dict[int, int]] = [{}, {}]
    link, length = [0, 0], [0, 0]
    last = 1
    for symbol in codes[np.frombuffer(text, np.uint8)].tolist():
        new = len(steps)
        steps.append({})
        length.append(length[last] + 1)
        link.append(1)
        at = last
        while at and symbol not in steps[at]:
            steps[at][symbol] = new
            at = link[at]
        if at:
            to = steps[at][symbol]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                copy = len(steps)
                steps.append(dict(steps[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                link[to] = link[new] = copy
                while at and steps[at].get(symbol) == to:
                    steps[at][symbol] = copy
                    at = link[at]
        last = new
    table = np.zeros((len(steps), width), np.int32)
    for state, row in enumerate(steps):
        if row:
            table[state, list(row)] = list(row.values())
    return table


def phrases(table: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Greedy phrases of each column of ``blocks`` (symbols; 0 pads the end)."""
    width = table.shape[1]
    flat, root = table.ravel(), table[1]
    state = np.ones(blocks.shape[1], np.int32)
    count = np.zeros(blocks.shape[1], np.int32)
    for symbols in blocks:
        on = flat[state * width + symbols]
        opens = (on == 0) | (state == 1)
        count += opens & (symbols != 0)
        # an unseen symbol is a phrase of its own, after which the root stands again
        state = np.where(on == 0, np.maximum(root[symbols], 1), on)
    return count


class Model:
    """Suffix automata of the labelled samples by language."""

    def __init__(self, samples: dict[str, bytes]) -> None:
        self.languages = sorted(samples)
        self.codes = np.zeros(256, np.int32)
        used = sorted({b for text in samples.values() for b in text})
        # symbol 1 stands for all bytes that no sample has, 0 for the padding
        self.codes[:] = 1
        self.codes[used] = np.arange(2, 2 + len(used))
        width = 2 + len(used)
        self.tables = [automaton(samples[name], self.codes, width) for name in self.languages]
        self.bits = np.array([np.log2(max(2, len(samples[name]))) for name in self.languages])

    def costs(self, flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Bits per byte of every text under every language; inf for empty texts."""
        sizes = np.diff(bounds)
        blocks = (sizes + BLOCK - 1) // BLOCK
        owner = np.repeat(np.arange(len(sizes)), blocks)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = bounds[:-1][owner] + number * BLOCK
        held = np.minimum(BLOCK, bounds[1:][owner] - start)
        total = np.zeros((len(self.languages), len(sizes)), np.int64)
        codes = self.codes[flat].astype(np.int32)
        at_once = STEP_BYTES // BLOCK
        for i in range(0, len(owner), at_once):
            part = slice(i, i + at_once)
            places = np.arange(BLOCK)[:, None] + start[part][None, :]
            symbols = np.where(np.arange(BLOCK)[:, None] < held[part][None, :], codes[np.minimum(places, len(codes) - 1)], 0)
            for k, table in enumerate(self.tables):
                np.add.at(total[k], owner[part], phrases(table, symbols))
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(sizes > 0, total * self.bits[:, None] / sizes, np.inf)

    def predict(self, flat: np.ndarray, bounds: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language with the fewest normalised phrases, and its share of the inverse costs."""
        n = len(bounds) - 1
        if not self.languages:
            return [UNKNOWN] * n, np.zeros(n)
        costs = self.costs(flat, bounds)
        best = costs.argmin(0)  # of equal costs the first name
        some = np.isfinite(costs[0])
        with np.errstate(divide="ignore", invalid="ignore"):
            share = np.where(some, (1 / costs.min(0)) / (1 / costs).sum(0), 0.0)
        return [self.languages[k] if ok else UNKNOWN for k, ok in zip(best, some)], share


def fit(labelled: DataFrame, rows: int = 64, total: int = 240_000) -> Model:
    """Model from ``text`` and ``lang`` of labelled rows; nulls are left out.

    ``rows`` texts a language, chosen by the hash of the text, and ``total``
    bytes over all languages, shared evenly, bound what reaches the driver.
    Of a text it learns from at most its first ``4 * total / rows`` characters (15,000) are taken; texts are always judged whole.
    """
    most = 4 * total // rows
    texts = labelled.select(column(labelled, "lang", "string").alias("lang"), column(labelled, "text", "string").alias("text")).dropna()
    hashed = F.xxhash64("text")
    found = (
        texts.select("lang", F.pmod(hashed, F.lit(rows)).alias("bucket"), F.struct(hashed.alias("h"), F.substring("text", 1, most).alias("text")).alias("one"))
        .groupBy("lang", "bucket").agg(F.min("one").alias("one"))
        .select("lang", F.col("one.h").alias("h"), letters(F.col("one.text")).alias("text")).filter("text <> ''")
    )
    by: dict[str, list[tuple[int, str]]] = {}
    for r in found.collect():
        by.setdefault(r["lang"], []).append((r["h"], r["text"]))
    share = total // max(1, len(by))
    samples = {}
    for lang, got in by.items():
        # even slices first, then what long texts have left
        each = max(1, share // max(1, len(got)))
        parts = [text.encode() for _, text in sorted(got)]
        left = share - sum(min(each, len(p)) for p in parts)
        out = []
        for p in parts:
            more = min(max(0, len(p) - each), max(0, left))
            left -= more
            out.append(p[: each + more])
        samples[lang] = b" ".join(out)[: share + len(parts)]
    return Model(samples)


def identify(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of every row of ``docs`` with ``lang_pred`` and ``score`` (0 to 1).

    Columns of those two names cannot be kept but within a struct.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(letters(column(docs, text, "string")), F.lit("")).alias("_letters"))
    schema = rows.schema
    out = type(schema)([f for f in schema.fields if f.name != "_letters"])
    out = out.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            flat, bounds = utf8(batch.column("_letters"))
            names, score = own.predict(flat, bounds)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(names, pa.string()), pa.array(score)], [*batch.schema.names[:-1], "lang_pred", "score"])

    return rows.mapInArrow(run, out)


def held_out() -> Column:
    """Documents that are not learned from: remainder 2 of crc32(doc_id) modulo 4; a null id is learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def predict_documents(docs: DataFrame) -> DataFrame:
    """Language of every document, learned from those not held out."""
    rows = docs.select(column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text"), column(docs, "lang", "string").alias("lang"))
    rows = rows.withColumn("held_out", held_out())
    model = fit(rows.filter(~F.col("held_out")))
    return identify(rows, model, keep=("doc_id", "held_out"))
