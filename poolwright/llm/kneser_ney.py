"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text per language.

The model is over ``ORDER``-grams of bytes: each byte of the UTF-8 text is a symbol of its own, and one
more pads the begin of a text. Counts of all trusted text are summed in
shards; each order's counts are joined with the totals of their contexts and with the
probabilities of the order below. A document's perplexity is that of its whole text under its
language's model; documents above the language's quantile of trusted perplexities are dropped.

The joins run over the distinct n-grams of the trusted corpus. Joining every document's n-grams
to them would shuffle many times the corpus, so the joined model goes to the documents: a row of
probabilities for each context that trusted text has, which tasks read from the work folder.

Null languages are one language, ``und``. Null and empty texts have no perplexity and are not kept.
Documents of a language without trusted text are kept: nothing speaks against them. Rows may repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolwright.llm.common import column, in_slices, utf8
from poolwright.llm.ratio_rules import flagged, trusted_ids
from poolwright.llm.warc import file_system
from poolwright.session import materialize

ORDER, SYMBOLS = 4, 257
#: Smallest discount; it leaves every symbol some probability.
LEAST = 0.1
#: Languages whose tables a task holds at a time, and bytes of them if it holds several.
HELD, HELD_BYTES = 16, 160 << 20
#: Trusted documents that may lie above the threshold.
QUANTILE = 0.999
#: Nats by which a document may exceed the quantile, and more for short ones, over the root of its length.
MARGIN, SHORT = 0.3, 4.0
#: Trusted mean log-probabilities are counted in bins of this many nats.
BIN = 0.001


#: Symbol of every byte; 0 pads the begin of a text.
CLASSES = np.arange(1, 257)


def grams(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The n-gram that ends at each byte of some texts, as a number; a text begins after padding."""
    codes = CLASSES[flat]
    at = np.arange(len(flat)) - np.repeat(bounds[:-1], np.diff(bounds))
    out = codes.copy()
    for back in range(1, ORDER):
        before = np.concatenate([np.zeros(back, np.int64), codes[:-back]])[: len(codes)]
        out += np.where(at >= back, before, 0) * SYMBOLS**back
    return out


def count_grams(rows: DataFrame) -> DataFrame:
    """Counts (lang, gram, n) of all n-grams of ``rows`` (lang, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: dict[str, list[np.ndarray]] = {}
            for part in in_slices(iter([batch]), "text"):
                langs = np.array(part.column("lang").to_pylist(), object)
                flat, bounds = utf8(part.column("text"))
                found = grams(flat, bounds)
                owner = np.repeat(np.arange(len(langs)), np.diff(bounds))
                for lang in sorted(set(langs)):
                    parts.setdefault(lang, []).append(found[(langs == lang)[owner]])
            for lang, got in parts.items():
                gram, n = np.unique(np.concatenate(got), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    return rows.select("lang", "text").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def discounts(counts: DataFrame) -> DataFrame:
    """Discounts d1, d2, d3 of every language, from how many n-grams occur once to four times."""
    few = counts.groupBy("lang").agg(*[F.sum((F.col("n") == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)])
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    some = F.least(*[F.col(f"n{k}") for k in (1, 2, 3, 4)]) > 0
    # too little text for the estimate: plain halves and more
    made = [F.when(some, k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")).otherwise(F.lit(d)) for k, d in ((1, 0.5), (2, 0.75), (3, 0.9))]
    return few.select("lang", *[F.greatest(F.lit(LEAST), F.least(F.lit(float(k)), c)).alias(f"d{k}") for k, c in enumerate(made, 1)])


def model(counts: DataFrame) -> DataFrame:
    """Rows (lang, size, key, gamma, p): probabilities of n-grams (``p``) and weights of contexts (``gamma``), by n."""
    counts = materialize(counts, "grams")
    levels = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):
        # of lower orders it counts how many different symbols come before
        levels[n] = levels[n + 1].groupBy("lang", F.pmod("gram", F.lit(SYMBOLS**n)).alias("gram")).agg(F.count("*").alias("n"))
    out, below = None, None
    for n in range(1, ORDER + 1):
        # one row a language: as small as the list of languages
        level = levels[n].join(F.broadcast(discounts(levels[n])), "lang").withColumn("context", F.floor(F.col("gram") / SYMBOLS).cast("long"))
        cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        contexts = level.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.sum(cut).alias("left"))
        contexts = contexts.select("lang", "context", "total", (F.col("left") / F.col("total")).alias("gamma"))
        seen = level.select("lang", "gram", "context", (F.col("n") - cut).alias("kept")).join(contexts, ["lang", "context"])
        if below is None:
            lower = F.lit(1.0 / SYMBOLS)
        else:
            below = below.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("lower"))
            seen = seen.withColumn("suffix", F.pmod("gram", F.lit(SYMBOLS ** (n - 1)))).join(below, ["lang", "suffix"])
            lower = F.col("lower")
        seen = materialize(seen.select("lang", "gram", (F.col("kept") / F.col("total") + F.col("gamma") * lower).alias("p")), "probabilities")
        part = seen.select("lang", F.lit(n).alias("size"), F.col("gram").alias("key"), F.lit(None).cast("double").alias("gamma"), "p").union(
            contexts.select("lang", F.lit(n), F.col("context"), "gamma", F.lit(None).cast("double")))
        out, below = part if out is None else out.union(part), seen
    return out


def _spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Probabilities of all symbols after each context: those seen, the others by the context's weight and the order below."""
    for rows in batches:
        if not len(rows):
            continue
        full = np.frombuffer(b"".join(rows["lower"]), np.float32).reshape(-1, SYMBOLS).astype(float)
        full *= rows["gamma"].to_numpy()[:, None]
        own = np.repeat(np.arange(len(rows)), [len(x) for x in rows["symbols"]])
        full[own, np.concatenate(rows["symbols"].tolist())] = np.concatenate(rows["ps"].tolist())
        packed = [x.tobytes() for x in full.astype(np.float32)]
        yield pd.DataFrame({"lang": rows["lang"], "context": rows["context"], "row": packed})


def _logs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        if len(rows):
            full = np.log(np.maximum(np.frombuffer(b"".join(rows["row"]), np.float32), 1e-30)).astype(np.float16).reshape(-1, SYMBOLS)
            yield rows.drop(columns="row").assign(packed=[x.tobytes() for x in full])


def tables(found: DataFrame) -> DataFrame:
    """Rows (lang, place, packed), sorted: log-probabilities of all symbols after each context that trusted text has.

    A place is the context's number behind those of all shorter ones.
    """
    below, out = None, None
    for n in range(1, ORDER + 1):
        own = found.filter(F.col("size") == n)
        seen = own.filter("p is not null").select("lang", F.floor(F.col("key") / SYMBOLS).cast("long").alias("context"), F.pmod("key", F.lit(SYMBOLS)).cast("int").alias("symbol"), "p")
        # at most one entry a symbol
        seen = seen.groupBy("lang", "context").agg(F.collect_list(F.struct("symbol", "p")).alias("seen")).select(
            "lang", "context", F.col("seen.symbol").alias("symbols"), F.col("seen.p").alias("ps"))
        level = own.filter("gamma is not null").select("lang", F.col("key").alias("context"), "gamma").join(seen, ["lang", "context"])
        if below is None:
            level = level.withColumn("lower", F.lit(np.full(SYMBOLS, 1.0 / SYMBOLS, np.float32).tobytes()))
        else:
            # the end of a context that was seen was seen as well
            level = level.withColumn("suffix", F.pmod("context", F.lit(SYMBOLS ** max(0, n - 2)))).join(
                below.select("lang", F.col("context").alias("suffix"), F.col("row").alias("lower")), ["lang", "suffix"])
        level = level.select("lang", "context", "gamma", "symbols", "ps", "lower")
        below = materialize(level.mapInPandas(_spread, "lang string, context long, row binary"), "levels")
        part = below.select("lang", (F.col("context") + first_place(n - 1)).alias("place"), "row")
        out = part if out is None else out.union(part)
    return materialize(out.mapInPandas(_logs, "lang string, place long, packed binary").repartitionByRange("lang", "place").sortWithinPartitions("lang", "place"), "models")


def first_place(size: int) -> int:
    """Place of the first context of ``size`` symbols."""
    return sum(SYMBOLS**k for k in range(size))


class Table:
    """Log-probabilities of one language."""

    def __init__(self, places: np.ndarray, rows: np.ndarray) -> None:
        self.places, self.rows = places, rows

    def logs(self, found: np.ndarray) -> np.ndarray:
        """Of each n-gram, after the longest part of its context that trusted text has."""
        context, symbol = found // SYMBOLS, found % SYMBOLS
        row = np.full(len(found), -1)
        open_ = np.arange(len(found))
        for size in range(ORDER - 1, -1, -1):
            place = context[open_] % SYMBOLS**size + first_place(size)
            at = np.minimum(np.searchsorted(self.places, place), len(self.places) - 1)
            same = self.places[at] == place
            row[open_[same]] = at[same]
            open_ = open_[~same]
            if not len(open_):
                break
        return self.rows[row, symbol]


class Models:
    """Tables of languages, read by tasks from the folder that Spark wrote them to; a task holds ``HELD`` of them."""

    def __init__(self, path: str) -> None:
        self.files, root = file_system(path)
        self.places: dict[str, list[str]] = {}
        self.held: dict[str, Table] = {}
        for info in sorted(self.files.get_file_info(pyarrow.fs.FileSelector(root)), key=lambda i: i.path):
            if info.base_name.endswith(".parquet"):
                for lang in self._read(info.path, ["lang"]).column("lang").unique().to_pylist():
                    self.places.setdefault(lang, []).append(info.path)

    def _read(self, path: str, names: list[str]) -> pa.Table:
        with self.files.open_input_file(path) as source:
            return pq.read_table(source, columns=names)

    def _load(self, lang: str) -> Table:
        parts = [t.filter(pc.equal(t.column("lang"), lang)) for t in (self._read(p, ["lang", "place", "packed"]) for p in self.places[lang])]
        places = np.concatenate([t.column("place").to_numpy() for t in parts])
        rows = np.concatenate([np.frombuffer(b"".join(t.column("packed").to_pylist()), np.float16) for t in parts]).reshape(-1, SYMBOLS)
        order = np.argsort(places)
        return Table(places[order], rows[order])

    def get(self, lang: str) -> Table | None:
        if lang not in self.places:
            return None
        table = self.held.pop(lang, None)
        if table is None:
            table = self._load(lang)
            while self.held and (len(self.held) >= HELD or sum(t.rows.nbytes for t in self.held.values()) + table.rows.nbytes > HELD_BYTES):
                self.held.pop(next(iter(self.held)))  # the one not used for longest
        self.held[lang] = table
        return table


def score(rows: DataFrame, models: DataFrame) -> DataFrame:
    """``rows`` (doc_id, lang, text, trusted) without text, with ``n`` symbols and ``mean`` negative log-probability.

    One pass over the texts, whatever the number of languages; no table passes through the driver. The mean is null for a language without a model.
    """
    path = models.inputFiles()[0].rsplit("/", 1)[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Models(path)
        for batch in in_slices(batches, "text"):
            langs = np.array(batch.column("lang").to_pylist(), object)
            flat, bounds = utf8(batch.column("text"))
            found, sizes = grams(flat, bounds), np.diff(bounds)
            owner = np.repeat(np.arange(len(langs)), sizes)
            value, known = np.zeros(len(flat)), np.zeros(len(langs), bool)
            for lang in sorted(set(langs)):
                table = own.get(lang)
                if table is not None:
                    known |= langs == lang
                    held = (langs == lang)[owner]
                    value[held] = table.logs(found[held])
            sums = np.concatenate([[0.0], np.cumsum(value)])
            mean = -(sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(sizes, 1)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("lang"), batch.column("trusted"), pa.array(sizes), pa.array(np.round(mean, 6), mask=(sizes == 0) | ~known),
            ], ["doc_id", "lang", "trusted", "n", "mean"])

    scored = rows.select("doc_id", "lang", "trusted", "text").mapInArrow(run, "doc_id long, lang string, trusted boolean, n long, mean double")
    return materialize(scored, "scored")


def thresholds(scored: DataFrame) -> dict[str, float]:
    """For every language the ``QUANTILE`` of the trusted documents' means, from counts in bins."""
    # short texts widen the margin; they are left out of the quantile
    own = scored.filter(F.col("trusted") & F.col("mean").isNotNull())
    excess = F.col("mean") - SHORT / F.sqrt("n")
    bins: dict[str, list[tuple[int, int]]] = {}
    for r in own.groupBy("lang", F.floor(excess / BIN).alias("bin")).count().collect():
        bins.setdefault(r["lang"], []).append((r["bin"], r["count"]))
    out = {}
    for lang, got in bins.items():
        wanted, below = QUANTILE * sum(n for _, n in got), 0
        for at, n in sorted(got):
            below += n
            if below >= wanted:
                out[lang] = (at + 1) * BIN + MARGIN
                break
    return out


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (doc_id, lang, perplexity, threshold, kept) of all documents; both figures are per symbol."""
    spark = docs.sparkSession
    rows = docs.select(
        column(docs, "doc_id", "long").alias("doc_id"), F.coalesce(column(docs, "lang", "string"), F.lit("und")).alias("lang"),
        F.coalesce(column(docs, "text", "string"), F.lit("")).alias("text"))
    rows = flagged(rows, trusted_ids(labels))
    models = tables(model(count_grams(rows.filter(F.col("trusted") & (F.col("text") != "")))))
    scored = score(rows, models)
    least = thresholds(scored)
    limits = spark.createDataFrame(sorted(least.items()), "lang string, least double")
    joined = scored.join(F.broadcast(limits), "lang", "left")
    limit = F.col("least") + SHORT / F.sqrt("n")
    kept = (F.col("n") > 0) & (F.col("least").isNull() | (F.col("mean") <= limit))
    return joined.select("doc_id", "lang", F.exp("mean").alias("perplexity"), F.when(F.col("n") > 0, F.exp(limit)).alias("threshold"), kept.alias("kept"))
