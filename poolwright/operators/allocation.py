"""Pool selection: limit universe, ordered fill under shared caps, trace and ledger.

Facilities are taken in a fixed order until the pool is full. Every facility
draws on the pool and on one shared cap per pool limit (its group, its country,
...). A facility whose draw does not fit takes what is left of its tightest
cap, which uses that cap up; later facilities on a used-up cap are rejected.

The result is fully determined by a short list of *events*: which cap was used
up at which rank, and what the facility at that rank took. Each event uses up a
positive share of the pool, so their number depends on the limit sheet, never on
the data. The fill below looks only for events, and writes them as two small tables; everything else follows
from joining these to the facilities, so plans do not grow with the events.

The last facility takes no more than what is left of the pool, even where the
cap shares alone would let it overshoot the target.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from poolwright import GRAIN
from poolwright.functions.exprs import all_of, least_of
from poolwright.operators.limits import DATE_LIMITS, SEP, SHARE_UNITS, VALUE, LimitSpec, RuleBook, date_share, matched_share, rule_id, with_shares
from poolwright.operators.lookups import lookup_many
from poolwright.operators.ranking import ranked, running_totals, totals_before
from poolwright.session import discard, materialize

NO_VALUE = "None"
# Amounts are counted in ticks of 1/10000 and shares in units of 1e-7, both as
# longs, so running totals are exact whatever the order they are summed in.
TICKS = 10_000
MONEY = "decimal(20,4)"
POOL = "pool size"
# Bounds of a rank bucket, the largest slice of rows ordered in one task.
MIN_BUCKET_ROWS = 16_384
MAX_BUCKET_ROWS = 1_000_000
TARGET_BUCKETS = 2_048
# Rows that one fold takes if buckets are smaller, and rows that it accepts at once.
FOLD_ROWS = 262_144
BLOCK_ROWS = 1_024
LOW_HALF = (1 << 32) - 1
# always followed, whether the sheet limits them or not; a sheet's own limit on the same column is the same limit
ALWAYS_TRACKED = {"divisa": "currency", "financial_product": "financial_product"}


# --- limit universe -------------------------------------------------------

def _tracked(book: RuleBook, always: dict[str, str]) -> list[LimitSpec]:
    specs = book.pool_limits()
    known = {s.columns[-1] for s in specs}
    return specs + [
        LimitSpec(name, [column], "pool", "pool", 0.0, 100_000, 0, False)
        for name, column in always.items() if column not in known
    ]


def _single(spec: LimitSpec) -> LimitSpec:
    """A pool limit goes by one column; an unknown date is as restricted as one beyond the bound."""
    single = replace(spec, columns=[spec.columns[-1]])
    if spec.name in DATE_LIMITS:
        single.null_share = min((share for _, share in spec.days), default=1.0)
    return single


def with_pool_limits(facilities: DataFrame, book: RuleBook, always: dict[str, str] | None = None) -> DataFrame:
    """Add ``limits``: one (type, value, allowed share units) per followed limit.

    The allowed share is the rule of the facility's value, else the ``total``
    rule of the type, else 1. Limits with two concepts go by the second one.
    """
    specs = [_single(s) for s in _tracked(book, ALWAYS_TRACKED if always is None else always)]
    out = with_shares(facilities, book, [s for s in specs if s.rules])
    items = [F.struct(F.lit(s.name).alias("limit_type"), _text(s).alias("limit_value"), _allowed(_pool_share(book, s)).alias("allowed_units")) for s in specs]
    return out.select(*facilities.columns, F.array(*items).alias("limits"))


def _text(spec: LimitSpec) -> Column:
    return F.coalesce(F.col(spec.columns[0]).cast("string"), F.lit(NO_VALUE))


def _allowed(share: Column) -> Column:
    return F.round(share * SHARE_UNITS).cast("long")


def _pool_share(book: RuleBook, spec: LimitSpec) -> Column:
    if not spec.rules:
        return F.lit(1.0)
    return F.coalesce(matched_share(book, spec), F.lit(1.0 if spec.total is None else spec.total))


def universe_of(facilities: DataFrame, book: RuleBook, always: dict[str, str] | None = None) -> DataFrame:
    """Every (limit, value) found on ``facilities`` with its allowed share and amount.

    The values of all limits are reduced to the distinct ones first, combined on the map side; only these meet
    the rule index, in one join. Dates carry the share of the bounds they break.
    """
    items = []
    for spec in (_single(s) for s in _tracked(book, ALWAYS_TRACKED if always is None else always)):
        dated = spec.rules and spec.name in DATE_LIMITS
        items.append(F.struct(
            F.lit(spec.name).alias("limit_type"), _text(spec).alias("limit_value"),
            (rule_id(spec.name, VALUE, F.col(spec.columns[0])) if spec.rules and not dated else F.lit(None).cast("string")).alias("id"),
            (date_share(spec, book.limit_date) if dated else F.lit(1.0 if spec.total is None or not spec.rules else spec.total)).cast("double").alias("otherwise")))
    found = facilities.select(F.explode(F.array(*items)).alias("limit")).select("limit.*").distinct()
    units = _allowed(F.coalesce("value", "otherwise"))
    return _amounts(found.join(book.index, "id", "left").groupBy("limit_type", "limit_value").agg(F.max(units).alias("allowed_units")), book.pool_size)


def _types_of(limited: DataFrame) -> list[str]:
    row = limited.select("limits.limit_type").first()
    return list(row[0]) if row else []


def limit_universe(limited: DataFrame, pool_size: Decimal) -> DataFrame:
    """The same for facilities that carry their ``limits``."""
    each = limited.select(F.explode("limits").alias("limit")).select("limit.*")
    return _amounts(each.groupBy("limit_type", "limit_value").agg(F.max("allowed_units").alias("allowed_units")), pool_size)


def _amounts(caps: DataFrame, pool_size: Decimal) -> DataFrame:
    return caps.withColumns({
        "allowed_share": F.col("allowed_units") / F.lit(float(SHARE_UNITS)),
        "cap_amount": F.col("allowed_units") * F.lit(float(pool_size)) / F.lit(float(SHARE_UNITS)),
    })


# --- events ---------------------------------------------------------------

@dataclass
class Events:
    """What the fill found: two tables, their sizes, and the rank at which the pool was full."""

    used_up: DataFrame  # id of a cap, rank (``value``) that used it up
    settled: DataFrame  # rank, ticks taken
    count: int  # caps used up
    full_at: int | None
    rounds: int


def _units(amount: Column, pool: Decimal) -> Column:
    """Share of the pool in units, rounded to 7 decimals of share."""
    return F.floor(amount.cast("double") * float(SHARE_UNITS) / float(pool) + 0.5)


def pool_ticks(pool: Decimal) -> int:
    return int(pool * TICKS)


def _flat(limits: list[tuple[Column, Column]]) -> list[Column]:
    """Value and allowed units of each limit as plain columns, which Parquet stores and reads one by one."""
    return [c.alias(f"{name}_{i}") for i, pair in enumerate(limits) for name, c in zip(("value", "allowed"), pair)]


def _slots(types: list[str]) -> list[tuple[str, Column, Column]]:
    """Type, value and allowed units of each followed limit: every row has the same types in the same order."""
    return [(kind, F.col(f"value_{i}"), F.col(f"allowed_{i}")) for i, kind in enumerate(types)]


def _limit_rows(rows: DataFrame, types: list[str], *columns: str) -> DataFrame:
    """A row per facility and limit, with ``columns`` of the facility."""
    each = [F.struct(F.lit(kind).alias("limit_type"), value.alias("limit_value"), allowed.alias("allowed_units")) for kind, value, allowed in _slots(types)]
    return rows.select(*columns, F.explode(F.array(*each)).alias("limit")).select(*columns, "limit.*")


def _cap_id(kind: str, value: Column) -> Column:
    return F.concat(F.lit(kind + SEP), value)


def demand(candidates: DataFrame, pool: Decimal, types: list[str]) -> DataFrame:
    """Candidates with their draws: ``wanted`` ticks of the pool, ``units`` of each limit."""
    return candidates.select(
        "rank", "bucket", (F.col("amount").cast(MONEY) * TICKS).cast("long").alias("wanted"),
        _units(F.col("amount"), pool).cast("long").alias("units"), *_flat([(value, allowed) for _, value, allowed in _slots(types)]))


def _bucket_sums(rows: DataFrame, pool: Decimal, types: list[str], some: list[int]) -> DataFrame:
    """Total draw per bucket and cap of ``some`` of the types, the pool included (combined on the map side).

    Rows are grouped by the number of the type and the value, from which the sums get their ids. The upper and the
    lower half of the draws are summed as longs: exact for any sum, without decimal arithmetic per row.
    """
    caps = [F.struct(F.lit(i).alias("kind"), value.alias("value"), allowed.alias("room")) for i, (_, value, allowed) in enumerate(_slots(types)) if i in some]
    caps.append(F.struct(F.lit(len(types)).alias("kind"), F.lit("").alias("value"), F.lit(pool_ticks(pool)).cast("long").alias("room")))
    draws = rows.select("bucket", "wanted", "units", F.explode(F.array(*caps)).alias("cap")).select(
        "bucket", "cap.*", F.when(F.col("cap.kind") == len(types), F.col("wanted")).otherwise(F.col("units")).alias("draw"))
    sums = draws.groupBy("bucket", "kind", "value").agg(
        F.sum(F.shiftright("draw", 32)).alias("high"), F.sum(F.col("draw").bitwiseAND(F.lit(LOW_HALF))).alias("low"), F.first("room").alias("room"))
    starts = F.array(*[F.lit(kind + SEP) for kind in types], F.lit(POOL))
    return sums.select(
        "bucket", F.concat(F.get(starts, F.col("kind")), "value").alias("id"),
        (F.col("high").cast("decimal(20,0)") * F.lit(LOW_HALF + 1).cast("decimal(10,0)") + F.col("low")).cast("decimal(38,0)").alias("draw"), "room")


def _first_tight(sums: DataFrame, start: int) -> int | None:
    """First bucket from ``start`` on in which the running total of some cap reaches its room."""
    so_far = W.partitionBy("id").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    filled = sums.withColumn("filled", F.sum("draw").over(so_far))
    return filled.filter((F.col("bucket") >= start) & (F.col("filled") >= F.col("room"))).agg(F.min("bucket")).first()[0]


def find_events(rows: DataFrame, pool: Decimal, last_bucket: int, types: list[str], bucket_rows: int) -> Events:
    """Find the events of ``demand`` rows; jobs follow the tight stretches, whatever the number of events.

    The draws are summed per bucket and cap once. Caps that all demand together does not reach reject nothing and
    go. A running total over the buckets of each cap, at most ``TARGET_BUCKETS`` or so, finds the first bucket
    where one gets tight; from there a bounded slice is folded in one task. Then the sums are corrected: the slice
    counts as it was used, and what later rows on used-up caps would have drawn is taken off.
    """
    spark = rows.sparkSession
    sums = materialize(_bucket_sums(rows, pool, types, [*range(len(types))]), "sums")
    totals = sums.groupBy("id").agg(F.sum("draw").alias("draw"), F.first("room").alias("room"))
    binding = materialize(totals.filter(F.col("draw") >= F.col("room")).select("id", "room"), "binding")
    sums = sums.join(binding.select("id"), "id", "left_semi")
    # limit types without such a cap need not be looked at again
    kinds = {r[0] for r in binding.select(F.substring_index("id", SEP, 1)).distinct().collect()}
    tight = [i for i, kind in enumerate(types) if kind in kinds]
    parts, width = [], max(1, FOLD_ROWS // bucket_rows)
    start, full_at, count = 0, None, 0
    while start <= last_bucket:
        first = _first_tight(sums, start)
        if first is None:
            break
        stop = min(first + width, last_bucket + 1)
        folded = _fold_slice(rows, types, tight, sums, binding, parts, pool, first, stop)
        info = folded.agg(F.min(F.when(F.col("full"), F.col("rank"))).alias("full_at"), F.count(F.when(F.col("kind") == USED_UP, 1)).alias("n")).first()
        parts.append(folded)
        full_at, start, count = info["full_at"], stop, count + info["n"]
        if full_at is not None or start > last_bucket:
            break
        inside = folded.filter(F.col("kind") == USED).select(F.lit(first).cast("long").alias("bucket"), "id", F.col("amount").cast("decimal(28,0)").alias("draw"))
        kept = sums.filter(~F.col("bucket").between(first, stop - 1)).select("bucket", "id", "draw")
        kept = kept.unionByName(inside)
        if info["n"]:
            kept = kept.unionByName(_newly_excluded(rows, parts, count, types, tight, stop, pool).join(binding.select("id"), "id", "left_semi").select("bucket", "id", (-F.col("draw")).alias("draw")))
        corrected = kept.groupBy("bucket", "id").agg(F.sum("draw").alias("draw")).filter("draw <> 0")
        sums = materialize(corrected.join(binding, "id"), "sums")
    found = _together(spark, parts)
    return Events(
        found.filter(F.col("kind") == USED_UP).select("id", F.col("rank").alias("value")),
        found.filter(F.col("kind") == SETTLED).select("rank", F.col("amount").alias("taken")),
        count, full_at, len(parts))


def _together(spark: SparkSession, parts: list[DataFrame]) -> DataFrame:
    """What all folds wrote, as one scan."""
    if not parts:
        return spark.createDataFrame([], FOLDED)
    return spark.read.schema(FOLDED).parquet(*[p.inputFiles()[0].rsplit("/", 1)[0] for p in parts])


def _ids(types: list[str], some: list[int]) -> list[Column]:
    return [_cap_id(types[i], F.col(f"value_{i}")) for i in some]


def _marks(rows: DataFrame, used_up: DataFrame, count: int, ids: list[Column]) -> tuple[DataFrame, list[str]]:
    """Rows with what ``used_up`` (id, value) holds for each of their caps."""
    names = [f"_mark_{i}" for i in range(len(ids))]
    return lookup_many(rows, used_up, count, dict(zip(names, ids))), names


def _newly_excluded(rows: DataFrame, parts: list[DataFrame], count: int, types: list[str], tight: list[int], start: int, pool: Decimal) -> DataFrame:
    """Draws, by bucket and cap of the ``tight`` types, of the rows from ``start`` on whose first used-up cap is one of the last fold's."""
    last = len(parts) - 1
    used_up = parts[last].filter(F.col("kind") == USED_UP).select("id", F.lit(last).alias("value"))
    if last:
        used_up = used_up.unionByName(_together(rows.sparkSession, parts[:last]).filter(F.col("kind") == USED_UP).select("id", F.lit(0).alias("value")))
    marked, names = _marks(rows.filter(F.col("bucket") >= start), used_up, count, _ids(types, tight))
    least = least_of([F.col(n) for n in names], F.lit(None).cast("int"))
    return _bucket_sums(marked.filter(least == last), pool, types, tight)


FOLDED = "kind string, rank long, id string, amount long, full boolean"
SETTLED, USED_UP, USED = "settled", "used up", "used"


def _fold_slice(rows: DataFrame, types: list[str], tight: list[int], sums: DataFrame, binding: DataFrame, parts: list[DataFrame], pool: Decimal, first: int, stop: int) -> DataFrame:
    """Settle every event of the buckets ``first`` to ``stop - 1``; rows of ``FOLDED``.

    Whether a facility fits depends on all before it, so the slice, a bounded part of the order, is folded
    in a single task. What its caps have left comes first, then its rows by rank.
    """
    ids = F.array(*_ids(types, tight)).cast("array<string>")
    inside = rows.filter(F.col("bucket").between(first, stop - 1)).select("rank", "wanted", "units", ids.alias("caps"))
    used = sums.filter(F.col("bucket") < first).groupBy("id").agg(F.sum("draw").alias("used"))
    # caps of the slice, and the pool
    own = inside.select(F.explode("caps").alias("id")).distinct().unionByName(rows.sparkSession.range(1).select(F.lit(POOL).alias("id")))
    left = binding.join(own, "id", "left_semi").join(used, "id", "left").select("id", (F.col("room") - F.coalesce("used", F.lit(0))).cast("long").alias("left"))
    if parts:
        gone = _together(rows.sparkSession, parts).filter(F.col("kind") == USED_UP).select("id", F.lit(True).alias("gone"))
        left = left.join(gone, "id", "left").select("id", F.when(F.col("gone"), F.lit(GONE)).otherwise(F.col("left")).alias("left"))
    none = F.lit(None)
    stream = left.select(F.lit(-1).cast("long").alias("rank"), "id", "left", none.cast("long").alias("wanted"), none.cast("long").alias("units"), none.cast("array<string>").alias("caps"))
    stream = stream.unionByName(inside.select("rank", none.cast("string").alias("id"), none.cast("long").alias("left"), "wanted", "units", "caps"))
    size = pool_ticks(pool)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = SliceFold(size)
        for batch in batches:
            state.take(batch)
        out = [(SETTLED, r, None, taken, full) for r, taken, full in state.settled]
        out += [(USED_UP, r, i, None, None) for i, r in state.used_up()]
        out += [(USED, None, i, n, None) for i, n in state.used()]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], [c.split()[0] for c in FOLDED.split(", ")])

    return materialize(stream.repartition(1).sortWithinPartitions("rank").mapInArrow(fold, FOLDED), "folded")


#: What a cap that was used up before has left: it rejects, whatever the rounding left on it.
GONE = -(1 << 62)
#: What a cap has left that nothing can use up.
ENDLESS = 1 << 62


class SliceFold:
    """What the facilities of one slice take, in their order.

    Rows are accepted a block at a time, by sums per cap. A block in which a cap gets tight is walked row by row.
    """

    def __init__(self, pool: int) -> None:
        self.pool = pool  # in ticks
        self.code: dict[str | None, int] = {}
        self.names: list[str] = []
        # by cap: what is left, what was left at the start, the rank that used it up (-1: open, -2: before the slice)
        self.left = np.array([ENDLESS], np.int64)
        self.at_start = self.left.copy()
        self.gone = np.array([-1], np.int64)
        self.settled: list[tuple[int, int, bool]] = []
        self.full = False

    def _codes(self, ids: pa.Array) -> np.ndarray:
        """Number of every cap; those that cannot get tight have one number together."""
        encoded = ids.fill_null("").dictionary_encode()
        own = np.array([self.code.get(i, 0) for i in encoded.dictionary.to_pylist()], np.int64)
        return own[encoded.indices.to_numpy(zero_copy_only=False)]

    def take(self, batch: pa.RecordBatch) -> None:
        ranks = batch.column("rank").to_numpy()
        caps = int(np.searchsorted(ranks, 0))
        if caps:
            for name in batch.column("id")[:caps].to_pylist():
                self.names.append(name)
                self.code[name] = len(self.names)
            self.left = np.concatenate([self.left, batch.column("left")[:caps].to_numpy(zero_copy_only=False).astype(np.int64)])
            self.at_start = self.left.copy()
            self.gone = np.where(self.left == GONE, -2, -1)
        if caps == batch.num_rows or self.full:
            return
        rows = batch.slice(caps)
        lists = rows.column("caps")
        width = len(lists[0])
        codes = self._codes(lists.flatten()).reshape(rows.num_rows, width)
        # every facility draws on the pool, in ticks, as its last cap
        pool = np.full((len(codes), 1), self.code.get(POOL, 0), np.int64)
        codes = np.concatenate([codes, pool], axis=1)
        wanted, units = rows.column("wanted").to_numpy(), rows.column("units").to_numpy()
        for a in range(0, len(codes), BLOCK_ROWS):
            b = a + BLOCK_ROWS
            self._block(ranks[caps:][a:b], wanted[a:b], units[a:b], codes[a:b])
            if self.full:
                return

    def _block(self, ranks: np.ndarray, wanted: np.ndarray, units: np.ndarray, codes: np.ndarray) -> None:
        live = (self.gone[codes] == -1).all(axis=1)
        ranks, wanted, units, codes = ranks[live], wanted[live], units[live], codes[live]
        draws = np.repeat(units[:, None], codes.shape[1], axis=1)
        draws[:, -1] = wanted
        sums = np.zeros(len(self.left), np.int64)
        np.add.at(sums, codes.ravel(), draws.ravel())
        sums[0] = 0
        if (self.left - sums > 0)[np.unique(codes)].all():
            self.left -= sums
            return
        for rank, own, drawn, want in zip(ranks.tolist(), codes.tolist(), draws.tolist(), wanted.tolist()):
            if any(self.gone[c] != -1 for c in own):
                continue
            if any(c and self.left[c] - d <= 0 for c, d in zip(own, drawn)):
                drawn = self._settle(rank, want, own)
            for c, d in zip(own, drawn):
                if c:
                    self.left[c] -= d
            if self.full:
                return

    def _settle(self, rank: int, wanted: int, own: list[int]) -> list[int]:
        """Let the facility take what its tightest cap leaves, rounded to the tick, and note what it used up."""
        size, left = self.pool, [int(self.left[c]) for c in own]
        ticks = [(2 * size * n + SHARE_UNITS) // (2 * SHARE_UNITS) for n in left[:-1]] + left[-1:]
        take = min(wanted, *ticks)
        units = math.floor(take / TICKS * SHARE_UNITS / (size / TICKS) + 0.5)
        for c, n, most in zip(own[:-1], left, ticks):
            if c and (n - units <= 0 or most <= take):
                self.gone[c] = rank
        self.full = bool(own[-1]) and left[-1] - take <= 0
        self.settled.append((rank, take, self.full))
        return [units] * (len(own) - 1) + [take]

    def used_up(self) -> list[tuple[str, int]]:
        return [(name, int(self.gone[c])) for c, name in enumerate(self.names, 1) if self.gone[c] >= 0]

    def used(self) -> list[tuple[str, int]]:
        return [(name, int(self.at_start[c] - self.left[c])) for c, name in enumerate(self.names, 1) if self.at_start[c] != self.left[c]]


# --- the fill -------------------------------------------------------------

def bucket_rows_for(rows: int) -> int:
    return max(MIN_BUCKET_ROWS, min(MAX_BUCKET_ROWS, -(-rows // TARGET_BUCKETS)))


ORDER_COLUMNS = ("reg_capital_ratio",)


def fill_columns(book: RuleBook, order_columns: tuple[str, ...] = ORDER_COLUMNS) -> list[str]:
    """What a fill reads of its facilities."""
    limited = [s.columns[-1] for s in _tracked(book, ALWAYS_TRACKED)]
    return [*dict.fromkeys([*GRAIN, *order_columns, "eligible_amount", "is_candidate", *limited])]


def default_order() -> list[Column]:
    """Most regulatory capital per exposure first, facility key as tie-breaker."""
    key = F.concat_ws("_", *GRAIN)
    return [F.desc_nulls_last("reg_capital_ratio"), F.desc(key)]


@dataclass
class Filled:
    """A fill: the decisions by facility, the facilities they are about, and the size of the pool."""

    rows: DataFrame  # key, rank, amounts and running totals of what was visited before the pool was full
    draws: DataFrame  # key, rank, amount, value and allowed units of each limit, of the same
    rest: DataFrame  # key, value and allowed units of each limit, of what comes later
    facilities: DataFrame
    pool: Decimal
    types: list[str]  # of the limits
    events: Events | None = None

    def save(self, folder: str) -> None:
        """Write the fill, for reports of later runs; ``load_fill`` reads it."""
        self.rows.write.parquet(f"{folder}/rows")
        self.draws.write.parquet(f"{folder}/draws")
        self.rest.write.parquet(f"{folder}/rest")
        self.facilities.write.parquet(f"{folder}/facilities")
        types = F.array(*[F.lit(t) for t in self.types]).cast("array<string>")
        self.rows.sparkSession.range(1).select(F.lit(self.pool).cast(MONEY).alias("pool"), types.alias("types")).write.parquet(f"{folder}/pool")


def load_fill(spark: SparkSession, folder: str) -> Filled:
    of = spark.read.parquet(f"{folder}/pool").first()
    rows, draws, rest, facilities = (spark.read.parquet(f"{folder}/{name}") for name in ("rows", "draws", "rest", "facilities"))
    return Filled(rows, draws, rest, facilities, of["pool"], list(of["types"]))


def fill_pool(facilities: DataFrame, pool_size: Decimal, order: list[Column] | None = None,
              bucket_rows: int | None = None, book: RuleBook | None = None, order_columns: tuple[str, ...] | None = None) -> Filled:
    """Allocate the pool over ``facilities`` (with ``eligible_amount`` and ``is_candidate``), one row a facility key.

    Adds the rank, the amount taken, running totals, and why a candidate was
    left out. Rows after the one that filled the pool keep initial values.
    The limits come from ``book``, added after the sort so that it moves narrow
    rows, or are already there as ``limits``. ``order`` reads ``order_columns``; only these, the key, the
    amount and the columns of the limits are sorted and written, and the other columns are joined back by key.
    """
    facilities = materialize(facilities, "facilities")
    if order is None:
        order, order_columns = default_order(), ORDER_COLUMNS
    limited = [s.columns[-1] for s in _tracked(book, ALWAYS_TRACKED)] if book is not None else ["limits"]
    needed = [*GRAIN, *(order_columns or facilities.columns), "eligible_amount", "is_candidate", *limited]
    by_rank, count = ranked(facilities.select(*dict.fromkeys(needed)), order)
    placed = by_rank
    size = bucket_rows or bucket_rows_for(count)
    if book is not None:
        specs = [_single(s) for s in _tracked(book, ALWAYS_TRACKED)]
        types = [s.name for s in specs]
        placed, pairs = with_shares(placed, book, [s for s in specs if s.rules]), [(_text(s), _allowed(_pool_share(book, s))) for s in specs]
    else:
        types = _types_of(placed)
        pairs = [(F.col("limits")[i]["limit_value"], F.col("limits")[i]["allowed_units"]) for i in range(len(types))]
    bucket = F.floor((F.col("rank") - 1) / size).cast("long").alias("bucket")
    placed = materialize(placed.select(*GRAIN, "rank", bucket, "eligible_amount", "is_candidate", *_flat(pairs)), "placed")
    discard(by_rank)
    slots = _slots(types)
    is_candidate = F.col("is_candidate") == 1
    open_caps = all_of([allowed > 0 for _, _, allowed in slots])
    candidates = placed.filter(is_candidate & open_caps).withColumn("amount", F.col("eligible_amount"))
    events = find_events(demand(candidates, pool_size, types), pool_size, (count - 1) // size if count else -1, types, size)

    # which cap was used up before a row, and what a row was settled at, are joined from the events' tables
    names = [f"_since_{i}" for i in range(len(slots))]
    # what comes after the row that filled the pool takes nothing: only its limits are kept
    visited, rest = (placed, placed.filter(F.lit(False))) if events.full_at is None else (
        placed.filter(F.col("rank") <= events.full_at), placed.filter(F.col("rank") > events.full_at))
    marked = lookup_many(visited, events.used_up, events.count, {n: _cap_id(kind, value) for n, (kind, value, _) in zip(names, slots)})
    marked = marked.join(events.settled, "rank", "left")
    # the last limit in sheet order that rejects the row
    spent = [F.when((allowed <= 0) | F.coalesce(F.col(n) < F.col("rank"), F.lit(False)), F.struct(
        F.lit(kind).alias("limit_type"), value.alias("limit_value"), allowed.alias("allowed_units")))
        for n, (kind, value, allowed) in zip(names, slots)]
    settled = (F.col("taken").cast("decimal(28,0)") / TICKS).cast(MONEY)
    marked = marked.withColumns({"last_spent": F.coalesce(*reversed(spent)), "settled": settled})
    taken = F.when(~is_candidate, F.lit(0)).when(F.col("settled").isNotNull(), F.col("settled")).when(
        F.col("last_spent").isNotNull(), F.lit(0)).otherwise(F.col("eligible_amount")).cast(MONEY)
    decided = materialize(marked.select(
        *GRAIN, "rank", "bucket", taken.alias("allocated_amount"), "last_spent",
        least_of([allowed for _, _, allowed in slots], F.lit(SHARE_UNITS).cast("long")).alias("tightest_units"),
        *_flat([(value, allowed) for _, value, allowed in slots])), "decided")
    flat = [f"{name}_{i}" for i in range(len(types)) for name in ("value", "allowed")]
    rows = running_totals(decided.drop(*flat), [], "bucket", "rank", {
        "filled": F.col("allocated_amount"),
        "selected_so_far": F.when(F.col("allocated_amount") > 0, 1).otherwise(0),
    })
    # the allocation starts from the rows, trace and ledger from the draws
    draws = decided.select(*GRAIN, "rank", "bucket", "allocated_amount", *flat)
    return Filled(materialize(rows, "filled"), draws, rest.select(*GRAIN, *flat), facilities.drop("limits"), pool_size, types, events)


def allocation(filled: Filled) -> DataFrame:
    """One row per facility: selection, amounts, running shares, exclusion reason."""
    rows = filled.facilities.join(filled.rows.withColumn("visited", F.lit(True)), GRAIN, "left").withColumns({
        "visited": F.coalesce("visited", F.lit(False)), "allocated_amount": F.coalesce("allocated_amount", F.lit(0).cast(MONEY))})
    size = float(filled.pool)
    taken = F.col("allocated_amount")
    selected, visited = taken > 0, F.col("visited")
    before = (F.col("filled") - taken).cast("double")
    wanted = F.col("eligible_amount").cast("double")
    room_share = F.when(before + wanted > size, F.try_divide(F.lit(size) - before, wanted)).otherwise(F.lit(1.0))
    tightest = F.col("tightest_units") / F.lit(float(SHARE_UNITS))
    rejected = visited & (F.col("is_candidate") == 1) & ~selected
    last_spent = F.col("last_spent")
    return rows.withColumns({
        "is_selected": selected.cast("int"),
        "candidate_rank": F.when(visited, F.col("rank")).otherwise(F.lit(0)),
        "selected_rank": F.when(selected, F.col("selected_so_far")).otherwise(F.lit(0)),
        "pool_limit": F.when(visited, F.least(room_share, tightest)).otherwise(F.lit(1.0)),
        "pool_share": F.when(selected, _units(taken, filled.pool) / F.lit(float(SHARE_UNITS))).otherwise(F.lit(0.0)),
        "cumulative_amount": F.when(visited, F.col("filled")).otherwise(F.lit(0).cast(MONEY)),
        "cumulative_share": F.when(visited, _units(F.col("filled"), filled.pool) / F.lit(float(SHARE_UNITS)))
        .otherwise(F.lit(0.0)),
        "facility_share": F.when(selected, F.round(F.try_divide(taken.cast("double"), F.col("base_amount").cast("double")), 7))
        .otherwise(F.lit(0.0)),
        "exclusion_reason": F.when(
            rejected,
            F.when(last_spent["allowed_units"] == 0, "pool limit 0").otherwise("pool limit used up"),
        ).otherwise(F.col("exclusion_reason")),
        "exclusion_detail": F.when(
            rejected, F.concat_ws("-", last_spent["limit_type"], last_spent["limit_value"]),
        ).otherwise(F.col("exclusion_detail")),
    }).drop("last_spent", "tightest_units", "filled", "selected_so_far")


def allocation_trace(filled: Filled) -> DataFrame:
    """One row per facility and limit: allowed, used after the row, available before it."""
    keys = ["limit_type", "limit_value"]
    totals = _used(filled)
    share, pool = F.lit(float(SHARE_UNITS)), F.lit(float(filled.pool))
    available = F.greatest(F.col("allowed_units") - (F.col("used_units") - F.col("_draw_units")), F.lit(0))
    visited = totals.select(
        *GRAIN, F.col("rank").alias("candidate_rank"), *keys,
        (F.col("allowed_units") / share).alias("allowed_share"), (F.col("allowed_units") * pool / share).alias("cap_amount"),
        (available / share).alias("available_share"), (F.col("used_units") / share).alias("used_share"), "used_amount")
    # later rows keep initial values, which need no totals: they stay in place
    initial = {"candidate_rank": F.lit(0), "allowed_share": F.lit(1.0), "cap_amount": pool, "available_share": F.lit(None), "used_share": F.lit(0.0), "used_amount": F.lit(0)}
    rest = _limit_rows(filled.rest, filled.types, *GRAIN).withColumns(initial)
    return visited.unionByName(rest.select(*[F.col(f.name).cast(f.dataType) for f in visited.schema]))


def _used(filled: Filled) -> DataFrame:
    """Visited facilities by limit, with what is used of its cap after each: ``used_units`` and ``used_amount``.

    Facilities are dealt by bucket before they become a row per limit. What the buckets before hold of a cap comes along as
    a row of its own that sorts first, so the running total of a cap in its bucket is the whole one.
    """
    drawn = filled.draws.withColumn("_draw_units", F.when(F.col("allocated_amount") > 0, _units(F.col("allocated_amount"), filled.pool)).otherwise(F.lit(0)).cast("long"))
    slots = _slots(filled.types)
    caps = [F.struct(F.lit(i).alias("kind"), value.alias("limit_value"), allowed.alias("allowed_units")) for i, (_, value, allowed) in enumerate(slots)]
    drawn = drawn.select(*GRAIN, "rank", "bucket", "_draw_units", F.col("allocated_amount").alias("_draw_amount"), F.array(*caps).alias("caps"))

    def by_cap(rows: DataFrame) -> DataFrame:
        return rows.withColumn("cap", F.explode("caps")).select(*[c for c in rows.columns if c != "caps"], "cap.*")

    before = totals_before(by_cap(drawn), ["kind", "limit_value"], "bucket", {"units": "_draw_units", "amount": "_draw_amount"})
    before = before.filter("_o_units > 0 OR _o_amount > 0").select(
        *[F.lit(None).cast(drawn.schema[c].dataType).alias(c) for c in GRAIN], F.lit(0).cast("long").alias("rank"), "bucket",
        F.col("_o_units").alias("_draw_units"), F.col("_o_amount").alias("_draw_amount"),
        F.array(F.struct("kind", "limit_value", F.lit(None).cast("long").alias("allowed_units"))).alias("caps"))
    dealt = by_cap(drawn.unionByName(before).repartition("bucket"))
    so_far = W.partitionBy("bucket", "kind", "limit_value").orderBy("rank").rowsBetween(W.unboundedPreceding, W.currentRow)
    totals = dealt.withColumns({"used_units": F.sum("_draw_units").over(so_far), "used_amount": F.sum("_draw_amount").over(so_far)}).filter("rank > 0")
    return totals.withColumn("limit_type", F.get(F.array(*[F.lit(kind) for kind in filled.types]), F.col("kind")))


def limit_ledger(filled: Filled, scenario: str) -> DataFrame:
    """Final state of every cap: allowed, used, cap amount, used amount."""
    flat = _limit_rows(filled.draws, filled.types, "allocated_amount").unionByName(
        _limit_rows(filled.rest, filled.types).withColumn("allocated_amount", F.lit(0).cast(MONEY)))
    units = F.when(F.col("allocated_amount") > 0, _units(F.col("allocated_amount"), filled.pool)).otherwise(F.lit(0))
    share, pool = F.lit(float(SHARE_UNITS)), F.lit(float(filled.pool))
    return flat.groupBy("limit_type", "limit_value").agg(
        F.max("allowed_units").alias("allowed_units"), F.sum(units).alias("used_units"),
        F.sum("allocated_amount").alias("used_amount"),
    ).select(
        "limit_type", "limit_value", (F.col("allowed_units") / share).alias("allowed_share"),
        (F.col("used_units") / share).alias("used_share"),
        (F.col("allowed_units") * pool / share).alias("cap_amount"), "used_amount",
        F.lit(scenario).alias("scenario"),
    )
