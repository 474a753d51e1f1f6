"""Global order and running totals without a one-task window."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from poolwright.session import discard, materialize

LOW_BITS = (1 << 33) - 1
#: Buckets whose totals are summed together.
SPAN = 1024


def ranked(df: DataFrame, order: list[Column], label: str = "ranked") -> tuple[DataFrame, int]:
    """``df`` with its global position ``rank`` (from 1), and the row count.

    ``df`` is the key and what the order needs, little more: its rows are written before the sort, which reads them
    twice (for the range edges, then to sort), and after it. The sort is written once, so the range partitions are fixed; a row's rank
    is its place in its partition plus the sizes of the partitions before it.
    Only the partition sizes reach the driver.
    """
    narrow = materialize(df, f"{label}-input")
    placed = narrow.orderBy(*order).withColumns({
        "_part": F.spark_partition_id(),
        "_place": F.monotonically_increasing_id().bitwiseAND(F.lit(LOW_BITS)),
    })
    stored = materialize(placed, label)
    discard(narrow)
    sizes = sorted((r["_part"], r["count"]) for r in stored.groupBy("_part").count().collect())
    totals = list(accumulate((n for _, n in sizes), initial=0))
    offsets = df.sparkSession.createDataFrame(
        [(part, offset) for (part, _), offset in zip(sizes, totals)], "_part int, _offset long")
    # one row per sort partition, so the broadcast is bounded by the shuffle setting
    out = stored.join(F.broadcast(offsets), "_part").withColumn("rank", F.col("_offset") + F.col("_place") + 1)
    return out.drop("_part", "_place", "_offset"), totals[-1]


def running_totals(df: DataFrame, keys: list[str], bucket: str, order: str,
                   sums: dict[str, Column]) -> DataFrame:
    """Inclusive running sums per key, in three levels.

    Buckets are bounded slices of the order, and spans are ``SPAN`` buckets.
    Totals of buckets and of spans are summed first (combined on the map side);
    their running totals become offsets, and rows are only ordered within their
    bucket: a key that holds most rows is spread over as many tasks as it has
    buckets. What one window orders is a bucket, the buckets of a span, or the
    spans of a key, a millionth and less of the rows.
    """
    named = df.withColumns({f"_{name}": expr for name, expr in sums.items()})
    offsets = totals_before(named, keys, bucket, {name: f"_{name}" for name in sums})
    within = W.partitionBy(*keys, bucket).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    joined = named.join(offsets, [*keys, bucket])
    return joined.withColumns({
        name: F.col(f"_o_{name}") + F.sum(f"_{name}").over(within) for name in sums
    }).drop(*[f"_{name}" for name in sums], *[f"_o_{name}" for name in sums])


def totals_before(df: DataFrame, keys: list[str], bucket: str, sums: dict[str, str]) -> DataFrame:
    """One row per key and bucket: what the buckets before hold in all, as ``_o_<name>`` for each column of ``sums``."""
    totals = df.groupBy(*keys, bucket).agg(*[F.sum(column).alias(f"_t_{name}") for name, column in sums.items()])
    totals = totals.withColumn("_span", F.floor(F.col(bucket) / SPAN))
    of_spans = totals.groupBy(*keys, "_span").agg(*[F.sum(f"_t_{name}").alias(f"_s_{name}") for name in sums])
    # without keys all spans are one group; a constant key keeps that a plain hash partition
    grouped = [*keys] or [F.lit(0)]
    before = W.partitionBy(*grouped).orderBy("_span").rowsBetween(W.unboundedPreceding, -1)
    of_spans = of_spans.select(*keys, "_span", *[F.coalesce(F.sum(f"_s_{name}").over(before), F.lit(0)).alias(f"_s_{name}") for name in sums])
    earlier = W.partitionBy(*keys, "_span").orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    return totals.join(of_spans, [*keys, "_span"]).select(*keys, bucket, *[
        (F.col(f"_s_{name}") + F.coalesce(F.sum(f"_t_{name}").over(earlier), F.lit(0))).alias(f"_o_{name}") for name in sums])
