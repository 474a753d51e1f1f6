"""Keep-first, keep-ties and duplicate reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order`` (give a total order).

    Spark trims every map task to one row per key before the shuffle, so a hot
    key costs one row per task, not its whole group.
    """
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def keep_best_with_ties(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """All rows that share the first place of their key."""
    place = F.rank().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def null_profile(df: DataFrame) -> DataFrame:
    """Non-null count of every column, one row per column, from a single pass."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    return counts.unpivot([], counts.columns, "column_name", "non_null")


def drop_empty_columns(df: DataFrame) -> DataFrame:
    empty = null_profile(df).filter(F.col("non_null") == 0)
    return df.drop(*[row.column_name for row in empty.collect()])
