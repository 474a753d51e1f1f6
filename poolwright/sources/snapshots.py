"""Dated snapshots: which date to read, and the read itself.

Where no predicate needs rows, dates come from metadata: ``snapshots_of`` lists the dated folders
of a path, ``newest_in_footers`` reads the statistics that Parquet files hold, and neither opens data. The functions that take a
DataFrame aggregate its rows, for predicates and for sources that are no files.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def snapshots_of(spark: SparkSession, path: str, date_col: str) -> DataFrame:
    """One row per dated folder ``date_col=...`` of a path, with its files and their bytes, from the listing alone.

    The files are listed as they are, without their content: none is opened.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", False).load(path)
    return files.groupBy(date_col).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def newest_snapshot(spark: SparkSession, path: str, date_col: str):
    """The newest dated folder of a path; None without any."""
    return snapshots_of(spark, path, date_col).agg(F.max(date_col)).first()[0]


def common_snapshot(spark: SparkSession, paths: list[str], date_col: str):
    """The oldest of the newest folders of several paths."""
    newest = [snapshots_of(spark, path, date_col).agg(F.max(date_col).alias("newest")) for path in paths]
    return reduce(DataFrame.unionByName, newest).agg(F.min("newest")).first()[0]


def snapshot_exists(spark: SparkSession, path: str, date_col: str, value) -> bool:
    return not snapshots_of(spark, path, date_col).filter(F.col(date_col) == value).isEmpty()


#: Aggregates are pushed to the footers by the newer Parquet reader only.
FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def newest_in_footers(spark: SparkSession, path: str, column: str):
    """The largest value of a number or date column that is no folder name, from the statistics in the files' footers."""
    before = {name: spark.conf.get(name, None) for name in FOOTERS}
    try:
        for name, value in FOOTERS.items():
            spark.conf.set(name, value)
        return spark.read.parquet(path).agg(F.max(column)).first()[0]
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def latest_snapshot(df: DataFrame, date_col: str, where: Column | None = None) -> DataFrame:
    """One row, one column: the newest date among the rows that satisfy ``where``."""
    if where is not None:
        df = df.filter(where)
    return df.agg(F.max(date_col).alias(date_col))


def common_snapshot_date(sources: list[tuple[DataFrame, str, Column | None]]) -> DataFrame:
    """The oldest of the newest dates of several sources (column ``value_date``)."""
    newest = [
        latest_snapshot(df, col, where).select(F.col(col).alias("value_date"))
        for df, col, where in sources
    ]
    return reduce(DataFrame.unionByName, newest).agg(F.min("value_date").alias("value_date"))


def has_snapshot(df: DataFrame, date_col: str, value) -> bool:
    return not df.filter(F.col(date_col) == F.lit(value)).select(date_col).isEmpty()


def snapshot_presence(df: DataFrame, date_col: str, wanted: DataFrame) -> DataFrame:
    """For each row of ``wanted`` whether a snapshot of that date exists."""
    present = df.select(date_col).distinct().withColumn("present", F.lit(True))
    return wanted.join(present, date_col, "left").fillna(False, subset=["present"])


def scan_latest(df: DataFrame, date_col: str, where: Column | None = None) -> DataFrame:
    """Rows of the newest snapshot.

    The date is fetched first (one value) and applied as a literal, so the scan
    prunes partitions statically instead of joining on the date.
    """
    newest = latest_snapshot(df, date_col, where).first()[0]
    return scan_at(df, date_col, newest)


def scan_at(df: DataFrame, date_col: str, value) -> DataFrame:
    return df.filter(F.col(date_col) == F.lit(value))


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Parquet whose older snapshots may lack newer columns."""
    return spark.read.option("mergeSchema", True).parquet(path)


def read_partition(spark: SparkSession, path: str, date_col: str, value) -> DataFrame:
    """One partition folder, keeping its partition column."""
    return spark.read.option("basePath", path).parquet(f"{path}/{date_col}={value}")


def catalog_latest(spark: SparkSession, table: str, date_col: str) -> str | None:
    """Newest value of one partition key of a catalogue table, from its partition list."""
    names = spark.sql(f"SHOW PARTITIONS {table}")
    value = F.regexp_extract("partition", rf"(?:^|/){date_col}=([^/]+)", 1)
    return names.agg(F.max(F.nullif(value, F.lit("")))).first()[0]


def scan_catalog_latest(spark: SparkSession, table: str, date_col: str) -> DataFrame:
    newest = catalog_latest(spark, table, date_col)
    return spark.table(table).filter(F.col(date_col).cast("string") == newest)


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """Stop early when a mandatory source is empty."""
    if df.isEmpty():
        raise ValueError(f"{name} has no rows")
    return df
