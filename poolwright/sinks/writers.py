"""Writers: partitioned Parquet, schema alignment, history, CSV and JDBC options."""

from __future__ import annotations

import uuid
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stamp(df: DataFrame, **values) -> DataFrame:
    """Constant columns such as the run date."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def align_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """Cast shared columns to the target's types; extra columns stay as they are."""
    wanted = {field.name: field.dataType for field in target}
    return df.select(*[F.col(c).cast(wanted[c]).alias(c) if c in wanted else F.col(c) for c in df.columns])


def align_to_path(df: DataFrame, path: str) -> DataFrame:
    """Align to the Parquet already at ``path``; a missing path changes nothing."""
    try:
        target = df.sparkSession.read.parquet(path).schema
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return df
    return align_schema(df, target)


def write_partitioned(df: DataFrame, path: str, columns: list[str]) -> None:
    """Replace only the partitions present in ``df``.

    The rebalance hint gathers the rows of a partition value into few files and
    splits a value that is too large for one task, so a hot date does not
    serialise the write.
    """
    aligned = align_to_path(df, path).hint("rebalance", *[F.col(c) for c in columns])
    (aligned.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*columns).parquet(path))


def write_compacted(df: DataFrame, path: str, files: int | None = None) -> None:
    """Unpartitioned Parquet in ``files`` files (left to Spark when not given)."""
    out = df.repartition(files) if files else df
    out.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


COMMITS = "run string, sequence long, entries array<struct<name: string, closing_date: string, path: string>>"


def committed(spark: SparkSession, root: str) -> tuple[int, dict[tuple[str, str], str]]:
    """Number of the last commit under ``root`` and the folder of every (table, date) it names; 0 and none at first."""
    try:
        commits = spark.read.schema(COMMITS).parquet(f"{root}/commits")
        last = commits.orderBy(F.desc("sequence"), F.desc("run")).first()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return 0, {}
    return (0, {}) if last is None else (last["sequence"], {(e["name"], e["closing_date"]): e["path"] for e in last["entries"]})


def publish(tables: dict[str, DataFrame], root: str, closing_date: date | str) -> None:
    """Write dated tables that appear together or not at all.

    Every table goes to a folder of its own run, which nothing names yet. When all of them are there, one row is added to the commits: the
    folders of every table and date from now on, those of this date replaced. It is one file
    that its writer renames into place, so readers (``read_current``, ``read_history``) see the old tables or the new ones. A run that
    fails before leaves folders that no commit names. Runs of one ``root`` follow one another.
    """
    spark = next(iter(tables.values())).sparkSession
    run, day = uuid.uuid4().hex, str(closing_date)
    paths = {name: f"{root}/{name}/closing_date={day}/run={run}" for name in tables}
    for name, df in tables.items():
        df.write.parquet(paths[name])
    sequence, entries = committed(spark, root)
    entries |= {(name, day): path for name, path in paths.items()}
    row = (run, sequence + 1, [(name, of, path) for (name, of), path in sorted(entries.items())])
    spark.createDataFrame([row], COMMITS).coalesce(1).write.mode("append").parquet(f"{root}/commits")


def read_history(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Every dated copy of a table, the date as column ``closing_date``; older copies may lack newer columns."""
    found = [(day, path) for (of, day), path in committed(spark, root)[1].items() if of == name]
    if not found:
        raise ValueError(f"{name} was never published under {root}")
    parts = [spark.read.parquet(path).withColumn("closing_date", F.lit(day)) for day, path in sorted(found)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_current(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The newest dated copy of a table."""
    found = [(day, path) for (of, day), path in committed(spark, root)[1].items() if of == name]
    if not found:
        raise ValueError(f"{name} was never published under {root}")
    day, path = max(found)
    return spark.read.parquet(path).withColumn("closing_date", F.lit(day))


def jdbc_options(url: str, table: str, writers: int = 8, batch: int = 10_000, **extra: str) -> dict[str, str]:
    """Options for a truncating JDBC overwrite with bounded parallelism."""
    return {
        "url": url,
        "dbtable": table,
        "truncate": "true",
        "numPartitions": str(writers),
        "batchsize": str(batch),
        **extra,
    }


def write_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    df.write.format("jdbc").options(**jdbc_options(url, table, **options)).mode("overwrite").save()


def read_jdbc(spark, url: str, table: str, split_on: str | None = None, low=None, high=None,
              readers: int = 8) -> DataFrame:
    """JDBC table, read in slices when a numeric split column is given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if split_on is not None:
        reader = (reader.option("partitionColumn", split_on).option("lowerBound", low)
                  .option("upperBound", high).option("numPartitions", readers))
    return reader.load()
