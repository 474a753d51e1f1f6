"""Delimited text sources and literal dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from poolwright.session import literal_rows


def read_csv(spark: SparkSession, path: str, columns: list[str], sep: str = ";") -> DataFrame:
    """Headered text; every column arrives as a string and is cast by its consumer."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).option("header", True).option("sep", sep).csv(path)


def literal_dimension(spark: SparkSession, mapping: dict, key: str, value: str) -> DataFrame:
    """Two-column table from a dict; its exact size lets Spark broadcast it on its own."""
    return literal_rows(spark, list(mapping.items()), f"{key} string, {value} string")
