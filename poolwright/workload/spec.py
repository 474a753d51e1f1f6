"""One column spec drives the final projection in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# kind -> (Spark expression, SQL template)
KINDS = {
    "s": (lambda c: F.col(c).cast("string"), "CAST({c} AS VARCHAR)"),
    "d": (lambda c: F.date_format(c, "yyyy-MM-dd"), "STRFTIME({c}, '%Y-%m-%d')"),
    "i": (lambda c: F.col(c).cast("long"), "CAST({c} AS BIGINT)"),
    "b": (lambda c: F.col(c).cast("boolean"), "CAST({c} AS BOOLEAN)"),
    "f": (lambda c: F.col(c).cast("double"), "CAST({c} AS DOUBLE)"),
    "m": (lambda c: F.col(c).cast("decimal(38,4)").cast("double"), "CAST(CAST({c} AS DECIMAL(38,4)) AS DOUBLE)"),
    "r": (lambda c: F.round(F.col(c).cast("double"), 6), "ROUND(CAST({c} AS DOUBLE), 6)"),
    "q": (lambda c: F.round(F.col(c).cast("double"), 8), "ROUND(CAST({c} AS DOUBLE), 8)"),
    "p": (lambda c: F.round(F.col(c).cast("double"), 7), "ROUND(CAST({c} AS DOUBLE), 7)"),
}


def _items(spec: str) -> list[tuple[str, str]]:
    items = []
    for word in spec.split():
        kind, _, name = word.rpartition(":")
        items.append((kind or "s", name))
    return items


def project(df: DataFrame, spec: str) -> DataFrame:
    """``"facility_id m:reg_ead d:expiry_date"`` -> plain strings, doubles and longs."""
    return df.select(*[KINDS[kind][0](name).alias(name) for kind, name in _items(spec)])


def sql_columns(spec: str) -> str:
    return ", ".join(f"{KINDS[kind][1].format(c=name)} AS {name}" for kind, name in _items(spec))
