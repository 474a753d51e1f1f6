"""Registration of queries with their SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from poolwright.workload.sql_tables import with_ctes
from poolwright.workload.tables import Tables


@dataclass
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None, recursive: bool = False, instead: dict[str, str] | None = None):
    """Register ``fn(tables) -> DataFrame``; ``sql`` may name any logical table, ``instead`` redefines some for it."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = Query(lambda spark, path: fn(Tables(spark, path)),
                              with_ctes(sql, recursive, instead) if sql else None)
        return fn

    return register
