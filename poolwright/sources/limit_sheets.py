"""Choosing which loaded limit sheet to use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolwright.functions import codes
from poolwright.operators.dedupe import keep_first
from poolwright.operators.lookups import rename_known
from poolwright.sources.snapshots import scan_latest


def select_sheet(sheets: DataFrame, scenario: str | None = None, limit_date=None,
                 loaded_col: str = "closing_date") -> DataFrame:
    """Rows of the wanted sheet.

    Scenario and date: exactly that sheet. Only one of them: the newest row of
    each rule (within the scenario, if given). Neither: the newest load.
    """
    if scenario is None and limit_date is None:
        return scan_latest(sheets, loaded_col)
    if scenario is not None:
        sheets = sheets.filter(F.col("name_list_desc") == scenario)
        if limit_date is not None:
            return sheets.filter(F.col("limit_date") == F.lit(limit_date))
    tie_breakers = [c for c in sheets.columns if c not in (*codes.LIMIT_KEY, "limit_date")]
    order = [F.desc("limit_date"), *[F.asc_nulls_last(c) for c in tie_breakers]]
    return keep_first(sheets, codes.LIMIT_KEY, order)


def read_limit_sheet(sheet: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    """Working column names and a numeric limit value; ``columns`` maps the sheet's own names to them."""
    from poolwright.functions.exprs import parse_locale_decimal

    renamed = rename_known(sheet, columns or {})
    return renamed.withColumn("limit_value", parse_locale_decimal(F.col("limit_value")))
