"""Typed output and checks of a selected pool."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolwright import GRAIN

POOL_SHARES = ["pool_share", "cumulative_share"]


def typed_portfolio(portfolio: DataFrame, portfolio_type: str) -> DataFrame:
    """Rounded amounts, dates as dates, the portfolio type and a file-tranche key."""
    out = {}
    for name, kind in portfolio.dtypes:
        if name in POOL_SHARES:
            out[name] = F.round(name, 7)
        elif kind == "double" or kind.startswith("decimal"):
            out[name] = F.round(F.col(name).cast("decimal(38,11)") if kind.startswith("decimal") else F.col(name), 4)
    typed = portfolio.withColumns(out)
    dates = [c for c in ("signing_date", "snapshot_date") if dict(typed.dtypes).get(c) == "string"]
    typed = typed.withColumns({c: F.coalesce(F.try_to_timestamp(c, F.lit("yyyy-MM-dd")), F.try_to_timestamp(c, F.lit("yyyyMMdd"))).cast("date")
                               for c in dates})
    return typed.withColumns({
        "portfolio_type": F.lit(portfolio_type),
        "file_tranche": F.concat_ws("_", "facility_id", "tranche_id"),
    })


def portfolio_totals(portfolio: DataFrame, pool_size) -> DataFrame:
    """Base, eligible and allocated totals against the target."""
    pool = F.lit(float(pool_size))
    return portfolio.agg(
        F.count(F.lit(1)).alias("facilities"),
        F.sum("is_candidate").alias("candidates"),
        F.sum("is_selected").alias("selected"),
        F.sum("base_amount").alias("base_amount"),
        F.sum("eligible_amount").alias("eligible_amount"),
        F.sum("allocated_amount").alias("allocated_amount"),
    ).withColumns({
        "pool_size": pool,
        "allocated_share": F.try_divide(F.col("allocated_amount").cast("double"), pool),
        "remaining": pool - F.col("allocated_amount").cast("double"),
    })


def exclusion_summary(portfolio: DataFrame) -> DataFrame:
    """How many facilities were taken or left out, by reason and detail."""
    return portfolio.groupBy("is_selected", "exclusion_reason", "exclusion_detail").agg(F.count(F.lit(1)).alias("n"))


def allocation_checks(portfolio: DataFrame, ledger: DataFrame, pool_size) -> DataFrame:
    """Number of violations of every rule a correct pool satisfies."""
    pool = F.lit(float(pool_size))
    taken, eligible = F.col("allocated_amount").cast("double"), F.col("eligible_amount").cast("double")

    def count(condition):
        return F.sum(F.when(condition, 1).otherwise(0))

    rows = portfolio.agg(
        count((F.col("is_selected") == 1) & ((F.col("row_share_limit") == 0) | (F.col("pool_limit") == 0))).alias("selected_on_zero_limit"),
        count(taken > eligible + 1e-6).alias("above_eligible"),
        count(taken > F.col("pool_limit") * pool + 1e-3).alias("above_pool_limit"),
        count((F.col("pool_share") > 0) & (taken == 0)).alias("share_without_amount"),
        count((F.col("is_selected") == 1) & (F.col("is_candidate") == 0)).alias("selected_not_candidate"),
        count((F.col("facility_share") == 0) & (F.col("is_selected") == 1) & (taken > F.col("base_amount").cast("double") * 1e-6)).alias("zero_share_with_amount"),
        F.when(F.sum(taken) > pool + 1e-3, 1).otherwise(0).alias("pool_overshoot"),
    )
    caps = ledger.agg(
        count(F.col("used_share") > F.col("allowed_share") + 1e-9).alias("cap_exceeded"))
    checks = rows.unpivot([], rows.columns, "check_name", "violations")
    return checks.unionByName(caps.unpivot([], caps.columns, "check_name", "violations"))
