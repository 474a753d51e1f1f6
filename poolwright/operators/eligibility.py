"""How much of each facility may be selected: base amount, row limits, eligible amount."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poolwright.functions.exprs import least_of
from poolwright.operators.limits import DATE_LIMITS, RuleBook, matched_share, with_shares
from poolwright.operators.lookups import unfused

MONEY = "decimal(20,4)"
SHARE = "decimal(9,7)"


def base_amount(ccf: float, sellable_share: float) -> Column:
    """Exposure open to selection, net of what was sold before; may be negative."""
    drawn = F.col("funded_eur") + F.col("available_eur") * F.lit(ccf)
    sold = F.col("sold_amount") / F.lit(sellable_share)
    return (F.least(F.col("reg_ead").cast("double"), drawn.cast("double")) - sold.cast("double")).cast(MONEY)


def apply_row_limits(facilities: DataFrame, book: RuleBook) -> DataFrame:
    """One ``limit_<type>`` share per row limit, all from one lookup in the rule index.

    ``limits_applied`` lists the limits that had a rule for the row,
    ``exclusion_limits`` those whose share is 0, both in sheet order.
    """
    specs = book.row_limits()
    out = with_shares(facilities, book, specs)
    shares, matched = {}, []
    for spec in specs:
        name, match = f"limit_{spec.name}", matched_share(book, spec)
        column = F.col(spec.columns[-1])
        if spec.name in DATE_LIMITS or spec.lone:
            share = F.coalesce(match, F.lit(1.0))
        else:
            share = F.when(column.isNull() & match.isNull(), F.lit(spec.null_share)).otherwise(
                F.coalesce(match, F.lit(1.0)))
        shares[name] = share
        matched.append(F.when(match.isNotNull(), F.lit(spec.name)))
    out = out.withColumns({**shares, "limits_applied": F.concat_ws(",", *matched) if matched else F.lit("")})
    zeros = [F.when(F.col(f"limit_{s.name}") == 0, F.lit(s.name)) for s in specs]
    # ends the method of the joins, so that the amounts get one of their own
    out = out.withColumn("exclusion_limits", unfused(F.concat_ws(", ", *zeros)) if zeros else F.lit(""))
    return out.select(*facilities.columns, *shares, "limits_applied", "exclusion_limits")


def eligible_amount(limited: DataFrame, book: RuleBook) -> DataFrame:
    """Eligible amount, candidate mark and first exclusion reason.

    Row limits on the pool basis bound the amount by ``share * pool size``;
    the others scale the facility's own base amount.
    """
    on_pool = [F.col(f"limit_{s.name}") for s in book.row_limits() if s.basis == "pool"]
    on_row = [F.col(f"limit_{s.name}") for s in book.row_limits() if s.basis != "pool"]
    pool = F.lit(book.pool_size).cast(MONEY)
    return _finish(
        limited.withColumns({
            "pool_share_limit": least_of(on_pool, F.lit(1.0)),
            "row_share_limit": least_of(on_row, F.lit(1.0)),
        })
        .withColumns({
            "cap_amount": _part(pool, F.col("pool_share_limit")),
            "initial_amount": _part(F.col("base_amount"), F.col("row_share_limit")),
        })
        .withColumn("eligible_amount", F.least("initial_amount", "cap_amount"))
    )


def _part(amount: Column, share: Column) -> Column:
    """Exact product of an amount and a share of 7 decimals, rounded once."""
    return (amount * share.cast(SHARE)).cast(MONEY)


def eligible_amount_mincap(limited: DataFrame, book: RuleBook) -> DataFrame:
    """Variant: every limit is an absolute cap and the least of them bounds the base amount."""
    pool = F.lit(book.pool_size).cast(MONEY)
    shares = [F.col(f"limit_{s.name}") for s in book.row_limits()]
    caps = [_part(pool if s.basis == "pool" else F.col("base_amount"), F.col(f"limit_{s.name}")) for s in book.row_limits()]
    return _finish(
        limited.withColumns({
            "row_share_limit": least_of(shares, F.lit(1.0)),
            "cap_amount": least_of(caps, pool),
        })
        .withColumn("eligible_amount", F.least("base_amount", "cap_amount"))
    )


def _finish(df: DataFrame) -> DataFrame:
    excluded = (F.col("row_share_limit") == 0) | (F.col("cap_amount") <= 0)
    return df.withColumns({
        "excluded": F.when(excluded, 1).otherwise(0),
        "is_candidate": F.when(F.col("eligible_amount") > 0, 1).otherwise(0),
    }).withColumns({
        "exclusion_reason": F.when(F.col("excluded") == 1, "row limit 0")
        .when(F.col("base_amount") <= 0, "base amount 0").otherwise("NA"),
        "exclusion_detail": F.col("exclusion_limits"),
    })
