"""Capital, provisions and prior prior_deals by facility."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolwright import GRAIN
from poolwright.functions import codes
from poolwright.functions.exprs import (
    clean_sentinels, contract_parts, entity_currency, lookup, ratio,
)
from poolwright.operators.lookups import convert_currency, digested, range_band


def _weighted(value: str, weight: str):
    """Weighted average; NULL when the weights add up to 0."""
    return ratio(F.sum(F.col(value) * F.col(weight)), F.sum(weight))


def _in_eur(capital: DataFrame, fx: DataFrame, amounts: list[str], percents: list[str]) -> DataFrame:
    clean = clean_sentinels(capital, amounts, percents)
    with_currency = clean.withColumn("currency", entity_currency(F.col("entity_id")))
    return convert_currency(with_currency, fx, {a: a for a in amounts}).select(
        "contract_id", *amounts, *percents)


def _related(capital: DataFrame, relations: DataFrame) -> DataFrame:
    """Capital of every related facility; relations without any stay."""
    related = relations.select("contract_id", *GRAIN)
    return digested(capital, "contract_id").join(digested(related, "contract_id"), ["_digest", "contract_id"], "right")


def _letters(df: DataFrame, bands: DataFrame, pd_col: str, prefix: str) -> DataFrame:
    named = bands.select("band_from", "band_to", F.col("short_letter").alias(f"{prefix}_short_letter"),
                         F.col("long_letter").alias(f"{prefix}_long_letter"))
    return range_band(df, named, 100 * F.col(pd_col), [f"{prefix}_short_letter", f"{prefix}_long_letter"])


def econ_capital_by_facility(capital: DataFrame, relations: DataFrame, fx: DataFrame,
                             bands: DataFrame) -> DataFrame:
    """Economic capital of every related facility.

    Amounts are maxima (a facility repeats on each of its contracts); PD is
    exposure weighted. Every relation row survives the join, so a facility
    without capital comes out with NULLs.
    """
    amounts = ["econ_ead", "econ_loss", "econ_capital"]
    in_eur = _in_eur(capital, fx, amounts, ["econ_pd"])
    by_facility = _related(in_eur, relations).groupBy(*GRAIN).agg(
        *[F.max(a).alias(a) for a in amounts],
        _weighted("econ_pd", "econ_ead").alias("econ_pd"),
    )
    return _letters(by_facility, bands, "econ_pd", "econ")


def reg_capital_by_facility(capital: DataFrame, relations: DataFrame, fx: DataFrame,
                            bands: DataFrame) -> DataFrame:
    """Regulatory counterpart, with weighted risk weight and the largest LGD."""
    amounts = ["reg_ead", "reg_capital", "reg_loss"]
    in_eur = _in_eur(capital, fx, amounts, ["reg_pd", "reg_lgd", "reg_rw"])
    by_facility = _related(in_eur, relations).groupBy(*GRAIN).agg(
        *[F.max(a).alias(a) for a in amounts],
        _weighted("reg_pd", "reg_ead").alias("reg_pd"),
        _weighted("reg_rw", "reg_ead").alias("reg_rw"),
        F.max("reg_lgd").alias("reg_lgd"),
    )
    return _letters(by_facility, bands, "reg_pd", "reg")


def provision_by_facility(provisions: DataFrame, relations: DataFrame, fx: DataFrame) -> DataFrame:
    """Provision total and worst stage, joined through the parts of the contract id."""
    clean = clean_sentinels(provisions, ["provision_amount"])
    in_eur = convert_currency(clean, fx, {"provision_amount": "provision_amount"}).select(
        F.substring("branch_code", 3, 4).alias("branch_id"),
        "contract_tail", "entity_id", "provision_stage", "provision_amount",
    )
    keys = ["entity_id", "contract_tail", "branch_id"]
    parts = relations.select(*GRAIN, "contract_id").withColumns(contract_parts(F.col("contract_id")))
    return digested(parts, *keys).join(digested(in_eur, *keys), ["_digest", *keys], "inner").groupBy(*GRAIN).agg(
        F.sum("provision_amount").alias("provision_amount"),
        F.max("provision_stage").alias("provision_stage"),
    )


def customer_watchlist(provisions: DataFrame) -> DataFrame:
    """One watch-list mark per customer: the highest one, so the pick is repeatable."""
    customer = F.concat(lookup(codes.ENTITY_CUSTOMER_PREFIX, F.col("entity_id")), F.col("local_customer_id"))
    return provisions.groupBy(customer.alias("customer_id")).agg(F.max("watch_list").alias("watch_list"))


def sold_share(prior_deals: DataFrame) -> DataFrame:
    """Share already sold, whether any deal id exists, and the newest date."""
    return prior_deals.groupBy(*GRAIN).agg(
        F.sum("sold_percent").alias("sold_percent"),
        F.when(F.count("deal_id") > 0, "Y").otherwise("N").alias("sold"),
        F.max("deal_date").alias("deal_date"),
    )
