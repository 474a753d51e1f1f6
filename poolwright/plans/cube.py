"""The wide table: one row per facility, tranche and branch with every attribute.

Sources are first reduced to the key they are joined on (facility, customer,
group), so each join of the chain adds columns without adding rows. Where a
customer has several equally ranked groups, or a group several rated header
customers, the first in text order counts. Dimensions stay un-hinted: Spark
broadcasts those whose size it knows to be small.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolwright import GRAIN
from poolwright.contracts import CONTRACTS, conform
from poolwright.functions import codes
from poolwright.functions import exprs as E
from poolwright.operators import customers as C
from poolwright.operators import guarantees as G
from poolwright.operators import ledger, lookups, risk
from poolwright.operators.dedupe import keep_first
from poolwright.session import discard, materialize
from poolwright.sinks.writers import stamp


@dataclass
class CubeSources:
    """Input tables; their columns are listed in ``poolwright.contracts``."""

    operations: DataFrame
    balances: DataFrame
    branches: DataFrame
    movements: DataFrame
    fx: DataFrame
    relations: DataFrame
    econ_capital: DataFrame
    reg_capital: DataFrame
    bands: DataFrame
    provisions: DataFrame
    customers: DataFrame
    links: DataFrame
    members: DataFrame
    groups: DataFrame
    taxonomy_relation: DataFrame
    taxonomy_values: DataFrame
    countries: DataFrame
    external_ratings: DataFrame
    accredited: DataFrame
    accredited_tie_breaker: str
    customer_ratings: DataFrame
    prior_deals: DataFrame
    guarantee_assignments: DataFrame
    guarantee_board: DataFrame
    agency_customers: DataFrame
    marks: DataFrame
    entities: DataFrame
    header_tranche: str = "0"

    def conformed(self) -> CubeSources:
        """The same sources cast to their contracts; a missing required column fails here, by name."""
        given = {f.name: getattr(self, f.name) for f in fields(self)}
        return CubeSources(**{name: conform(v, name) if name in CONTRACTS else v for name, v in given.items()})


def unified_risk(econ: DataFrame, reg: DataFrame, provisions: DataFrame) -> DataFrame:
    """Economic and regulatory capital and provisions of each related facility."""
    return econ.join(reg, GRAIN, "left").join(provisions, GRAIN, "left")


def operations_with_balances(s: CubeSources) -> DataFrame:
    """Operations in the branch perimeter, with their balances."""
    perimeter = keep_first(s.branches, ["branch_id", "entity_id"], [F.desc("entity_product")]).select("branch_id", "entity_id")
    return (
        s.operations.join(s.balances, [*GRAIN, "entity_id", "currency"], "left")
        .join(perimeter, ["branch_id", "entity_id"], "inner")
    )


def _whole(df: DataFrame, label: str) -> DataFrame:
    return df


def base_table(s: CubeSources, relations: DataFrame, value_date, cut: Callable[[DataFrame, str], DataFrame] = _whole) -> DataFrame:
    """Operations with a commitment, their risk measures and average term; ``cut`` may write what comes by facility."""
    operations = operations_with_balances(s).filter(F.col("commitment") > 0)
    # only movements of these operations, matched on entity and branch too, count
    moves = ledger.signed_movements(ledger.balance_movements(s.movements), s.fx)
    profile = ledger.average_maturity(moves, operations, value_date)
    unified = unified_risk(
        cut(risk.econ_capital_by_facility(s.econ_capital, relations, s.fx, s.bands), "econ-capital"),
        cut(risk.reg_capital_by_facility(s.reg_capital, relations, s.fx, s.bands), "reg-capital"),
        cut(risk.provision_by_facility(s.provisions, relations, s.fx), "provisions"))
    letters = ["econ_long_letter", "econ_short_letter", "reg_long_letter", "reg_short_letter"]
    numbers = [c for c in unified.columns if c not in (*GRAIN, *letters)]
    base = operations.join(unified, GRAIN, "left").fillna(
        {**{c: codes.UNRATED for c in letters}, **{c: 0 for c in numbers}})
    base = base.join(profile.select(*GRAIN, "avg_maturity"), GRAIN, "left")
    return base.withColumn("avg_term", E.average_term(F.col("avg_maturity"), F.col("signing_date")))


def wide_cube(s: CubeSources, value_date, run_dates: dict[str, str], staged: bool = False) -> DataFrame:
    """``staged`` joins the sources with the relations one after the other and writes what each leaves, a row per facility.

    Each of these joins shuffles all relations. In one plan the disk holds the shuffles of all of them at once, staged
    those of one, which go when its facilities are written.
    """
    s = s.conformed()
    cut = materialize if staged else _whole
    # the relation table feeds six aggregations: read it back instead of rebuilding it
    relations = materialize(s.relations, "relations")
    df = base_table(s, relations, value_date, cut)
    df = df.withColumn("reg_rating_ordinal", E.rating_ordinal(F.col("reg_long_letter")))
    df = df.join(risk.customer_watchlist(s.provisions), "customer_id", "left").fillna({"watch_list": "0"})

    header = s.operations.filter(F.col("financial_product") == "Multitranche")
    first_tranche = s.operations.filter(F.col("tranche_id") == s.header_tranche)
    df = lookups.cascade(df, "facility_id", "insured_type", [header, first_tranche])

    # customers and groups
    master = materialize(C.customer_master(s.customers, s.links, s.members, s.groups), "customers")
    group = keep_first(
        master.select("customer_id", "group_id", F.col("group_country").alias("group_country_id")), ["customer_id"],
        [F.asc_nulls_last("group_id"), F.asc_nulls_last("group_country_id")])
    df = df.join(group, "customer_id", "left")
    attributes = keep_first(C.customer_attributes(s.customers, s.links), ["customer_id"],
                            [F.asc_nulls_last("customer_country"), F.asc_nulls_last("activity_id")])
    df = df.join(attributes.withColumnRenamed("customer_country", "customer_country_id"), "customer_id", "left")
    df = lookups.taxonomy_hop(df, s.taxonomy_relation, s.taxonomy_values, "activity_id")
    df = lookups.role_lookup(df, s.countries, "country_id", "country_name", {
        "group_country_id": "group_country", "customer_country_id": "customer_country",
        "project_country_id": "project_country"})
    parents = C.group_parent_rating(master, s.links, s.external_ratings)
    df = df.join(keep_first(parents, ["group_id"], [F.asc_nulls_last("group_rating")]), "group_id", "left")
    df = df.join(C.accredited_attributes(s.accredited, s.accredited_tie_breaker), "customer_id", "left")
    df = df.join(s.customer_ratings, "customer_id", "left")
    df = df.withColumn("internal_ordinal", E.rating_ordinal(F.col("internal_rating")))
    df = df.withColumn("investment_grade", E.investment_grade(F.col("internal_ordinal")))

    # facility marks and amounts
    settled = s.movements.filter(F.col("payment_state").isin(codes.SETTLED_STATES)
                                 & F.col("movement_class").isin(codes.PAYMENT_CLASSES))
    df = lookups.existence_flag(df, settled, GRAIN, "sts_payment_condition")
    df = df.join(risk.sold_share(s.prior_deals), GRAIN, "left").fillna({"sold": "N"})
    # whole cents, by exact decimals
    df = df.withColumn("sold_amount", F.coalesce(
        (F.col("sold_percent").cast("decimal(12,6)") * F.col("reg_ead").cast("decimal(20,4)") * F.lit(Decimal("0.01"))).cast("decimal(20,2)"),
        F.lit(0).cast("decimal(20,2)")))
    guaranteed = cut(G.guarantee_amounts(s.guarantee_assignments, s.guarantee_board, s.agency_customers, relations, s.fx), "guarantees")
    marked = cut(G.sustainability_flag(s.marks, relations), "marked")
    if staged:
        discard(relations)
    df = df.join(guaranteed, GRAIN, "left").join(marked, GRAIN, "left")
    df = df.join(s.entities, "entity_id", "left")

    df = df.withColumns({
        "sts_rw_condition": E.within_full_weight(F.col("reg_rw")),
        "econ_rating": F.col("econ_long_letter"), "reg_rating": F.col("reg_long_letter"),
        "nominal_ccy": F.col("funded_ccy"), "nominal_eur": F.col("funded_eur"),
    })
    df = df.withColumns(E.risk_ratios())
    return stamp(df, internal_rating_model="NA", guaranteed_ccy=0, guaranteed_eur=0, **run_dates)
