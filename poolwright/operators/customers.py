"""Customers, groups and parent attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolwright.functions import codes
from poolwright.functions.exprs import customer_parts, lookup
from poolwright.operators.dedupe import keep_best_with_ties, keep_first

GROUP_COLUMNS = ["group_id", "group_country", "group_name", "group_full_name", "tier_id", "segment_id"]


def best_relations(members: DataFrame) -> DataFrame:
    """Memberships of the preferred relation type of each customer; ties stay."""
    eligible = members.distinct().filter(
        F.col("hierarchy_level").isin(codes.GROUP_LEVELS)
        & F.col("relation_type").isin(codes.GROUP_RELATIONS)
    )
    return keep_best_with_ties(eligible, ["customer_id"], [F.asc("relation_type")])


def customer_master(customers: DataFrame, links: DataFrame, members: DataFrame, groups: DataFrame,
                    tiers: dict[str, str] | None = None) -> DataFrame:
    """Local customers with their global id, group and decoded group attributes."""
    linked = customers.distinct().join(
        links.select("golden_customer_id", "customer_id").distinct(), "golden_customer_id", "inner")
    grouped = linked.join(
        best_relations(members).drop("hierarchy_level", "relation_type"), "customer_id", "inner")
    master = grouped.join(groups.select(*GROUP_COLUMNS).distinct(), "group_id", "left")
    tier_text = lookup(tiers, F.col("tier_id")) if tiers else F.lit(None).cast("string")
    return master.withColumns({
        "group_name": F.trim("group_name"),
        "group_full_name": F.trim("group_full_name"),
        "tier_desc": tier_text,
        "segment_desc": lookup(codes.SEGMENTS, F.col("segment_id")),
        "local_customer_id": customer_parts(F.col("customer_id"))["local_customer_id"],
    })


def best_external_rating(ratings: DataFrame) -> DataFrame:
    """One external rating per global customer: the last in text order."""
    return keep_first(
        ratings.select("golden_customer_id", "external_rating"),
        ["golden_customer_id"], [F.desc_nulls_last("external_rating")])


def group_parent_rating(master: DataFrame, links: DataFrame, ratings: DataFrame) -> DataFrame:
    """Group -> its header customer -> that customer's external rating."""
    parents = (
        master.filter(F.col("participant_header_type") == "S").select("group_id", "customer_id").distinct()
        .join(links.select("golden_customer_id", "customer_id").distinct(), "customer_id", "left")
        .select("group_id", "golden_customer_id").distinct()
    )
    return parents.join(best_external_rating(ratings), "golden_customer_id", "inner").select(
        "group_id", F.col("external_rating").alias("group_rating"))


def accredited_attributes(accredited: DataFrame, tie_breaker: str) -> DataFrame:
    """Newest project-finance attributes per participant, keyed by customer id."""
    newest = keep_first(
        accredited, ["participant_id", "ledger_entity"],
        [F.desc_nulls_last("rating_date"), F.desc_nulls_last("register_date"), F.desc(tie_breaker)])
    customer = F.concat(lookup(codes.LEDGER_ENTITY_CUSTOMER_PREFIX, F.col("ledger_entity")), F.col("participant_id"))
    return newest.select(
        customer.alias("customer_id"), "construction_type", "project_rating", "capital_adjustment", "project_score", "project_lgd",
        F.to_date("rating_date").alias("project_rating_date"))


def customer_attributes(customers: DataFrame, links: DataFrame) -> DataFrame:
    """Country and activity of each local customer."""
    return (
        customers.select("golden_customer_id", "customer_country", "activity_id").distinct()
        .join(links.select("golden_customer_id", "customer_id").distinct(), "golden_customer_id", "left")
        .drop("golden_customer_id")
    )
