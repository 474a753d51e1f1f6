"""Guaranteed amounts and sustainability marks by facility."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolwright import GRAIN
from poolwright.functions import codes
from poolwright.operators.lookups import convert_currency, digested, existence_flag


def guarantee_amounts(assignments: DataFrame, board: DataFrame, agency_customers: DataFrame,
                      relations: DataFrame, fx: DataFrame) -> DataFrame:
    """Valid guaranteed EUR per facility, split by whether a guarantor is the agency.

    A guarantee may have several guarantors: its flag is the largest of theirs,
    so no amount is counted twice. The two columns of the pivot are known, hence
    conditional sums: one aggregation instead of the two a pivot plans.
    """
    valid = convert_currency(assignments, fx, {"guaranteed_amount": "guaranteed_amount"}).filter(
        (F.col("begin_date") <= F.col("cutoff_date")) & (F.col("cutoff_date") <= F.col("end_date")))
    flagged = existence_flag(board, agency_customers, ["customer_id"], "by_agency")
    per_guarantee = flagged.groupBy("guarantee_id").agg(F.max("by_agency").alias("by_agency"))
    amount = F.col("guaranteed_amount")
    by_agency = F.coalesce(F.col("by_agency"), F.lit(False))
    per_contract = digested(valid.join(per_guarantee, "guarantee_id", "left"), "contract_id").groupBy("_digest", "contract_id").agg(
        F.sum(F.when(by_agency, amount)).alias("agency_guaranteed"),
        F.sum(F.when(~by_agency, amount)).alias("other_guaranteed"),
    )
    # every relation row stays; the sums do not depend on which side is named first
    related = digested(relations.select("contract_id", *GRAIN), "contract_id")
    return per_contract.join(related, ["_digest", "contract_id"], "right").groupBy(*GRAIN).agg(
        F.sum("agency_guaranteed").alias("agency_guaranteed"),
        F.sum("other_guaranteed").alias("other_guaranteed"),
    )


def sustainability_flag(marks: DataFrame, relations: DataFrame) -> DataFrame:
    """1 when any facility-level contract carries the sustainability mark."""
    marked = marks.filter(F.col("mark_id") == codes.SUSTAINABILITY_MARK)
    facility_level = relations.filter(F.col("relation_level") == "FACILITY")
    return existence_flag(digested(facility_level, "contract_id"), digested(marked, "contract_id"), ["_digest", "contract_id"], "esg_linked", 1, 0).groupBy(*GRAIN).agg(
        F.max("esg_linked").alias("esg_linked"))
