"""Column contracts of the input tables, as Spark DDL.

Money is DECIMAL(20,4), rates DECIMAL(9,6), dates DATE, flags INT or BOOLEAN.
Extra columns are allowed and pass through where an operator keeps its input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_KEY = "facility_id STRING, tranche_id STRING, branch_id STRING"

CONTRACTS = {
    "operations": f"{_KEY}, entity_id STRING, currency STRING, customer_id STRING, signing_date DATE, expiry_date DATE, "
                  "project_country_id STRING, financial_product STRING, com_product STRING, purpose STRING, insured_type STRING, "
                  "project_id STRING, project_sector_desc STRING, security_type STRING, syndication_type STRING",
    "balances": f"{_KEY}, entity_id STRING, currency STRING, funded_ccy DECIMAL(20,4), available_ccy DECIMAL(20,4), "
                "funded_eur DECIMAL(20,4), available_eur DECIMAL(20,4), commitment DECIMAL(20,4)",
    "branches": "branch_id STRING, entity_id STRING, entity_product STRING",
    "movements": f"{_KEY}, entity_id STRING, currency STRING, signing_date DATE, expiry_date DATE, movement_class STRING, "
                 "movement_type STRING, payment_state STRING, start_date DATE, end_date DATE, "
                 "movement_amount DECIMAL(20,4), base_amount DECIMAL(20,4)",
    "fx": "currency STRING, fx DECIMAL(12,6)",
    "relations": f"contract_id STRING, {_KEY}, relation_level STRING",
    "econ_capital": "contract_id STRING, entity_id STRING, econ_ead DECIMAL(20,4), econ_loss DECIMAL(20,4), "
                    "econ_capital DECIMAL(20,4), econ_pd DECIMAL(9,6)",
    "reg_capital": "contract_id STRING, entity_id STRING, reg_ead DECIMAL(20,4), reg_capital DECIMAL(20,4), "
                   "reg_loss DECIMAL(20,4), reg_pd DECIMAL(9,6), reg_lgd DECIMAL(9,6), reg_rw DECIMAL(9,6)",
    "bands": "band_from DOUBLE, band_to DOUBLE, short_letter STRING, long_letter STRING",
    "provisions": "branch_code STRING, contract_tail STRING, entity_id STRING, provision_amount DECIMAL(20,4), "
                  "provision_stage INT, local_customer_id STRING, watch_list STRING, currency STRING",
    "customers": "golden_customer_id STRING, customer_name STRING, activity_id STRING, customer_country STRING",
    "links": "golden_customer_id STRING, customer_id STRING",
    "members": "customer_id STRING, hierarchy_level STRING, relation_type STRING, group_id STRING, participant_header_type STRING",
    "groups": "group_id STRING, group_country STRING, group_name STRING, group_full_name STRING, tier_id STRING, segment_id STRING",
    "taxonomy_relation": "from_catalogue STRING, from_value STRING, to_catalogue STRING, to_value STRING",
    "taxonomy_values": "catalogue STRING, value STRING, description STRING",
    "countries": "country_id STRING, country_name STRING",
    "entities": "entity_id STRING, entity_name STRING",
    "external_ratings": "golden_customer_id STRING, external_rating STRING",
    "customer_ratings": "customer_id STRING, internal_rating STRING, short_rating STRING, rating_tool_date DATE",
    "prior_deals": f"{_KEY}, sold_percent DECIMAL(9,6), deal_id BIGINT, deal_date DATE",
    "guarantee_assignments": "contract_id STRING, guarantee_id STRING, currency STRING, guaranteed_amount DECIMAL(20,4), "
                             "begin_date DATE, end_date DATE, cutoff_date DATE",
    "guarantee_board": "guarantee_id STRING, customer_id STRING",
    "marks": "contract_id STRING, mark_id STRING",
    "limit_sheet": "name_list_desc STRING, limit_date STRING, limit_type STRING, concept1_desc STRING, concept1_value STRING, "
                   "concept2_desc STRING, concept2_value STRING, limit_value DOUBLE, corporate_loan_flag STRING, "
                   "project_finance_flag STRING, limit_scope STRING, active_flag INT, visual_order INT, complex_limit INT",
    "limit_relation": "limit_type STRING, corporate_loan_column STRING, project_finance_column STRING, header_flag INT, "
                      "imp_limit STRING, null_values INT",
}


def schema_of(name: str) -> T.StructType:
    return T.StructType.fromDDL(CONTRACTS[name])


def conform(df: DataFrame, name: str) -> DataFrame:
    """Cast ``df`` to the contract (missing nullable columns become NULL, extra ones are dropped)."""
    return df.to(schema_of(name))
