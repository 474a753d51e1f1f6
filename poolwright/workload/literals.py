"""Small literal tables of the stand-in data, shared by the Spark and the SQL side."""

from __future__ import annotations

from poolwright.functions import codes

# ledger entities of the stand-in data: the two that the fixed prefixes know
HOME, ABROAD = codes.LEDGER_ENTITY_CUSTOMER_PREFIX

VALUE_DATE = "1998-06-30"
LIMIT_DATE = "1999-06-30"
SCENARIO = "Autumn pool"

# currency, multiplier to EUR; JPY has no rate on purpose
FX = [("EUR", "1.000000"), ("USD", "0.914244"), ("GBP", "1.170000"), ("MXN", "0.050000")]
REGION_CURRENCY = {0: "EUR", 1: "USD", 2: "GBP", 3: "MXN", 4: "JPY"}
STATUS_PRODUCT = {"O": "Term Loan", "F": "Revolving", "P": "Guarantee"}
RELATION_TYPES = {0: "A", 1: "B", 2: "R", 3: "Z"}
PRIORITY_RATING = {"1-URGENT": "AA", "2-HIGH": "BBB+", "3-MEDIUM": "BB", "4-NOT SPECIFIED": "A-", "5-LOW": "B+"}
TIERS = {"T1": "Gold", "T2": "Silver"}

# PD bands in percent; 10 % falls outside the last one
BANDS = [(float(i), float(i + 1), f"S{i}", f"L{i}") for i in range(10)]

# (return flag + line status) -> movement class, movement type
MOVEMENTS = {
    "RO": ("Drawdown", "Term Loan Drawdown"),
    "AO": ("Repayment of Principal", "Term Loan Repayment"),
    "RF": ("Authorized Amount Increase", "Authorized Amount Increase"),
    "NO": ("Authorized Amount Reduction", "Early Authorized Amount Reduction"),
    "NF": ("Drawdown", "RCF Refund#"),
    "AF": ("Fees", "Arrangement Fee"),
}

HISTORY_TYPES = {
    0: "portfolio_size", 1: "portfolio_type", 2: "sts", 3: "group", 4: "risk_retention",
    5: "non_ig", 6: "sts_group", 7: "constant_type", 8: "divisa", 9: "rating_sp",
}
ROW_TYPES = ("risk_retention", "rating_sp", "non_ig")
CONSTANT_NAMES = {0: "Coupon", 1: "B", 2: "C", 3: "D"}

LIMIT_RELATION_SCHEMA = (
    "limit_type string, corporate_loan_column string, project_finance_column string, "
    "header_flag int, imp_limit string, null_values int"
)
LIMIT_RELATION = [
    ("portfolio_size", "reg_ead", "reg_ead", 1, "limit_scope", 0),
    ("portfolio_date", "closing_date", "closing_date", 1, "limit_scope", 0),
    ("portfolio_type", "com_product", "com_product", 1, "limit_scope", 0),
    ("ccf", "reg_ead", "reg_ead", 1, "limit_scope", 0),
    ("risk_retention", "reg_ead", "reg_ead", 0, "limit_scope", 0),
    ("rating_rga_esl", "rating_letter", "rating_letter", 0, "portfolio", 0),
    ("rating_sp", "group_rating", "rating_letter", 0, "limit_scope", 1),
    ("bei", "facility_id", "facility_id", 0, "limit_scope", 0),
    ("excluded_facilities", "facility_id", "facility_id", 0, "limit_scope", 0),
    ("geo_sector", "sector/country", "sector/country", 0, "limit_scope", 0),
    ("maturity_min", "expiry_date", "expiry_date", 0, "limit_scope", 0),
    ("maturity_max", "expiry_date", "expiry_date", 0, "limit_scope", 0),
    ("group", "group_id", "group_id", 0, "limit_scope", 0),
    ("sts_group", "group_id", "group_id", 0, "limit_scope", 0),
    ("customer_country", "country", "country", 0, "limit_scope", 0),
    ("customer_sector", "sector", "sector", 0, "limit_scope", 0),
    ("subsector", "subsector", "subsector", 0, "limit_scope", 0),
    ("non_ig", "non_ig_flag", "non_ig_flag", 0, "limit_scope", 0),
    ("divisa", "currency", "currency", 0, "limit_scope", 0),
]

SHEET_COLUMNS = [
    ("name_list_desc", "string"), ("limit_date", "string"), ("limit_type", "string"),
    ("concept1_desc", "string"), ("concept1_value", "string"), ("concept2_desc", "string"),
    ("concept2_value", "string"), ("limit_value", "double"), ("corporate_loan_flag", "string"),
    ("project_finance_flag", "string"), ("limit_scope", "string"), ("active_flag", "int"),
    ("visual_order", "int"), ("complex_limit", "int"),
]
SHEET_SCHEMA = ", ".join(f"{n} {t}" for n, t in SHEET_COLUMNS)


def _rule(kind, concept1, value1, share, scope, place, concept2=None, value2=None, complex_limit=0):
    return (SCENARIO, LIMIT_DATE, kind, concept1, value1, concept2, value2, share, "1", "1", scope, 1, place, complex_limit)


ROW, POOL = "individual", "portfolio"
SHEET = [
    (SCENARIO, LIMIT_DATE, "portfolio_type", "product_desc", "total", None, None, 1.0, "1", "0", POOL, 1, 1, 0),
    _rule("ccf", "ccf", "total", 0.5, POOL, 2),
    _rule("risk_retention", "risk_percent", "total", 0.2, ROW, 3),
    _rule("rating_rga_esl", "rating", "AAA", 0.00004, ROW, 4),
    _rule("rating_rga_esl", "rating", "BB-", 0.00002, ROW, 4),
    _rule("rating_rga_esl", "rating", "D", 0.0, ROW, 4),
    _rule("rating_sp", "rating", "CCC", 0.0, ROW, 5),
    _rule("rating_sp", "rating", "B+", 0.5, ROW, 5),
    _rule("bei", "bei_flag", "1", 0.0, ROW, 6),
    _rule("excluded_facilities", "facility_id", "1", 0.0, ROW, 7),
    _rule("excluded_facilities", "facility_id", "77", 0.0, ROW, 7),
    _rule("excluded_facilities", "facility_id", "350", 0.0, ROW, 7),
    *[_rule("excluded_facilities", "facility_id", str(13 * i), 0.0 if i % 2 else 0.5, ROW, 7) for i in range(5, 95)],
    _rule("geo_sector", "sector", "PROMO", 0.0, ROW, 8, "country", "NATION_7", 1),
    _rule("geo_sector", "sector", "LARGE", 0.25, ROW, 8, "country", "total", 1),
    _rule("geo_sector", "sector", "total", 0.5, ROW, 8, "country", "NATION_11", 1),
    _rule("maturity_max", "num_days", "2500", 0.0, ROW, 9),
    _rule("maturity_max", "num_days", "2000", 0.5, ROW, 9),
    _rule("maturity_max", "num_days", "2600", 0.25, ROW, 9),
    _rule("group", "group_id", "G07", 0.004, POOL, 20),
    _rule("group", "group_id", "total", 0.06, POOL, 20),
    _rule("sts_group", "sts_flag", "1", 0.01, POOL, 21, "group_id", "G11", 1),
    _rule("customer_country", "country", "NATION_3", 0.0, POOL, 22),
    _rule("customer_country", "country", "NATION_5", 0.01, POOL, 22),
    _rule("customer_country", "country", "total", 0.2, POOL, 22),
    _rule("customer_sector", "sector", "SMALL", 0.05, POOL, 23),
    _rule("subsector", "subsector", "Brand#2", 0.01, POOL, 24),
    _rule("non_ig", "non_ig_flag", "1", 0.4, POOL, 25),
    _rule("divisa", "currency", "USD", 0.1, POOL, 26),
    _rule("maturity_min", "num_days", "200", 0.05, POOL, 27),
    _rule("maturity_min", "num_days", "1095", 0.6, POOL, 27),
]
POOL_SIZE_RULE = _rule("portfolio_size", "amount_size", "total", None, POOL, 0)
