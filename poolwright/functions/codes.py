"""Fixed code tables of the domain."""

from __future__ import annotations

# --- fixed values ---------------------------------------------------------
# Master rating scale, best to worst; the position (from 1) is the ordinal.
RATING_SCALE = [
    "AAA", "AA+", "AA", "AA-", "A+", "A", "A-", "BBB+", "BBB+1", "BBB+2",
    "BBB", "BBB1", "BBB2", "BBB-", "BBB-1", "BBB-2", "BB+", "BB+1", "BB+2",
    "BB", "BB1", "BB2", "BB-", "BB-1", "BB-2", "B+", "B+1", "B+2", "B+3",
    "B", "B1", "B2", "B3", "B-", "B-1", "B-2", "B-3", "CCC+", "CCC", "CCC-",
    "CC+", "CC", "CC-", "C+", "C", "C-", "D", "D1", "D2", "No Rating",
]
# Second spelling of the last position.
UNRATED_ALIAS = "XXXX"

SEGMENTS = {
    "00001": "Institutional Client",
    "00002": "Public Sector",
    "00003": "Sme & Retail",
    "00004": "Others",
    "00005": "Corporate",
    "00006": "Financial Sponsors",
}

# Movement classes that enter the balance history.
BALANCE_CLASSES = [
    "Authorized Amount Increase",
    "Authorized Amount Reduction",
    "Drawdown",
    "Repayment of Principal",
]

# Movement types that reduce the authorised total (and count as run-off).
TOTAL_REDUCTIONS = [
    "Authorized Amount Reduction for Irregular Payment",
    "Early Authorized Amount Reduction",
    "Non-Revolving Guarantee Reduction",
    "RCF Mandatory Early Repayment",
    "RCF Total Early Repayment",
    "Revolving Guarantee Drawdown Cancellation",
    "Revolving Guarantee Drawdown Early Cancellation",
    "Term Loan Mandatory Early Repayment",
    "Term Loan Repayment",
    "Term Loan Total Early Repayment",
    "Term Loan Voluntary Early Repayment",
    "Voluntary RCF Early Repayment",
]
TOTAL_INCREASE = "Authorized Amount Increase"

# Movement types that raise the drawn amount.
DRAWN_INCREASES = [
    "Drawdown Increase",
    "Non-Revolving Guarantee Drawdown",
    "RCF Drawdown",
    "Revolving Guarantee Drawdown",
    "Revolving Guarantee Increase",
    "Term Loan Drawdown",
]

# Movement types that lower the drawn amount.
DRAWN_REDUCTIONS = [
    "Non-Revolving Guarantee Reduction",
    "Non-Revolving Guarantee Drawdown Cancellation",
    "Non-Revolving Guarantee Drawdown Early Cancellation",
    "RCF Mandatory Early Repayment",
    "RCF Refund",
    "RCF Refund#",
    "RCF Total Early Repayment",
    "Revolving Guarantee Drawdown Cancellation",
    "Revolving Guarantee Drawdown Early Cancellation",
    "Revolving Guarantee Reduction",
    "Term Loan Mandatory Early Repayment",
    "Term Loan Refund",
    "Term Loan Repayment",
    "Term Loan Total Early Repayment",
    "Term Loan Voluntary Early Repayment",
    "Voluntary RCF Early Repayment",
]

# Movement types dated by their end instead of their start.
DATED_BY_END = [
    "RCF Refund#",
    "Revolving Guarantee Drawdown Cancellation",
    "Term Loan Repayment",
]

# Settled payments that prove at least one payment was made.
SETTLED_STATES = ["Manually Settled", "Settled"]
PAYMENT_CLASSES = ["Fees", "Interest", "Fee Payment", "Repayment of principal"]

# Placeholders for "missing" in capital and provision sources.
MISSING_AMOUNT = "999999999999999.99"
MISSING_PERCENT = "999.999999"

# Currency and customer-id prefix by reporting entity.
ENTITY_CURRENCY = {"MX": "MXN", "ES": "EUR"}
ENTITY_CUSTOMER_PREFIX = {"ES": "ES0182", "MX": "MX0074"}
LEDGER_ENTITY_CUSTOMER_PREFIX = {"0182": "ES0182", "9016": "MX0074"}

# Rows of the cost-income table that count.
COST_INCOME_AREA = "GF"
HOME_OFFICE = "ESPAÑA"

SUSTAINABILITY_MARK = "RBES"
PUBLIC_AGENCY_PURPOSE = "ICO España"
FIRST_SPECULATIVE_GRADE = "BB+1"
LAST_INVESTMENT_ORDINAL = 10
UNKNOWN_TEXT = "No Informado"
UNRATED = "No Rating"

GROUP_LEVELS = ["CP", "CC", "SC"]
GROUP_RELATIONS = ["A", "B", "R"]

# Taxonomy catalogues: holding activity, subsector, sector.
ACTIVITY_CATALOGUE = "C039"
SUBSECTOR_CATALOGUE = "C164"
SECTOR_CATALOGUE = "C162"

PRODUCT_OF_PORTFOLIO = {
    "corporate_loan": "Corporate Facilities",
    "project_finance": "Project Finance",
}

# Rating columns of the wide table (letter, position) that decide the non-investment mark.
RATING_OF_PORTFOLIO = {
    "corporate_loan": ("reg_rating", "reg_rating_ordinal"),
    "project_finance": ("internal_rating", "internal_ordinal"),
}

# Columns that identify one rule of a limit sheet.
LIMIT_KEY = [
    "limit_type", "concept1_desc", "concept1_value", "concept2_desc",
    "concept2_value", "corporate_loan_flag", "project_finance_flag",
]
# --- end of fixed values --------------------------------------------------


def rating_ordinals() -> dict[str, int]:
    """Letter -> position on the scale; smaller is better."""
    ordinals = {letter: place for place, letter in enumerate(RATING_SCALE, start=1)}
    ordinals[UNRATED_ALIAS] = len(RATING_SCALE)
    return ordinals
