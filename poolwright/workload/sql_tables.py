"""The logical tables of ``tables`` as SQL common table expressions."""

from __future__ import annotations

import re

from poolwright.functions import codes
from poolwright.workload import literals as L

MONEY = "DECIMAL(20,4)"
RATE = "DECIMAL(9,6)"


def text(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def case(pairs: dict, column: str) -> str:
    arms = " ".join(f"WHEN {text(k)} THEN {text(v)}" for k, v in pairs.items())
    return f"CASE {column} {arms} END"


def in_list(values) -> str:
    return "(" + ", ".join(text(v) for v in values) + ")"


def values(rows, columns) -> str:
    body = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) v({', '.join(columns)})"


def pad(column: str, width: int) -> str:
    return f"LPAD(CAST({column} AS VARCHAR), {width}, '0')"


SCALE = "[" + ", ".join(text(x) for x in codes.RATING_SCALE) + "]"


def letter(index: str) -> str:
    return f"({SCALE})[CAST(({index}) % {len(codes.RATING_SCALE)} AS INTEGER) + 1]"


def ordinal(column: str) -> str:
    return case(codes.rating_ordinals(), f"TRIM({column})")


def non_ig(letter_sql: str) -> str:
    threshold = codes.rating_ordinals()[codes.FIRST_SPECULATIVE_GRADE]
    return f"CASE WHEN {ordinal(letter_sql)} >= {threshold} AND NOT {letter_sql} LIKE 'BBB%' THEN 1 ELSE 0 END"


def customer(number: str) -> str:
    return (f"CASE WHEN {number} % 2 = 0 THEN '{codes.ENTITY_CUSTOMER_PREFIX['ES']}' "
            f"ELSE '{codes.ENTITY_CUSTOMER_PREFIX['MX']}' END || {pad(number, 9)}")


def golden(number: str) -> str:
    return f"'A' || {pad(number, 8)}"


def currency(number: str) -> str:
    return case(L.REGION_CURRENCY, f"({number}) % 5")


ENTITY = "CASE WHEN l_suppkey % 2 = 0 THEN 'ES' ELSE 'MX' END"
LEDGER_ENTITY = f"CASE WHEN l_suppkey % 2 = 0 THEN '{L.HOME}' ELSE '{L.ABROAD}' END"
TAIL = f"{pad('l_orderkey', 12)} || {pad('l_linenumber', 2)} || {pad('l_partkey', 12)}"
CONTRACT = f"{ENTITY} || '0000' || {pad('l_suppkey % 10', 4)} || {TAIL}"
LOAN = (f"CAST(l_suppkey AS VARCHAR) AS facility_id, CAST(l_linenumber AS VARCHAR) AS tranche_id, "
        f"{pad('l_suppkey % 10', 4)} AS branch_id")
SIGNING = "DATE '1994-01-01' + CAST(l_suppkey % 365 AS INTEGER)"
EXPIRY = "DATE '2002-01-01' + CAST(l_linenumber * 100 AS INTEGER)"
MISSING = f"CAST({codes.MISSING_AMOUNT} AS {MONEY})"
GRAIN = "facility_id, tranche_id, branch_id"

CTES: dict[str, str] = {}
# evaluated once although named several times, also inside a recursion
MATERIALIZED = {"lines", "placed", "pool", "pool_long", "demand", "outcome", "allocated"}

CTES["fx"] = f"SELECT currency, CAST(fx AS DECIMAL(12,6)) AS fx FROM ({values(L.FX, ['currency', 'fx'])})"
CTES["bands"] = values(L.BANDS, ["band_from", "band_to", "short_letter", "long_letter"])
CTES["lim_relation"] = values(L.LIMIT_RELATION, [
    "limit_type", "corporate_loan_column", "project_finance_column", "header_flag", "imp_limit", "null_values"])

CTES["lines"] = f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus, l_quantity,
       CAST(l_extendedprice AS {MONEY}) AS price, CAST(l_discount AS {RATE}) AS disc,
       CAST(l_tax AS {RATE}) AS tax, CAST(l_shipdate AS DATE) AS ship_date
FROM lineitem"""

CTES["facility"] = f"""
SELECT CAST(l_orderkey AS VARCHAR) AS facility_id, CAST(l_linenumber AS VARCHAR) AS tranche_id,
       CAST(l_suppkey AS VARCHAR) AS branch_id,
       'G' || {pad('MIN(o_custkey) % 40', 2)} AS group_id, CASE WHEN MIN(o_custkey) % 23 <> 0 THEN MIN(n_name) END AS country,
       {case(L.REGION_CURRENCY, 'MIN(n_regionkey)')} AS currency,
       {case(L.STATUS_PRODUCT, 'MIN(o_orderstatus)')} AS financial_product,
       CASE WHEN MIN(c_mktsegment) = 'BUILDING' THEN 'Project Finance' ELSE 'Corporate Facilities' END AS com_product,
       ARG_MIN(p_type, l_partkey) AS sector, ARG_MIN(p_brand, l_partkey) AS subsector,
       CAST(MIN(o_orderdate) AS DATE) AS signing_date,
       CASE WHEN MIN(o_custkey) % 29 <> 0 THEN MAX(ship_date) + CAST(365 * l_linenumber AS INTEGER) END AS expiry_date,
       CAST(SUM(price) AS {MONEY}) AS reg_ead,
       CAST(SUM(price * (1 - disc)) AS {MONEY}) AS funded_eur,
       CAST(CAST(SUM(price * tax) AS DECIMAL(20,2)) AS {MONEY}) AS available_eur,
       CAST(SUM(price * disc) AS {MONEY}) AS reg_capital,
       CAST(SUM(CASE WHEN l_quantity > 45 THEN CAST(FLOOR(CAST(price AS DOUBLE) / 8) AS {MONEY}) ELSE 0 END) AS {MONEY}) AS sold_amount,
       CAST(CAST(SUM(price * disc) AS {MONEY}) AS DOUBLE) / CAST(CAST(SUM(price) AS {MONEY}) AS DOUBLE) AS reg_capital_ratio,
       {letter('MIN(o_custkey) + l_linenumber')} AS rating_letter,
       CASE WHEN MIN(o_custkey) % 5 <> 0 THEN {letter('MIN(o_custkey)')} END AS group_rating,
       {non_ig(letter('MIN(o_custkey) + l_linenumber'))} AS non_ig_flag,
       CASE WHEN l_suppkey % 50 = 7 THEN 1 ELSE 0 END AS bei_flag,
       CASE WHEN l_suppkey % 3 = 0 THEN 1 ELSE 0 END AS esg_linked_flag
FROM lines JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
     JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
GROUP BY l_orderkey, l_linenumber, l_suppkey"""

CTES["operations"] = f"""
SELECT {LOAN}, {LEDGER_ENTITY} AS entity_id, {currency('l_suppkey')} AS currency,
       {customer('l_suppkey')} AS customer_id, {SIGNING} AS signing_date, {EXPIRY} AS expiry_date,
       {pad('l_suppkey % 25', 2)} AS project_country_id,
       CASE WHEN l_linenumber = 1 THEN 'Multitranche' WHEN l_linenumber < 5 THEN 'Term Loan' ELSE 'RCF' END AS financial_product,
       CASE WHEN l_suppkey % 3 = 0 THEN 'Project Finance' ELSE 'Corporate Facilities' END AS com_product,
       CASE WHEN l_suppkey % 4 = 1 THEN ' {codes.PUBLIC_AGENCY_PURPOSE} ' ELSE 'General' END AS purpose,
       'P' || {pad('l_suppkey % 30', 3)} AS project_id, ' Field ' || CAST(l_suppkey % 6 AS VARCHAR) AS project_sector_desc,
       CASE WHEN l_suppkey % 7 = 0 THEN 'Bond' ELSE 'Loan' END AS security_type,
       CASE WHEN l_linenumber % 2 = 0 THEN 'Syndicated' ELSE 'Bilateral' END AS syndication_type,
       CASE WHEN l_linenumber % 3 = 0 THEN 'Secured' WHEN l_linenumber = 1 AND l_suppkey % 2 = 0 THEN 'Insured' END AS insured_type
FROM lines GROUP BY l_suppkey, l_linenumber"""

CTES["balances"] = f"""
SELECT b.*, CAST(funded_ccy * COALESCE(fx, 1) AS {MONEY}) AS funded_eur,
       CAST(available_ccy * COALESCE(fx, 1) AS {MONEY}) AS available_eur
FROM (SELECT {LOAN}, {LEDGER_ENTITY} AS entity_id, {currency('l_suppkey')} AS currency,
             CAST(SUM(price * (1 - disc)) AS {MONEY}) AS funded_ccy,
             CAST(SUM(CASE WHEN l_linestatus = 'O' THEN price * tax ELSE 0 END) AS {MONEY}) AS available_ccy,
             CASE WHEN l_suppkey % 20 = 3 THEN 0 ELSE
                  CAST(SUM(CASE WHEN l_returnflag = 'A' THEN price ELSE 0 END) AS {MONEY}) END AS commitment
      FROM lines GROUP BY l_suppkey, l_linenumber) b
LEFT JOIN fx USING (currency)"""

CTES["branches"] = f"""
SELECT {pad('l_suppkey % 10', 4)} AS branch_id, {LEDGER_ENTITY} AS entity_id, p_type AS entity_product
FROM lines JOIN part ON l_partkey = p_partkey"""

CTES["movements"] = f"""
SELECT {LOAN}, {LEDGER_ENTITY.replace('l_suppkey % 2', '(l_suppkey + CASE WHEN l_partkey % 17 = 3 THEN 1 ELSE 0 END) % 2')} AS entity_id, {currency('l_suppkey')} AS currency,
       {SIGNING} AS signing_date, {EXPIRY} AS expiry_date,
       {case({k: c for k, (c, _) in L.MOVEMENTS.items()}, 'l_returnflag || l_linestatus')} AS movement_class,
       {case({k: t for k, (_, t) in L.MOVEMENTS.items()}, 'l_returnflag || l_linestatus')} AS movement_type,
       CASE WHEN l_quantity > 25 THEN 'Settled' ELSE 'Pending' END AS payment_state,
       ship_date AS start_date, ship_date + CAST(l_linenumber AS INTEGER) AS end_date,
       price AS movement_amount, CAST(price * (1 - disc) AS {MONEY}) AS base_amount
FROM lines"""

CTES["relations"] = f"""
SELECT DISTINCT {CONTRACT} AS contract_id, {LOAN},
       CASE WHEN l_partkey % 4 = 0 THEN 'CONTRACT' ELSE 'FACILITY' END AS relation_level
FROM lines"""

CTES["econ_capital"] = f"""
SELECT {CONTRACT} AS contract_id, {ENTITY} AS entity_id,
       CASE WHEN l_quantity = 50 THEN {MISSING} ELSE price END AS econ_ead,
       CAST(price * disc * tax AS {MONEY}) AS econ_loss, CAST(price * tax AS {MONEY}) AS econ_capital,
       CASE WHEN l_quantity = 49 THEN CAST({codes.MISSING_PERCENT} AS {RATE}) ELSE disc END AS econ_pd
FROM lines WHERE l_returnflag <> 'N'"""

CTES["reg_capital"] = f"""
SELECT {CONTRACT} AS contract_id, {ENTITY} AS entity_id,
       CASE WHEN l_quantity = 50 THEN {MISSING} ELSE price END AS reg_ead,
       CAST(price * tax AS {MONEY}) AS reg_capital, CAST(price * disc * disc AS {MONEY}) AS reg_loss,
       disc AS reg_pd, CAST(tax * 5 AS {RATE}) AS reg_lgd, CAST(tax * 20 AS {RATE}) AS reg_rw
FROM lines WHERE l_returnflag <> 'N'"""

CTES["provisions"] = f"""
SELECT '00' || {pad('l_suppkey % 10', 4)} AS branch_code, {TAIL} AS contract_tail, {ENTITY} AS entity_id,
       CASE WHEN l_quantity = 50 THEN {MISSING} ELSE CAST(price * disc AS {MONEY}) END AS provision_amount,
       l_linenumber % 3 + 1 AS provision_stage, {pad('l_suppkey', 9)} AS local_customer_id,
       CAST(CAST(l_quantity % 3 AS INTEGER) AS VARCHAR) AS watch_list, {currency('l_suppkey')} AS currency
FROM lines WHERE l_linestatus = 'F'"""

CTES["customers"] = f"""
SELECT {golden('c_custkey')} AS golden_customer_id, c_name AS customer_name, c_mktsegment AS activity_id,
       {pad('c_nationkey', 2)} AS customer_country
FROM (SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_acctbal < 0)"""

CTES["links"] = f"SELECT {golden('c_custkey')} AS golden_customer_id, {customer('c_custkey')} AS customer_id FROM customer"

CTES["members"] = f"""
SELECT {customer('c_custkey')} AS customer_id, 'CP' AS hierarchy_level,
       {case(L.RELATION_TYPES, 'c_nationkey % 4')} AS relation_type, 'G' || {pad('c_custkey % 40', 2)} AS group_id,
       CASE WHEN c_custkey < 40 THEN 'S' ELSE 'N' END AS participant_header_type FROM customer
UNION ALL
SELECT {customer('c_custkey')}, CASE WHEN c_custkey % 11 = 0 THEN 'XX' ELSE 'CC' END, 'B',
       'G' || {pad('c_custkey % 37', 2)}, CASE WHEN c_custkey < 40 THEN 'S' ELSE 'N' END FROM customer"""

CTES["groups"] = f"""
SELECT 'G' || {pad('c_custkey % 40', 2)} AS group_id, {pad('MIN(c_nationkey)', 2)} AS group_country,
       '  ' || MIN(c_name) AS group_name, MIN(c_name) || ' holding ' AS group_full_name,
       'T' || CAST(c_custkey % 40 % 3 + 1 AS VARCHAR) AS tier_id, {pad('c_custkey % 40 % 8', 5)} AS segment_id
FROM customer GROUP BY c_custkey % 40"""

CTES["taxonomy_relation"] = f"""
SELECT '{codes.ACTIVITY_CATALOGUE}' AS from_catalogue, c_mktsegment AS from_value,
       '{codes.SUBSECTOR_CATALOGUE}' AS to_catalogue, 'U' || SUBSTR(c_mktsegment, 1, 2) AS to_value FROM customer
UNION ALL
SELECT '{codes.ACTIVITY_CATALOGUE}', c_mktsegment, '{codes.SECTOR_CATALOGUE}', 'K' || CAST(LENGTH(c_mktsegment) AS VARCHAR) FROM customer"""
CTES["taxonomy_values"] = """
SELECT to_catalogue AS catalogue, to_value AS value, 'Text of ' || to_value AS description
FROM taxonomy_relation WHERE to_value <> 'UMA'"""
CTES["countries"] = f"SELECT {pad('n_nationkey', 2)} AS country_id, n_name AS country_name FROM nation"

CTES["external_ratings"] = f"""
SELECT {golden('o_custkey')} AS golden_customer_id, {case(L.PRIORITY_RATING, 'o_orderpriority')} AS external_rating
FROM orders WHERE o_orderstatus <> 'P'"""

CTES["accredited"] = f"""
SELECT {pad('o_custkey', 9)} AS participant_id, CASE WHEN o_custkey % 2 = 0 THEN '{L.HOME}' ELSE '{L.ABROAD}' END AS ledger_entity,
       CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS rating_date, CAST(o_orderdate AS DATE) AS register_date,
       CASE WHEN o_orderstatus = 'F' THEN 'S ' ELSE 'N' END AS construction_type,
       {letter('o_orderkey')} AS project_rating, CASE WHEN o_orderkey % 4 = 0 THEN 'Adjusted' END AS capital_adjustment,
       CASE WHEN o_orderstatus = 'O' THEN 'High' ELSE 'Low' END AS project_score, CAST(o_orderkey % 100 / 100 AS {RATE}) AS project_lgd, o_orderkey AS row_id
FROM orders"""
CTES["customer_ratings"] = f"SELECT {customer('c_custkey')} AS customer_id, {letter('c_custkey * 3')} AS internal_rating, SUBSTR({letter('c_custkey * 3')}, 1, 2) AS short_rating, DATE '1998-01-01' + CAST(c_custkey % 180 AS INTEGER) AS rating_tool_date FROM customer"

CTES["cost_income"] = f"""
SELECT CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS cutoff_date, CASE WHEN o_custkey % 2 = 0 THEN '{codes.COST_INCOME_AREA}' ELSE 'other' END AS area_id,
       CASE WHEN o_custkey % 3 <> 0 THEN ' {codes.HOME_OFFICE} ' ELSE 'abroad' END AS office_desc, COUNT(*) / MAX(o_custkey)::DOUBLE AS ratio
FROM orders GROUP BY ALL"""

CTES["prior_deals"] = f"""
SELECT {LOAN}, tax AS sold_percent, CASE WHEN l_partkey % 3 <> 0 THEN l_partkey END AS deal_id,
       ship_date AS deal_date
FROM lines WHERE l_quantity > 45"""

CTES["guarantee_assignments"] = f"""
SELECT {CONTRACT} AS contract_id, 'GU' || CAST(l_partkey AS VARCHAR) AS guarantee_id, {currency('l_partkey')} AS currency,
       CAST(price * disc AS {MONEY}) AS guaranteed_amount, ship_date AS begin_date,
       ship_date + CAST(l_quantity * 30 AS INTEGER) AS end_date, DATE '{L.VALUE_DATE}' AS cutoff_date
FROM lines WHERE l_returnflag = 'R'"""
CTES["guarantee_board"] = f"""
SELECT 'GU' || CAST(l_partkey AS VARCHAR) AS guarantee_id, {customer('l_suppkey')} AS customer_id FROM lines"""
CTES["agency_customers"] = f"SELECT {customer('c_custkey')} AS customer_id FROM customer WHERE c_nationkey = 7"
CTES["marks"] = f"""
SELECT {CONTRACT} AS contract_id, CASE WHEN disc >= 0.08 THEN '{codes.SUSTAINABILITY_MARK}' ELSE 'OTHR' END AS mark_id
FROM lines WHERE l_returnflag = 'A'"""
CTES["entities"] = f"""
SELECT CASE WHEN s_suppkey % 2 = 0 THEN '{L.HOME}' ELSE '{L.ABROAD}' END AS entity_id, 'Entity of ' || MIN(s_name) AS entity_name
FROM supplier GROUP BY 1"""

_KIND = case(L.HISTORY_TYPES, f"o_orderkey % {len(L.HISTORY_TYPES)}")
CTES["sheet_history"] = f"""
SELECT o_orderkey AS rule_id, 'List ' || CAST(o_custkey % 7 AS VARCHAR) AS name_list_desc,
       CAST(o_orderdate AS DATE) AS limit_date,
       CASE WHEN o_orderkey % 4 = 0 THEN STRFTIME(o_orderdate, '%d/%m/%Y')
            WHEN o_orderkey % 4 = 1 THEN 'on ' || STRFTIME(o_orderdate, '%Y.%m.%d')
            WHEN o_orderkey % 97 = 2 THEN 'no date 12' ELSE STRFTIME(o_orderdate, '%Y-%m-%d') END AS limit_date_text,
       limit_type,
       CASE WHEN limit_type IN ('sts', 'sts_group') THEN 'sts_flag'
            WHEN limit_type = 'constant_type' THEN {case(L.CONSTANT_NAMES, 'o_custkey % 4')}
            ELSE limit_type || '_id' END AS concept1_desc,
       CASE WHEN limit_type = 'sts' THEN CASE WHEN o_custkey % 7 < 4 THEN '1' ELSE '0' END
            WHEN limit_type = 'sts_group' THEN '1'
            WHEN limit_type = 'group' THEN 'G' || {pad('o_custkey % 40', 2)} ELSE 'total' END AS concept1_value,
       CASE WHEN limit_type = 'sts_group' THEN 'group_id' ELSE '-' END AS concept2_desc,
       CASE WHEN limit_type = 'sts_group' THEN 'total' ELSE '-' END AS concept2_value,
       CASE WHEN o_orderkey % 89 = 5 THEN 'n/a'
            ELSE TRANSLATE(FORMAT('{{:,.2f}}', o_totalprice), ',.', '.,') END AS limit_value,
       CASE WHEN o_orderkey % 3 <> 0 THEN '1' ELSE '0' END AS corporate_loan_flag,
       CASE WHEN o_orderkey % 5 <> 0 THEN '1' ELSE '0' END AS project_finance_flag,
       CASE WHEN limit_type IN {in_list(L.ROW_TYPES)} THEN 'individual' ELSE 'portfolio' END AS limit_scope,
       CASE WHEN o_orderstatus <> 'P' THEN 1 ELSE 0 END AS active_flag,
       o_orderkey % 10 AS visual_order, CASE WHEN limit_type = 'sts_group' THEN 1 ELSE 0 END AS complex_limit,
       CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS closing_date
FROM (SELECT *, {_KIND} AS limit_type FROM orders)"""

_SHEET_COLUMNS = [name for name, _ in L.SHEET_COLUMNS]
_SIZE = "(SELECT FLOOR(CAST(SUM(price) AS DOUBLE) / 20000) * 1000 FROM lines)"
CTES["sheet"] = f"""
{values(L.SHEET, _SHEET_COLUMNS)}
UNION ALL SELECT {', '.join(text(v) if n != 'limit_value' else _SIZE for n, v in zip(_SHEET_COLUMNS, L.POOL_SIZE_RULE))}"""
CTES["pool"] = f"SELECT CAST({_SIZE} AS {MONEY}) AS size"


def with_ctes(query: str, recursive: bool = False, instead: dict[str, str] | None = None) -> str:
    """Prefix ``query`` with the expressions it names, each after those it needs; ``instead`` replaces some of them."""
    ctes = {**CTES, **(instead or {})}

    def named(sql: str) -> set[str]:
        return set(re.findall(r"[A-Za-z_][A-Za-z_0-9]*", sql)) & ctes.keys()

    ordered: list[str] = []

    def add(name: str, above: frozenset[str]) -> None:
        if name not in ordered and name not in above:
            for other in sorted(named(ctes[name]) - {name}, key=list(ctes).index):
                add(other, above | {name})
            ordered.append(name)

    for name in sorted(named(query), key=list(ctes).index):
        add(name, frozenset())
    parts = [f"{name} AS {'MATERIALIZED ' if name in MATERIALIZED else ''}({ctes[name].strip()})" for name in ordered]
    keyword = "WITH RECURSIVE" if recursive else "WITH"
    return f"{keyword} {', '.join(parts)} {query.strip()}" if parts else query.strip()
