"""Queries over limit sheets, eligibility, pool allocation and its reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from poolwright import GRAIN
from poolwright.functions import codes
from poolwright.functions.exprs import grain_key
from poolwright.operators import allocation as A
from poolwright.operators import eligibility, limits, report
from poolwright.operators.ranking import ranked
from poolwright.plans import selection
from poolwright.session import Run, materialize
from poolwright.workload import literals as L
from poolwright.workload.basics import SHEET_SPEC
from poolwright.workload.registry import query
from poolwright.workload.spec import project, sql_columns
from poolwright.workload.sql_tables import CTES, MONEY, case

KEY = "facility_id, tranche_id, branch_id"
KEYS = "facility_id tranche_id branch_id"
UNITS = limits.SHARE_UNITS

# --- sheets ---

CTES["active_rules"] = f"""
SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY name_list_desc, {', '.join(codes.LIMIT_KEY)} ORDER BY limit_date DESC, rule_id) AS place
  FROM sheet_history WHERE active_flag = 1) WHERE place = 1"""
CTES["current_rules"] = """
SELECT a.* FROM active_rules a LEFT JOIN (
  SELECT name_list_desc, ARG_MAX(concept1_desc, concept1_value) AS switch_name FROM active_rules WHERE limit_type = 'sts'
  GROUP BY 1 HAVING MAX(concept1_value) <> '1') o ON a.name_list_desc = o.name_list_desc
WHERE o.switch_name IS NULL OR a.concept1_desc <> o.switch_name OR a.concept1_value <> '1'"""


@query("limits_active", f"SELECT {sql_columns(SHEET_SPEC)} FROM current_rules")
def limits_active(t):
    return project(limits.active_limits(t.sheet_history), SHEET_SPEC)


HEADER = "name_list_desc portfolio_type d:limit_date f:pool_size"
_NUMBER = "TRY_CAST(REPLACE(REPLACE(TRIM(limit_value), '.', ''), ',', '.') AS DOUBLE)"


@query("limits_header", f"""
SELECT name_list_desc, CASE WHEN MAX(CASE WHEN limit_type = 'portfolio_type' THEN corporate_loan_flag END) = '1' THEN 'corporate_loan' ELSE 'project_finance' END AS portfolio_type,
       STRFTIME(MAX(limit_date), '%Y-%m-%d') AS limit_date, MAX(CASE WHEN limit_type = 'portfolio_size' THEN {_NUMBER} END) AS pool_size
FROM current_rules GROUP BY 1""")
def limits_header(t):
    from poolwright.sources.limit_sheets import read_limit_sheet

    return project(limits.portfolio_header(read_limit_sheet(limits.active_limits(t.sheet_history))), HEADER)


RESOLVED = "i:rule_id name_list_desc limit_type concept1_value f:limit_value limit_scope target_column cap_basis f:null_share"


@query("limits_resolved", f"""
SELECT CAST(rule_id AS BIGINT) AS rule_id, name_list_desc, c.limit_type, concept1_value,
       CASE WHEN c.limit_type = 'risk_retention' THEN 1 - {_NUMBER} ELSE {_NUMBER} END AS limit_value,
       {case(limits.SCOPES, 'limit_scope')} AS limit_scope, corporate_loan_column AS target_column,
       {case(limits.SCOPES, "CASE WHEN imp_limit = 'limit_scope' THEN limit_scope ELSE imp_limit END")} AS cap_basis,
       CAST(null_values AS DOUBLE) AS null_share
FROM current_rules c LEFT JOIN lim_relation r ON c.limit_type = r.limit_type WHERE c.limit_type <> 'constant_type'""")
def limits_resolved(t):
    from poolwright.sources.limit_sheets import read_limit_sheet

    rules = limits.without_constants(read_limit_sheet(limits.active_limits(t.sheet_history)))
    return project(limits.resolve_limits(rules, t.relation, "corporate_loan"), RESOLVED)


TAX_RATE, CET1 = 0.3, 0.115


@query("pool_constants", f"""
SELECT name_list_desc, concept1_desc AS constant_type, ROUND({_NUMBER}, 6) AS constant_value FROM current_rules WHERE limit_type = 'constant_type'
UNION ALL SELECT 'all', 'tax_rate', {TAX_RATE}::DOUBLE UNION ALL SELECT 'all', 'ratio_cet1', {CET1}::DOUBLE
UNION ALL SELECT 'all', 'lgd', ROUND(CAST(SUM(reg_lgd) AS DOUBLE) / COUNT(reg_lgd), 6) FROM wide
UNION ALL SELECT 'all', 'ci_ratio', (SELECT ROUND(MIN(ratio), 6) FROM cost_income
  WHERE cutoff_date = (SELECT MAX(cutoff_date) FROM cost_income) AND area_id = '{codes.COST_INCOME_AREA}' AND TRIM(office_desc) = '{codes.HOME_OFFICE}')""")
def pool_constants(t):
    from poolwright.sources.limit_sheets import read_limit_sheet

    sheet = read_limit_sheet(limits.active_limits(t.sheet_history))
    out = selection.pool_constants(sheet, wide_rows(t), "reg_lgd", selection.cost_income(t.cost_income), {"tax_rate": TAX_RATE, "ratio_cet1": CET1})
    return project(out, "name_list_desc constant_type r:constant_value")


def wide_rows(t, staged=False):
    """The wide cube of the stand-in sources."""
    from poolwright.plans import cube
    from poolwright.workload.enrichment import cube_sources

    dates = {"snapshot_date": L.VALUE_DATE, "risk_date": L.VALUE_DATE, "provision_date": L.VALUE_DATE}
    return cube.wide_cube(cube_sources(t), L.VALUE_DATE, dates, staged)


# --- eligibility ---

RETAINED, CCF = 0.2, 0.5
CTES["based"] = f"""
SELECT *, CAST(LEAST(CAST(reg_ead AS DOUBLE), CAST(funded_eur + available_eur * {CCF} AS DOUBLE)) - CAST(sold_amount AS DOUBLE) / {1 - RETAINED} AS {MONEY}) AS base_amount
FROM facility WHERE com_product = 'Corporate Facilities'"""


def rules_of(kind):
    return [(r[4], r[6], r[7]) for r in L.SHEET if r[2] == kind]


def share_case(column, kind, by=0):
    """One-column rule lookup as CASE; NULL where nothing matches."""
    return case({(r[1] if by else r[0]): r[2] for r in rules_of(kind) if (r[1] if by else r[0]) != "total"}, column)


def null_share(kind):
    return next(r[5] for r in L.LIMIT_RELATION if r[0] == kind)


def _one(column, kind):
    return f"CASE WHEN {column} IS NULL THEN {null_share(kind)} ELSE COALESCE({share_case(column, kind)}, 1.0) END"


_GEO = " ".join(
    "WHEN " + " AND ".join([f"sector = '{a}'"] * (a != "total") + [f"country = '{b}'"] * (b != "total")) + f" THEN {v}"
    for a, b, v in sorted(rules_of("geo_sector"), key=lambda r: r[2]))


def maturity_case(kind, unknown):
    """Least share of the bounds that the expiry date breaks."""
    sign = "<" if kind == "maturity_min" else ">"
    shares = [f"CASE WHEN expiry_date {sign} DATE '{L.LIMIT_DATE}' + {days} THEN {share} ELSE 1.0 END" for days, _, share in rules_of(kind)]
    return f"CASE WHEN expiry_date IS NULL THEN {unknown} ELSE LEAST({', '.join(shares)}, 1.0) END"


_ROW_SQL = {
    "risk_retention": f"{1 - RETAINED}",
    "rating_rga_esl": _one("rating_letter", "rating_rga_esl"),
    "rating_sp": _one("group_rating", "rating_sp"),
    "bei": f"CASE WHEN bei_flag = 1 THEN 0.0 ELSE 1.0 END",
    "excluded_facilities": _one("facility_id", "excluded_facilities"),
    "geo_sector": f"CASE {_GEO} WHEN country IS NULL THEN {null_share('geo_sector')} ELSE 1.0 END",
    "maturity_max": maturity_case("maturity_max", null_share("maturity_max")),
}
_ROW_NAMES = list(_ROW_SQL)
_MATCHED = {
    "risk_retention": "TRUE",
    "rating_rga_esl": f"{share_case('rating_letter', 'rating_rga_esl')} IS NOT NULL",
    "rating_sp": f"{share_case('group_rating', 'rating_sp')} IS NOT NULL",
    "bei": "bei_flag = 1",
    "excluded_facilities": f"{share_case('facility_id', 'excluded_facilities')} IS NOT NULL",
    "geo_sector": f"CASE {_GEO} END IS NOT NULL",
    "maturity_max": "TRUE",
}
CTES["row_limited"] = f"""
SELECT *, CONCAT_WS(', ', {', '.join(f"CASE WHEN limit_{n} = 0 THEN '{n}' END" for n in _ROW_NAMES)}) AS exclusion_limits
FROM (SELECT *, {', '.join(f'CAST({sql} AS DOUBLE) AS limit_{n}' for n, sql in _ROW_SQL.items())},
      CONCAT_WS(',', {', '.join(f"CASE WHEN {m} THEN '{n}' END" for n, m in _MATCHED.items())}) AS limits_applied FROM based)"""
_ON_ROW = [n for n in _ROW_NAMES if n != "rating_rga_esl"]
CTES["eligible"] = f"""
SELECT *, CASE WHEN row_share_limit = 0 OR cap_amount <= 0 THEN 1 ELSE 0 END AS excluded, CASE WHEN eligible_amount > 0 THEN 1 ELSE 0 END AS is_candidate,
  CASE WHEN row_share_limit = 0 OR cap_amount <= 0 THEN 'row limit 0' WHEN base_amount <= 0 THEN 'base amount 0' ELSE 'NA' END AS exclusion_reason
FROM (SELECT *, LEAST(initial_amount, cap_amount) AS eligible_amount FROM (
  SELECT r.*, LEAST({', '.join(f'limit_{n}' for n in _ON_ROW)}) AS row_share_limit, limit_rating_rga_esl AS pool_share_limit,
    CAST(CAST(limit_rating_rga_esl AS DECIMAL(9,7)) * size AS {MONEY}) AS cap_amount,
    CAST(base_amount * CAST(LEAST({', '.join(f'limit_{n}' for n in _ON_ROW)}) AS DECIMAL(9,7)) AS {MONEY}) AS initial_amount
  FROM row_limited r, pool))"""
CTES["eligible_variant"] = f"""
SELECT *, CASE WHEN row_share_limit = 0 OR cap_amount <= 0 THEN 1 ELSE 0 END AS excluded, LEAST(base_amount, cap_amount) AS eligible_amount,
  CASE WHEN LEAST(base_amount, cap_amount) > 0 THEN 1 ELSE 0 END AS is_candidate
FROM (SELECT r.*, LEAST({', '.join(f'limit_{n}' for n in _ROW_NAMES)}) AS row_share_limit,
   LEAST(CAST(CAST(limit_rating_rga_esl AS DECIMAL(9,7)) * size AS {MONEY}), {', '.join(f'CAST(CAST(limit_{n} AS DECIMAL(9,7)) * base_amount AS {MONEY})' for n in _ON_ROW)}) AS cap_amount
  FROM row_limited r, pool)"""


def setup(t):
    """Facilities with their base amount, and the rule book of the sheet."""
    return selection.prepare(t.facility, t.sheet, t.relation)


@query("base_amount", f"SELECT {sql_columns(f'{KEYS} m:base_amount')} FROM based")
def base_amount(t):
    facilities, _ = setup(t)
    return project(facilities, f"{KEYS} m:base_amount")


ROW_SPEC = f"{KEYS} " + " ".join(f"f:limit_{n}" for n in _ROW_NAMES if n != "geo_sector") + " limits_applied exclusion_limits"


@query("row_limits", f"SELECT {sql_columns(ROW_SPEC)} FROM row_limited")
def row_limits(t):
    facilities, book = setup(t)
    return project(eligibility.apply_row_limits(facilities, book), ROW_SPEC)


@query("row_limits_two_key", f"SELECT {sql_columns(f'{KEYS} sector country f:limit_geo_sector')} FROM row_limited")
def row_limits_two_key(t):
    facilities, book = setup(t)
    return project(eligibility.apply_row_limits(facilities, book), f"{KEYS} sector country f:limit_geo_sector")


ELIGIBLE = f"{KEYS} m:base_amount f:row_share_limit f:pool_share_limit m:cap_amount m:eligible_amount i:excluded i:is_candidate exclusion_reason exclusion_limits"


@query("eligible_amount", f"SELECT {sql_columns(ELIGIBLE)} FROM eligible")
def eligible_amount(t):
    facilities, book = setup(t)
    return project(selection.eligible(facilities, book), ELIGIBLE)


MINCAP = f"{KEYS} m:base_amount f:row_share_limit m:cap_amount m:eligible_amount i:excluded i:is_candidate"


@query("eligible_amount_mincap", f"SELECT {sql_columns(MINCAP)} FROM eligible_variant")
def eligible_amount_mincap(t):
    facilities, book = setup(t)
    return project(eligibility.eligible_amount_mincap(eligibility.apply_row_limits(facilities, book), book), MINCAP)


# --- universe ---

def _pool_share(kind, column, by=0):
    totals = [r[2] for r in rules_of(kind) if (r[1] if by else r[0]) == "total"]
    named = {(r[1] if by else r[0]): r[2] for r in rules_of(kind) if (r[1] if by else r[0]) != "total"}
    rest = min(totals) if totals else 1.0
    return f"COALESCE({case(named, column)}, {rest})"


# limit type, value as text, allowed share; in sheet order, then the always-tracked product
_POOL_SQL = [
    ("group", "group_id", _pool_share("group", "group_id")),
    ("sts_group", "group_id", _pool_share("sts_group", "group_id", by=1)),
    ("customer_country", "country", _pool_share("customer_country", "country")),
    ("customer_sector", "sector", _pool_share("customer_sector", "sector")),
    ("subsector", "subsector", _pool_share("subsector", "subsector")),
    ("non_ig", "CAST(non_ig_flag AS VARCHAR)", _pool_share("non_ig", "CAST(non_ig_flag AS VARCHAR)")),
    ("divisa", "currency", _pool_share("divisa", "currency")),
    ("maturity_min", "CAST(expiry_date AS VARCHAR)", maturity_case("maturity_min", min(r[2] for r in rules_of("maturity_min")))),
    ("financial_product", "financial_product", "1.0"),
]
CTES["pool_long"] = " UNION ALL ".join(
    f"SELECT {KEY}, place, is_candidate, eligible_amount, {i} AS ord, '{kind}' AS limit_type, COALESCE({value}, 'None') AS limit_value, "
    f"CAST(ROUND(CAST({share} AS DOUBLE) * {UNITS}) AS BIGINT) AS allowed FROM placed"
    for i, (kind, value, share) in enumerate(_POOL_SQL))
CTES["placed"] = f"""
SELECT *, ROW_NUMBER() OVER (ORDER BY reg_capital_ratio DESC NULLS LAST, facility_id || '_' || tranche_id || '_' || branch_id DESC) AS place FROM eligible"""
# definition order matters: placed before pool_long
CTES["pool_long"] = CTES.pop("pool_long")

UNIVERSE = "limit_type limit_value f:allowed_share m:cap_amount"


@query("limit_universe", f"""
SELECT {sql_columns(UNIVERSE)} FROM (SELECT DISTINCT limit_type, limit_value, allowed / {UNITS}::DOUBLE AS allowed_share,
   allowed * CAST(size AS DOUBLE) / {UNITS}::DOUBLE AS cap_amount FROM pool_long, pool)""")
def limit_universe(t):
    facilities, book = setup(t)
    return project(A.universe_of(facilities, book), UNIVERSE)


@query("maturity_rule", f"""
SELECT {KEY}, STRFTIME(expiry_date, '%Y-%m-%d') AS expiry_date, CAST({maturity_case('maturity_min', null_share('maturity_min'))} AS DOUBLE) AS min_share, limit_maturity_max AS max_share FROM row_limited""")
def maturity_rule(t):
    facilities, book = setup(t)
    by_name = {s.name: s for s in book.specs}
    out = facilities.withColumns({
        "min_share": limits.date_share(by_name["maturity_min"], book.limit_date),
        "max_share": limits.date_share(by_name["maturity_max"], book.limit_date)})
    return project(out, f"{KEYS} d:expiry_date f:min_share f:max_share")


@query("ordered_candidates", f"SELECT {sql_columns(f'facility_key i:place i:is_candidate')} FROM (SELECT *, facility_id || '_' || tranche_id || '_' || branch_id AS facility_key FROM placed)")
def ordered_candidates(t):
    facilities, book = setup(t)
    placed, _ = ranked(selection.eligible(facilities, book).select(*GRAIN, *A.ORDER_COLUMNS, "is_candidate"), A.default_order())
    placed = placed.withColumns({"facility_key": grain_key(*GRAIN), "place": F.col("rank")})
    return project(placed, "facility_key i:place i:is_candidate")


# --- allocation: the whole fill as a recursive query, one step per used-up cap ---

CTES["demand"] = f"""
SELECT l.place, limit_type || '=' || limit_value AS id, CAST(eligible_amount * 10000 AS BIGINT) AS wanted, allowed AS room,
       CAST(FLOOR(CAST(eligible_amount AS DOUBLE) * {UNITS}.0::DOUBLE / CAST(size AS DOUBLE) + 0.5) AS BIGINT) AS draw
FROM pool_long l, pool WHERE is_candidate = 1 AND l.place NOT IN (SELECT place FROM pool_long WHERE allowed = 0)
UNION ALL
SELECT place, 'pool', CAST(eligible_amount * 10000 AS BIGINT), CAST(size * 10000 AS BIGINT), CAST(eligible_amount * 10000 AS BIGINT)
FROM placed, pool WHERE is_candidate = 1 AND place NOT IN (SELECT place FROM pool_long WHERE allowed = 0)"""
CTES["fill"] = f"""
SELECT 0 AS step, CAST([] AS STRUCT(place BIGINT, take BIGINT, units BIGINT, ids VARCHAR[])[]) AS events, FALSE AS full_pool
UNION ALL
SELECT f.step + 1, LIST_APPEND(f.events, STRUCT_PACK(place := e.place, take := e.take, units := e.units, ids := e.ids)), e.full_now
FROM fill f, (
  SELECT place, take, units, COALESCE(LIST(id) FILTER (WHERE id <> 'pool' AND (left_over - units <= 0 OR left_ticks <= take)), []) AS ids,
         BOOL_OR(id = 'pool' AND left_over - take <= 0) AS full_now
  FROM (
    SELECT *, CAST(FLOOR(CAST(take AS DOUBLE) / 10000.0::DOUBLE * {UNITS}.0::DOUBLE / CAST(size AS DOUBLE) + 0.5) AS BIGINT) AS units
    FROM (
      SELECT *, LEAST(wanted, MIN(left_ticks) OVER ()) AS take
      FROM (
        SELECT *, CASE WHEN id = 'pool' THEN left_over
                       ELSE CAST((2 * CAST(size * 10000 AS HUGEINT) * left_over + {UNITS}) // (2 * {UNITS}) AS BIGINT) END AS left_ticks
        FROM (
          SELECT *, MIN(CASE WHEN left_over - drawn <= 0 AND place > last_place THEN place END) OVER () AS first_place
          FROM (
            SELECT place, id, wanted, drawn, last_place,
                   room - CAST(COALESCE(SUM(drawn) OVER (PARTITION BY id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS left_over
            FROM (
              SELECT d.place, d.id, d.wanted, d.room,
                     CASE WHEN s.place IS NULL THEN d.draw WHEN d.id = 'pool' THEN s.take ELSE s.units END AS drawn,
                     (SELECT COALESCE(MAX(LIST_LAST(events).place), -1) FROM fill) AS last_place
              FROM demand d LEFT JOIN (SELECT ev.place, ev.take, ev.units FROM (SELECT UNNEST(events) AS ev FROM fill)) s ON d.place = s.place
              WHERE d.place NOT IN (
                SELECT b.place FROM demand b JOIN (SELECT UNNEST(ev.ids) AS id, ev.place AS since FROM (SELECT UNNEST(events) AS ev FROM fill)) u
                  ON b.id = u.id AND b.place > u.since)
            )
          )
        ), pool WHERE place = first_place
      )
    )
  ) GROUP BY place, take, units
) e WHERE NOT f.full_pool"""
CTES["outcome"] = f"""
SELECT p.*, COALESCE(p.place <= fin.full_at, TRUE) AS visited, s.take AS settled, r.blocked
FROM placed p
CROSS JOIN (SELECT CASE WHEN full_pool THEN LIST_LAST(events).place END AS full_at FROM fill ORDER BY step DESC LIMIT 1) fin
LEFT JOIN (SELECT ev.place, ev.take FROM (SELECT UNNEST(events) AS ev FROM (SELECT events FROM fill ORDER BY step DESC LIMIT 1))) s ON p.place = s.place
LEFT JOIN (
  SELECT l.place, ARG_MAX(STRUCT_PACK(limit_type := l.limit_type, limit_value := l.limit_value, allowed := l.allowed), l.ord) AS blocked
  FROM pool_long l LEFT JOIN (SELECT UNNEST(ev.ids) AS id, ev.place AS since FROM (SELECT UNNEST(events) AS ev FROM (SELECT events FROM fill ORDER BY step DESC LIMIT 1))) u
    ON l.limit_type || '=' || l.limit_value = u.id
  WHERE l.allowed = 0 OR u.since < l.place GROUP BY l.place) r ON p.place = r.place"""
CTES["allocated"] = f"""
SELECT o.*, taken > 0 AS is_taken, CAST(FLOOR(CAST(taken AS DOUBLE) * {UNITS}.0::DOUBLE / CAST(size AS DOUBLE) + 0.5) AS BIGINT) AS taken_units,
       SUM(taken) OVER w AS filled, SUM(CASE WHEN taken > 0 THEN 1 ELSE 0 END) OVER w AS selected_so_far, size
FROM (SELECT *, CAST(CASE WHEN NOT visited OR is_candidate = 0 THEN 0 WHEN settled IS NOT NULL THEN settled / 10000.0
                     WHEN blocked IS NOT NULL THEN 0 ELSE eligible_amount END AS {MONEY}) AS taken FROM outcome) o, pool
WINDOW w AS (ORDER BY place)"""
CTES["portfolio"] = f"""
SELECT a.*, taken AS allocated_amount, CAST(is_taken AS INTEGER) AS is_selected, CASE WHEN visited THEN a.place ELSE 0 END AS candidate_rank,
  CASE WHEN is_taken THEN selected_so_far ELSE 0 END AS selected_rank,
  CASE WHEN visited THEN LEAST(CASE WHEN CAST(filled - taken AS DOUBLE) + CAST(eligible_amount AS DOUBLE) > size
        THEN (CAST(size AS DOUBLE) - CAST(filled - taken AS DOUBLE)) / NULLIF(CAST(eligible_amount AS DOUBLE), 0) ELSE 1 END, least_allowed / {UNITS}::DOUBLE) ELSE 1 END AS pool_limit,
  CASE WHEN is_taken THEN taken_units / {UNITS}::DOUBLE ELSE 0 END AS pool_share,
  CASE WHEN visited THEN filled ELSE 0 END AS cumulative_amount,
  CASE WHEN visited THEN FLOOR(CAST(filled AS DOUBLE) * {UNITS}.0::DOUBLE / CAST(size AS DOUBLE) + 0.5) / {UNITS}::DOUBLE ELSE 0 END AS cumulative_share,
  CASE WHEN is_taken THEN CAST(taken AS DOUBLE) / CAST(base_amount AS DOUBLE) ELSE 0 END AS facility_share,
  CASE WHEN visited AND is_candidate = 1 AND NOT is_taken THEN CASE WHEN blocked.allowed = 0 THEN 'pool limit 0' ELSE 'pool limit used up' END ELSE exclusion_reason END AS reason,
  CASE WHEN visited AND is_candidate = 1 AND NOT is_taken THEN blocked.limit_type || '-' || blocked.limit_value ELSE exclusion_limits END AS detail
FROM allocated a JOIN (SELECT place, MIN(allowed) AS least_allowed FROM pool_long GROUP BY 1) m ON a.place = m.place"""
CTES["trace"] = f"""
SELECT l.facility_id, l.tranche_id, l.branch_id, l.place, l.limit_type, l.limit_value, l.allowed, a.visited, a.size,
       SUM(CASE WHEN is_taken THEN taken_units ELSE 0 END) OVER w AS used, SUM(taken) OVER w AS used_amount,
       CASE WHEN is_taken THEN taken_units ELSE 0 END AS own
FROM pool_long l JOIN allocated a ON l.place = a.place WINDOW w AS (PARTITION BY l.limit_type, l.limit_value ORDER BY l.place)"""


#: Columns of the facilities that the reports on a fill read, besides those that the fill itself needs.
REPORTED = ("base_amount", "eligible_amount", "is_candidate", "row_share_limit", "exclusion_reason", "exclusion_detail", "signing_date")


def filled_pool(t):
    facilities, book = setup(t)
    return selection.fill(facilities, book, REPORTED)


def saved_fill(t):
    """The fill that reports start from: made by the first one on these tables, in a run of its own, and shared by the others."""
    key = (t.spark.sparkContext.applicationId, t.path)
    if key not in _SAVED:
        with Run(t.spark):
            _SAVED[key] = filled_pool(t)
    return _SAVED[key]


#: Fills by application and tables; their tables stay in the work folder.
_SAVED: dict[tuple[str, str], A.Filled] = {}


PORTFOLIO = (f"{KEYS} i:is_candidate m:base_amount m:eligible_amount i:is_selected m:allocated_amount i:candidate_rank i:selected_rank "
             "p:pool_limit p:pool_share m:cumulative_amount p:cumulative_share p:facility_share exclusion_reason exclusion_detail")
_PORTFOLIO_SQL = sql_columns(PORTFOLIO).replace("CAST(exclusion_reason AS", "CAST(reason AS").replace("CAST(exclusion_detail AS", "CAST(detail AS")


@query("allocate_pool", f"SELECT {_PORTFOLIO_SQL} FROM portfolio", recursive=True)
def allocate_pool(t):
    filled = filled_pool(t)
    return project(A.allocation(filled), PORTFOLIO)


TRACE = f"{KEYS} i:candidate_rank limit_type limit_value p:allowed_share m:cap_amount p:available_share p:used_share m:used_amount"


@query("allocation_trace", f"""
SELECT {sql_columns(TRACE)} FROM (SELECT *, CASE WHEN visited THEN place ELSE 0 END AS candidate_rank,
  CASE WHEN visited THEN allowed / {UNITS}::DOUBLE ELSE 1 END AS allowed_share,
  CASE WHEN visited THEN allowed * CAST(size AS DOUBLE) / {UNITS}::DOUBLE ELSE size END AS cap_amount,
  CASE WHEN visited THEN GREATEST(allowed - (used - own), 0) / {UNITS}::DOUBLE END AS available_share,
  CASE WHEN visited THEN used / {UNITS}::DOUBLE ELSE 0 END AS used_share,
  CASE WHEN visited THEN used_amount ELSE 0 END AS used_amount_shown FROM trace)""".replace(
    "CAST(CAST(used_amount AS", "CAST(CAST(used_amount_shown AS"), recursive=True)
def allocation_trace(t):
    filled = saved_fill(t)
    return project(A.allocation_trace(filled), TRACE)


LEDGER = "limit_type limit_value p:allowed_share p:used_share m:cap_amount m:used_amount scenario"


@query("limit_ledger", f"""
SELECT {sql_columns(LEDGER)} FROM (SELECT l.limit_type, l.limit_value, MAX(l.allowed) / {UNITS}::DOUBLE AS allowed_share,
  SUM(CASE WHEN is_taken THEN taken_units ELSE 0 END) / {UNITS}::DOUBLE AS used_share, MAX(l.allowed) * CAST(MAX(a.size) AS DOUBLE) / {UNITS}::DOUBLE AS cap_amount,
  SUM(taken) AS used_amount, '{L.SCENARIO}' AS scenario FROM pool_long l JOIN allocated a ON l.place = a.place GROUP BY 1, 2)""", recursive=True)
def limit_ledger(t):
    filled = filled_pool(t)
    return project(A.limit_ledger(filled, L.SCENARIO), LEDGER)


TYPED = f"{KEYS} file_tranche portfolio_type d:signing_date f:base_amount f:eligible_amount f:allocated_amount p:pool_share p:cumulative_share"


@query("portfolio_typed", f"""
SELECT facility_id, tranche_id, branch_id, facility_id || '_' || tranche_id AS file_tranche, 'corporate_loan' AS portfolio_type,
  STRFTIME(signing_date, '%Y-%m-%d') AS signing_date, CAST(base_amount AS DOUBLE) AS base_amount, CAST(eligible_amount AS DOUBLE) AS eligible_amount,
  CAST(allocated_amount AS DOUBLE) AS allocated_amount, ROUND(pool_share::DOUBLE, 7) AS pool_share, ROUND(cumulative_share::DOUBLE, 7) AS cumulative_share
FROM portfolio""", recursive=True)
def portfolio_typed(t):
    filled = saved_fill(t)
    return project(report.typed_portfolio(A.allocation(filled), "corporate_loan"), TYPED)


TOTALS = "i:facilities i:candidates i:selected m:base_amount m:eligible_amount m:allocated_amount f:pool_size r:allocated_share r:remaining"


@query("portfolio_totals", f"""
SELECT {sql_columns(TOTALS)} FROM (SELECT COUNT(*) AS facilities, SUM(is_candidate) AS candidates, SUM(is_selected) AS selected,
  SUM(base_amount) AS base_amount, SUM(eligible_amount) AS eligible_amount, SUM(taken) AS allocated_amount, CAST(MAX(size) AS DOUBLE) AS pool_size,
  CAST(SUM(taken) AS DOUBLE) / CAST(MAX(size) AS DOUBLE) AS allocated_share, CAST(MAX(size) AS DOUBLE) - CAST(SUM(taken) AS DOUBLE) AS remaining FROM portfolio)""", recursive=True)
def portfolio_totals(t):
    filled = saved_fill(t)
    return project(report.portfolio_totals(A.allocation(filled), filled.pool), TOTALS)


@query("exclusion_summary", """
SELECT CAST(is_selected AS BIGINT) AS is_selected, reason AS exclusion_reason, detail AS exclusion_detail, COUNT(*) AS n FROM portfolio GROUP BY 1, 2, 3""", recursive=True)
def exclusion_summary(t):
    filled = saved_fill(t)
    return project(report.exclusion_summary(A.allocation(filled)).orderBy("is_selected", "exclusion_reason", "exclusion_detail"),
                   "i:is_selected exclusion_reason exclusion_detail i:n")


def _violations(name, condition, source="portfolio"):
    return f"SELECT '{name}' AS check_name, CAST(COALESCE(SUM(CASE WHEN {condition} THEN 1 ELSE 0 END), 0) AS BIGINT) AS violations FROM {source}"


@query("allocation_checks", " UNION ALL ".join([
    _violations("selected_on_zero_limit", "is_taken AND (row_share_limit = 0 OR pool_limit = 0)"),
    _violations("above_eligible", "taken > eligible_amount"),
    _violations("above_pool_limit", "taken > pool_limit * size + 0.001"),
    _violations("share_without_amount", "pool_share > 0 AND taken = 0"),
    _violations("selected_not_candidate", "is_taken AND is_candidate = 0"),
    _violations("zero_share_with_amount", "is_taken AND ROUND(facility_share, 7) = 0 AND taken > base_amount * 0.000001"),
    _violations("pool_overshoot", "total > size", "(SELECT SUM(taken) AS total, MAX(size) AS size FROM portfolio)"),
    _violations("cap_exceeded", "used > allowed", "(SELECT MAX(used) AS used, MAX(allowed) AS allowed FROM trace GROUP BY limit_type, limit_value)"),
]), recursive=True)
def allocation_checks(t):
    filled = saved_fill(t)
    checks = report.allocation_checks(A.allocation(filled), A.limit_ledger(filled, L.SCENARIO), filled.pool)
    return project(checks, "check_name i:violations")


# --- from the wide cube to a selected pool ---

def _cube_facility(letter, ordinal):
    return f"""
SELECT {KEY}, group_id, customer_country AS country, currency, financial_product, com_product, sector_desc AS sector, subsector_desc AS subsector,
  signing_date, expiry_date, reg_ead, funded_eur, available_eur, reg_capital, CAST(sold_amount AS {MONEY}) AS sold_amount, reg_capital_ratio,
  {letter} AS rating_letter, group_rating,
  CASE WHEN {ordinal} >= {codes.RATING_SCALE.index(codes.FIRST_SPECULATIVE_GRADE) + 1} AND NOT STARTS_WITH({letter}, 'BBB') THEN 1 ELSE 0 END AS non_ig_flag,
  CASE WHEN COALESCE(agency_guaranteed, 0) <> 0 THEN 1 ELSE 0 END AS bei_flag, CASE WHEN esg_linked = 1 THEN 1 ELSE 0 END AS esg_linked_flag
FROM wide"""


CUBE_POOL = f"{TYPED} i:is_selected exclusion_reason exclusion_detail"


def _cube_sql(portfolio_type):
    return f"""
SELECT facility_id, tranche_id, branch_id, facility_id || '_' || tranche_id AS file_tranche, '{portfolio_type}' AS portfolio_type,
  STRFTIME(signing_date, '%Y-%m-%d') AS signing_date, CAST(base_amount AS DOUBLE) AS base_amount, CAST(eligible_amount AS DOUBLE) AS eligible_amount,
  CAST(allocated_amount AS DOUBLE) AS allocated_amount, ROUND(pool_share::DOUBLE, 7) AS pool_share, ROUND(cumulative_share::DOUBLE, 7) AS cumulative_share,
  CAST(is_selected AS BIGINT) AS is_selected, reason AS exclusion_reason, detail AS exclusion_detail
FROM portfolio"""


def selected_from_cube(t, portfolio_type):
    """The main path in one run: wide cube, feature marks, selection."""
    facilities = selection.cube_facilities(wide_rows(t, staged=True), portfolio_type)
    # the selection reads its facilities several times: from here on they are a table
    facilities = materialize(facilities, "facilities")
    corporate = "1" if portfolio_type == "corporate_loan" else "0"
    sheet = t.sheet.withColumn("corporate_loan_flag", F.when(F.col("limit_type") == "portfolio_type", corporate).otherwise(F.col("corporate_loan_flag")))
    return selection.select_pool(facilities, sheet, t.relation)


@query("cube_selection", _cube_sql("corporate_loan"), recursive=True, instead={"facility": _cube_facility("reg_rating", "reg_rating_ordinal")})
def cube_selection(t):
    return project(selected_from_cube(t, "corporate_loan").portfolio, CUBE_POOL)


@query("cube_selection_projects", _cube_sql("project_finance"), recursive=True, instead={
    "facility": _cube_facility("internal_rating", "internal_ordinal"),
    "based": CTES["based"].replace("Corporate Facilities", "Project Finance"),
    "row_limited": CTES["row_limited"].replace("group_rating", "rating_letter")})
def cube_selection_projects(t):
    return project(selected_from_cube(t, "project_finance").portfolio, CUBE_POOL)
