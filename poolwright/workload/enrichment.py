"""Queries over the ledger, risk, customer, guarantee and cube operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from poolwright import GRAIN
from poolwright.functions import codes
from poolwright.operators import customers as C
from poolwright.operators import guarantees as G
from poolwright.operators import ledger, risk
from poolwright.operators.lookups import range_band
from poolwright.plans import cube
from poolwright.workload import literals as L
from poolwright.workload.basics import SQL_EFFECTS
from poolwright.workload.registry import query
from poolwright.workload.spec import project, sql_columns
from poolwright.workload.sql_tables import CTES, case, in_list, ordinal

KEY = "facility_id, tranche_id, branch_id"
KEYS = "facility_id tranche_id branch_id"
DAY = f"DATE '{L.VALUE_DATE}'"


def on(a: str, b: str) -> str:
    return " AND ".join(f"{a}.{c} = {b}.{c}" for c in GRAIN)


# --- ledger ---

LEDGER_SPEC = f"{KEYS} entity_id movement_type m:movement_amount m:funded_eur d:start_date"


@query("ledger_join", f"""
SELECT {sql_columns(LEDGER_SPEC.replace(KEYS, '').replace('entity_id', ''))}, m.facility_id, m.tranche_id, m.branch_id, m.entity_id
FROM movements m JOIN (SELECT facility_id, tranche_id, branch_id, entity_id, funded_eur FROM balances) b
  ON {on('m', 'b')} AND m.entity_id = b.entity_id""")
def ledger_join(t):
    balances = t.balances.select(*GRAIN, "entity_id", "funded_eur")
    return project(ledger.ledger_join(t.movements, balances), LEDGER_SPEC)


CTES["signed"] = f"""
SELECT facility_id, tranche_id, branch_id, signing_date, expiry_date, {SQL_EFFECTS}
FROM (SELECT m.*, base_amount * COALESCE(fx, 1) AS base_eur, movement_amount * COALESCE(fx, 1) AS amount_eur
      FROM movements m LEFT JOIN fx ON m.currency = fx.currency
      WHERE movement_class IN {in_list(codes.BALANCE_CLASSES)})"""
_DAILY = f"""SELECT {KEY}, signing_date, expiry_date, start_date, SUM(var_total) AS var_total, SUM(var_drawn) AS var_drawn, SUM(runoff) AS runoff
FROM signed WHERE start_date {{}} {DAY} GROUP BY ALL"""
CTES["evo_before"] = f"""
SELECT {KEY}, signing_date, expiry_date,
       COALESCE(LAG(start_date) OVER (PARTITION BY {KEY} ORDER BY start_date), signing_date) AS start_date,
       -var_total AS var_total, -var_drawn AS var_drawn, runoff,
       SUM(-var_total) OVER w AS var_total_cum, SUM(-var_drawn) OVER w AS var_drawn_cum,
       start_date AS end_date, 0 AS runoff_cum
FROM ({_DAILY.format('<=')}) WINDOW w AS (PARTITION BY {KEY} ORDER BY start_date DESC RANGE UNBOUNDED PRECEDING)"""
CTES["evo_after"] = f"""
SELECT {KEY}, signing_date, expiry_date, start_date, var_total, var_drawn, runoff,
       SUM(var_total) OVER w AS var_total_cum, SUM(var_drawn) OVER w AS var_drawn_cum,
       COALESCE(LEAD(start_date) OVER (PARTITION BY {KEY} ORDER BY start_date), expiry_date) AS end_date,
       SUM(runoff) OVER w AS runoff_cum
FROM ({_DAILY.format('>')}) WINDOW w AS (PARTITION BY {KEY} ORDER BY start_date RANGE UNBOUNDED PRECEDING)"""
CTES["evo_bridge"] = f"""
SELECT f.facility_id, f.tranche_id, f.branch_id, f.signing_date, f.expiry_date,
       COALESCE(b.d, f.signing_date) AS start_date, 0 AS var_total, 0 AS var_drawn, 0 AS runoff,
       0 AS var_total_cum, 0 AS var_drawn_cum, COALESCE(a.d, f.expiry_date) AS end_date, 0 AS runoff_cum
FROM (SELECT DISTINCT {KEY}, signing_date, expiry_date FROM signed) f
LEFT JOIN (SELECT {KEY}, MAX(end_date) AS d FROM evo_before GROUP BY ALL) b ON {on('f', 'b')}
LEFT JOIN (SELECT {KEY}, MIN(start_date) AS d FROM evo_after GROUP BY ALL) a ON {on('f', 'a')}"""
CTES["evolution"] = " UNION ALL BY NAME ".join(f"SELECT * FROM evo_{p}" for p in ("before", "bridge", "after"))

EVO = (f"{KEYS} d:signing_date d:expiry_date d:start_date d:end_date m:var_total m:var_drawn m:runoff "
       "m:var_total_cum m:var_drawn_cum m:runoff_cum")


def evolution(t):
    moves = ledger.balance_movements(t.movements)
    return ledger.balance_evolution(ledger.signed_movements(moves, t.fx), L.VALUE_DATE)


@query("balance_evolution", f"SELECT {sql_columns(EVO)} FROM evolution")
def balance_evolution(t):
    return project(evolution(t), EVO)


def _part(part):
    @query(f"balance_{part}", f"SELECT {sql_columns(EVO)} FROM evo_{part}")
    def run(t):
        return project(ledger.evolution_part(evolution(t), part), EVO)


for _name in ("before", "after", "bridge"):
    _part(_name)

YEARS = int(L.VALUE_DATE[:4])
CTES["runoff_profile"] = f"""
SELECT *, CASE WHEN runoff_total > 0 THEN DATE '0001-01-01' + CAST(FLOOR(CAST(runoff_day_sum AS DOUBLE) / CAST(runoff_total AS DOUBLE)) AS INTEGER) - 1 END AS avg_maturity
FROM (SELECT {KEY}, SUM(runoff) AS runoff_total,
  SUM(runoff * (DATE_DIFF('day', DATE '0001-01-01', start_date) + 1)) AS runoff_day_sum,
  {', '.join(f"SUM(CASE WHEN YEAR(start_date) = {YEARS + n} THEN runoff ELSE 0 END) AS runoff_y{n}" for n in range(11))}
FROM evolution WHERE start_date > {DAY} GROUP BY ALL)"""
RUNOFF = f"{KEYS} m:runoff_total " + " ".join(f"m:runoff_y{n}" for n in range(11))


@query("runoff_by_year", f"SELECT {sql_columns(RUNOFF)} FROM runoff_profile")
def runoff_by_year(t):
    return project(ledger.runoff_profile(evolution(t), L.VALUE_DATE), RUNOFF)


@query("avg_maturity", f"SELECT {sql_columns(f'{KEYS} m:runoff_total d:avg_maturity')} FROM runoff_profile WHERE runoff_total > 0")
def avg_maturity(t):
    profile = ledger.runoff_profile(evolution(t), L.VALUE_DATE).filter(F.col("runoff_total") > 0)
    return project(profile, f"{KEYS} m:runoff_total d:avg_maturity")


# --- capital, provisions ---

ENTITY_CCY = "CASE entity_id WHEN 'MX' THEN 'MXN' WHEN 'ES' THEN 'EUR' END"


def _clean(column, marker):
    return f"CASE WHEN {column} = {marker} THEN 0 ELSE {column} END"


def _in_eur(source, amounts, percents):
    cleaned = ", ".join([f"{_clean(a, codes.MISSING_AMOUNT)} * COALESCE(fx, 1) AS {a}" for a in amounts]
                        + [f"{_clean(p, codes.MISSING_PERCENT)} AS {p}" for p in percents])
    return f"SELECT contract_id, {cleaned} FROM {source} s LEFT JOIN fx ON fx.currency = {ENTITY_CCY}"


def _wavg(v, w):
    return f"CAST(SUM({v} * {w}) AS DOUBLE) / NULLIF(CAST(SUM({w}) AS DOUBLE), 0)"


def _banded(sql, pd, prefix):
    return f"""SELECT x.*, b.short_letter AS {prefix}_short_letter, b.long_letter AS {prefix}_long_letter
FROM ({sql}) x LEFT JOIN bands b ON b.band_from <= 100 * {pd} AND 100 * {pd} < b.band_to"""


CTES["econ_facility"] = _banded(f"""
SELECT r.facility_id, r.tranche_id, r.branch_id, MAX(econ_ead) AS econ_ead, MAX(econ_loss) AS econ_loss,
       MAX(econ_capital) AS econ_capital, {_wavg('econ_pd', 'econ_ead')} AS econ_pd
FROM relations r LEFT JOIN ({_in_eur('econ_capital', ['econ_ead', 'econ_loss', 'econ_capital'], ['econ_pd'])}) c
  ON r.contract_id = c.contract_id GROUP BY ALL""", "econ_pd", "econ")
CTES["reg_facility"] = _banded(f"""
SELECT r.facility_id, r.tranche_id, r.branch_id, MAX(reg_ead) AS reg_ead, MAX(reg_capital) AS reg_capital,
       MAX(reg_loss) AS reg_loss, {_wavg('reg_pd', 'reg_ead')} AS reg_pd, {_wavg('reg_rw', 'reg_ead')} AS reg_rw, MAX(reg_lgd) AS reg_lgd
FROM relations r LEFT JOIN ({_in_eur('reg_capital', ['reg_ead', 'reg_capital', 'reg_loss'], ['reg_pd', 'reg_rw', 'reg_lgd'])}) c
  ON r.contract_id = c.contract_id GROUP BY ALL""", "reg_pd", "reg")
ECON = f"{KEYS} m:econ_ead m:econ_loss m:econ_capital r:econ_pd econ_short_letter econ_long_letter"
REG = f"{KEYS} m:reg_ead m:reg_capital m:reg_loss r:reg_pd r:reg_rw r:reg_lgd reg_short_letter reg_long_letter"


@query("capital_by_facility", f"SELECT {sql_columns(ECON)} FROM econ_facility")
def capital_by_facility(t):
    return project(risk.econ_capital_by_facility(t.econ_capital, t.relations, t.fx, t.bands), ECON)


@query("reg_capital_by_facility", f"SELECT {sql_columns(REG)} FROM reg_facility")
def reg_capital_by_facility(t):
    return project(risk.reg_capital_by_facility(t.reg_capital, t.relations, t.fx, t.bands), REG)


@query("pd_band_join", """
SELECT contract_id, ROUND(CAST(reg_pd AS DOUBLE), 6) AS reg_pd, short_letter, long_letter
FROM reg_capital LEFT JOIN bands ON band_from <= 100 * reg_pd AND 100 * reg_pd < band_to""")
def pd_band_join(t):
    out = range_band(t.reg_capital, t.bands, 100 * F.col("reg_pd"), ["short_letter", "long_letter"])
    return project(out, "contract_id r:reg_pd short_letter long_letter")


CTES["provision_facility"] = f"""
SELECT {KEY}, SUM({_clean('provision_amount', codes.MISSING_AMOUNT)} * COALESCE(fx, 1)) AS provision_amount, MAX(provision_stage) AS provision_stage
FROM relations r JOIN provisions p ON SUBSTR(r.contract_id, 1, 2) = p.entity_id AND SUBSTR(r.contract_id, 11, 26) = p.contract_tail
     AND SUBSTR(p.branch_code, 3, 4) = r.branch_id LEFT JOIN fx ON fx.currency = p.currency GROUP BY ALL"""
PROVISION = f"{KEYS} m:provision_amount i:provision_stage"


@query("provision_by_facility", f"SELECT {sql_columns(PROVISION)} FROM provision_facility")
def provision_by_facility(t):
    return project(risk.provision_by_facility(t.provisions, t.relations, t.fx), PROVISION)


CTES["watchlist"] = f"""
SELECT {case(codes.ENTITY_CUSTOMER_PREFIX, 'entity_id')} || local_customer_id AS customer_id, MAX(watch_list) AS watch_list
FROM provisions GROUP BY 1"""


@query("dedupe_subset", "SELECT customer_id, watch_list FROM watchlist")
def dedupe_subset(t):
    return risk.customer_watchlist(t.provisions)


RISK = (f"{KEYS} m:commitment m:econ_ead m:reg_ead r:reg_pd m:provision_amount econ_long_letter reg_long_letter")


@query("risk_enrich", f"""
SELECT {', '.join(f'b.{c}' for c in GRAIN)}, {sql_columns(RISK.replace(KEYS, ''))}
FROM (SELECT * FROM balances WHERE commitment > 0) b LEFT JOIN econ_facility e ON {on('b', 'e')}
LEFT JOIN reg_facility r ON {on('b', 'r')} LEFT JOIN provision_facility p ON {on('b', 'p')}""")
def risk_enrich(t):
    unified = cube.unified_risk(
        risk.econ_capital_by_facility(t.econ_capital, t.relations, t.fx, t.bands),
        risk.reg_capital_by_facility(t.reg_capital, t.relations, t.fx, t.bands),
        risk.provision_by_facility(t.provisions, t.relations, t.fx))
    kept = t.balances.filter(F.col("commitment") > 0).join(unified, GRAIN, "left")
    return project(kept, RISK)


CTES["sold"] = f"""
SELECT {KEY}, SUM(sold_percent) AS sold_percent, CASE WHEN COUNT(deal_id) > 0 THEN 'Y' ELSE 'N' END AS sold,
       MAX(deal_date) AS deal_date FROM prior_deals GROUP BY ALL"""
SOLD = f"{KEYS} m:sold_percent sold d:deal_date"


@query("sold_flag", f"SELECT {sql_columns(SOLD)} FROM sold")
def sold_flag(t):
    return project(risk.sold_share(t.prior_deals), SOLD)


# --- customers ---

CTES["best_members"] = f"""
SELECT * FROM (SELECT *, RANK() OVER (PARTITION BY customer_id ORDER BY relation_type) AS place FROM (
  SELECT DISTINCT * FROM members WHERE hierarchy_level IN {in_list(codes.GROUP_LEVELS)} AND relation_type IN {in_list(codes.GROUP_RELATIONS)}))
WHERE place = 1"""
CTES["master"] = f"""
SELECT c.*, l.customer_id, m.group_id, m.participant_header_type, g.group_country, TRIM(g.group_name) AS group_name,
       TRIM(g.group_full_name) AS group_full_name, {case(L.TIERS, 'g.tier_id')} AS tier_desc, {case(codes.SEGMENTS, 'g.segment_id')} AS segment_desc,
       SUBSTR(l.customer_id, 7, 9) AS local_customer_id
FROM (SELECT DISTINCT * FROM customers) c JOIN (SELECT DISTINCT * FROM links) l ON c.golden_customer_id = l.golden_customer_id
JOIN best_members m ON l.customer_id = m.customer_id LEFT JOIN (SELECT DISTINCT * FROM groups) g ON m.group_id = g.group_id"""
MASTER = ("golden_customer_id customer_id customer_name activity_id customer_country group_id participant_header_type "
          "group_country group_name group_full_name tier_desc segment_desc local_customer_id")


def master(t):
    return C.customer_master(t.customers, t.links, t.members, t.groups, L.TIERS)


@query("customer_master", f"SELECT {sql_columns(MASTER)} FROM master")
def customer_master(t):
    return project(master(t), MASTER)


@query("best_relation_rank", "SELECT customer_id, hierarchy_level, relation_type, group_id FROM best_members")
def best_relation_rank(t):
    return project(C.best_relations(t.members), "customer_id hierarchy_level relation_type group_id")


CTES["parent_rating"] = """
SELECT p.group_id, r.external_rating AS group_rating FROM (
  SELECT DISTINCT m.group_id, l.golden_customer_id FROM master m LEFT JOIN links l ON m.customer_id = l.customer_id
  WHERE m.participant_header_type = 'S') p
JOIN (SELECT golden_customer_id, MAX(external_rating) AS external_rating FROM external_ratings GROUP BY 1) r ON p.golden_customer_id = r.golden_customer_id"""


@query("group_parent_rating", "SELECT group_id, group_rating FROM parent_rating")
def group_parent_rating(t):
    return C.group_parent_rating(master(t), t.links, t.external_ratings)


# --- guarantees and marks ---

CTES["guaranteed"] = f"""
SELECT r.facility_id, r.tranche_id, r.branch_id, SUM(agency) AS agency_guaranteed, SUM(other) AS other_guaranteed
FROM relations r LEFT JOIN (
  SELECT contract_id, SUM(CASE WHEN by_agency THEN amount END) AS agency, SUM(CASE WHEN NOT by_agency THEN amount END) AS other
  FROM (SELECT a.contract_id, a.guaranteed_amount * COALESCE(fx, 1) AS amount,
               EXISTS (SELECT 1 FROM guarantee_board b JOIN agency_customers k ON b.customer_id = k.customer_id
                       WHERE b.guarantee_id = a.guarantee_id) AS by_agency
        FROM guarantee_assignments a LEFT JOIN fx ON a.currency = fx.currency
        WHERE begin_date <= cutoff_date AND cutoff_date <= end_date) GROUP BY 1) g ON r.contract_id = g.contract_id
GROUP BY ALL"""
GUARANTEED = f"{KEYS} m:agency_guaranteed m:other_guaranteed"


@query("guarantee_amounts", f"SELECT {sql_columns(GUARANTEED)} FROM guaranteed")
def guarantee_amounts(t):
    return project(G.guarantee_amounts(t.guarantee_assignments, t.guarantee_board, t.agency_customers, t.relations, t.fx), GUARANTEED)


CTES["esg"] = f"""
SELECT {KEY}, MAX(CASE WHEN m.contract_id IS NOT NULL THEN 1 ELSE 0 END) AS esg_linked
FROM relations r LEFT JOIN (SELECT DISTINCT contract_id FROM marks WHERE mark_id = '{codes.SUSTAINABILITY_MARK}') m ON r.contract_id = m.contract_id
WHERE relation_level = 'FACILITY' GROUP BY ALL"""


@query("any_flag", f"SELECT {KEY}, CAST(esg_linked AS BIGINT) AS esg_linked FROM esg")
def any_flag(t):
    return project(G.sustainability_flag(t.marks, t.relations), f"{KEYS} i:esg_linked")


# --- the wide cube ---

CUBE = (
    f"{KEYS} project_id project_sector_desc security_type syndication_type capital_adjustment project_score r:project_lgd d:rating_tool_date short_rating "
    "project_country customer_country group_country financial_product com_product purpose insured_type currency "
    "d:signing_date d:expiry_date b:sts_payment_condition b:sts_rw_condition customer_id group_id entity_id entity_name "
    "econ_rating reg_rating f:reg_rating_ordinal r:reg_pd r:reg_rw r:reg_lgd m:econ_ead m:reg_ead r:econ_pd "
    "sector_desc subsector_desc f:provision_stage m:provision_amount m:funded_ccy m:available_ccy m:funded_eur m:available_eur "
    "group_rating watch_list construction_type project_rating d:project_rating_date internal_rating f:internal_ordinal "
    "i:investment_grade sold q:sold_amount m:agency_guaranteed m:other_guaranteed r:avg_term f:esg_linked "
    "r:exchange_rate m:total_ccy m:total_eur r:econ_capital_ratio r:reg_capital_ratio r:risk_weight r:econ_loss_ratio r:reg_loss_ratio "
    "internal_rating_model f:guaranteed_ccy f:guaranteed_eur snapshot_date risk_date provision_date"
)


def cube_sources(t):
    return cube.CubeSources(
        operations=t.operations, balances=t.balances, branches=t.branches, movements=t.movements, fx=t.fx,
        relations=t.relations, econ_capital=t.econ_capital, reg_capital=t.reg_capital, bands=t.bands,
        provisions=t.provisions, customers=t.customers, links=t.links, members=t.members, groups=t.groups,
        taxonomy_relation=t.taxonomy_relation, taxonomy_values=t.taxonomy_values, countries=t.countries,
        external_ratings=t.external_ratings, accredited=t.accredited, accredited_tie_breaker="row_id",
        customer_ratings=t.customer_ratings, prior_deals=t.prior_deals,
        guarantee_assignments=t.guarantee_assignments, guarantee_board=t.guarantee_board,
        agency_customers=t.agency_customers, marks=t.marks, entities=t.entities, header_tranche="3")


_SPLIT = "SELECT DISTINCT from_value, to_value FROM taxonomy_relation WHERE from_catalogue = 'C039' AND to_catalogue = "
_TEXT = "SELECT DISTINCT value, description FROM taxonomy_values WHERE catalogue = "
CTES["cube_settled"] = f"SELECT DISTINCT {KEY} FROM movements WHERE payment_state IN {in_list(codes.SETTLED_STATES)} AND movement_class IN {in_list(codes.PAYMENT_CLASSES)}"
CTES["cube_runoff"] = f"""
SELECT {KEY}, SUM(runoff) AS runoff_total,
  DATE '0001-01-01' + CAST(FLOOR(CAST(SUM(runoff * (DATE_DIFF('day', DATE '0001-01-01', start_date) + 1)) AS DOUBLE) / CAST(SUM(runoff) AS DOUBLE)) AS INTEGER) - 1 AS avg_maturity
FROM (SELECT facility_id, tranche_id, branch_id, {SQL_EFFECTS}
  FROM (SELECT m.*, base_amount * COALESCE(fx, 1) AS base_eur, movement_amount * COALESCE(fx, 1) AS amount_eur
        FROM movements m JOIN (SELECT DISTINCT {KEY}, entity_id FROM operations) o ON {on('m', 'o')} AND m.entity_id = o.entity_id
        LEFT JOIN fx ON m.currency = fx.currency WHERE movement_class IN {in_list(codes.BALANCE_CLASSES)}))
WHERE start_date > {DAY} GROUP BY ALL HAVING SUM(runoff) > 0"""
CTES["cube_base"] = f"""
SELECT o.facility_id, o.tranche_id, o.branch_id, o.entity_id, o.currency, o.customer_id, o.signing_date, o.expiry_date, o.project_country_id,
  o.financial_product, o.com_product, o.purpose, o.project_id, o.project_sector_desc, o.security_type, o.syndication_type, COALESCE(o.insured_type, hd.v, tz.v) AS insured_type,
  b.funded_ccy, b.available_ccy, b.funded_eur, b.available_eur, b.commitment,
  COALESCE(e.econ_ead, 0) AS econ_ead, COALESCE(e.econ_loss, 0) AS econ_loss, COALESCE(e.econ_capital, 0) AS econ_capital, COALESCE(e.econ_pd, 0) AS econ_pd,
  COALESCE(e.econ_long_letter, '{codes.UNRATED}') AS econ_rating,
  COALESCE(r.reg_ead, 0) AS reg_ead, COALESCE(r.reg_capital, 0) AS reg_capital, COALESCE(r.reg_loss, 0) AS reg_loss,
  COALESCE(r.reg_pd, 0) AS reg_pd, COALESCE(r.reg_rw, 0) AS reg_rw, COALESCE(r.reg_lgd, 0) AS reg_lgd,
  COALESCE(r.reg_long_letter, '{codes.UNRATED}') AS reg_rating,
  COALESCE(p.provision_amount, 0) AS provision_amount, COALESCE(p.provision_stage, 0) AS provision_stage,
  COALESCE(DATE_DIFF('day', o.signing_date, rp.avg_maturity) / 365.0::DOUBLE, 0) AS avg_term
FROM operations o LEFT JOIN balances b ON {on('o', 'b')} AND o.entity_id = b.entity_id AND o.currency = b.currency
JOIN (SELECT DISTINCT branch_id, entity_id FROM branches) br ON o.branch_id = br.branch_id AND o.entity_id = br.entity_id
LEFT JOIN econ_facility e ON {on('o', 'e')} LEFT JOIN reg_facility r ON {on('o', 'r')} LEFT JOIN provision_facility p ON {on('o', 'p')}
LEFT JOIN cube_runoff rp ON {on('o', 'rp')}
LEFT JOIN (SELECT facility_id, MIN(insured_type) AS v FROM operations WHERE financial_product = 'Multitranche' GROUP BY 1) hd ON o.facility_id = hd.facility_id
LEFT JOIN (SELECT facility_id, MIN(insured_type) AS v FROM operations WHERE tranche_id = '3' GROUP BY 1) tz ON o.facility_id = tz.facility_id
WHERE b.commitment > 0"""
CTES["cube_accredited"] = f"""
SELECT {case(codes.LEDGER_ENTITY_CUSTOMER_PREFIX, 'ledger_entity')} || participant_id AS customer_id, construction_type, project_rating, rating_date AS project_rating_date, capital_adjustment, project_score, project_lgd
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY participant_id, ledger_entity ORDER BY rating_date DESC, register_date DESC, row_id DESC) AS place FROM accredited) WHERE place = 1"""
CTES["wide"] = f"""
SELECT x.*, pc.country_name AS project_country, cc.country_name AS customer_country, gc.country_name AS group_country, m.group_id, en.entity_name,
  {ordinal('x.reg_rating')} AS reg_rating_ordinal, COALESCE(w.watch_list, '0') AS watch_list,
  kt.description AS sector_desc, ut.description AS subsector_desc, pr.group_rating, a.construction_type, a.project_rating, a.project_rating_date,
  a.capital_adjustment, a.project_score, a.project_lgd, cr.short_rating, cr.rating_tool_date, cr.internal_rating, {ordinal('cr.internal_rating')} AS internal_ordinal,
  CASE WHEN {ordinal('cr.internal_rating')} <= 10 THEN 1 ELSE 0 END AS investment_grade,
  s.facility_id IS NOT NULL AS sts_payment_condition, COALESCE(100 * x.reg_rw <= 100, TRUE) AS sts_rw_condition,
  COALESCE(sc.sold, 'N') AS sold, COALESCE(CAST(CAST(sc.sold_percent AS DECIMAL(12,6)) * CAST(x.reg_ead AS DECIMAL(20,4)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(20,2)), 0) AS sold_amount,
  gu.agency_guaranteed, gu.other_guaranteed, es.esg_linked,
  CAST(x.funded_ccy AS DOUBLE) / NULLIF(CAST(x.funded_eur AS DOUBLE), 0) AS exchange_rate,
  x.funded_ccy + x.available_ccy AS total_ccy, x.funded_eur + x.available_eur AS total_eur,
  CAST(econ_capital AS DOUBLE) / NULLIF(CAST(econ_ead AS DOUBLE), 0) AS econ_capital_ratio,
  CAST(reg_capital AS DOUBLE) / NULLIF(CAST(reg_ead AS DOUBLE), 0) AS reg_capital_ratio,
  12.5::DOUBLE * (CAST(reg_capital AS DOUBLE) / NULLIF(CAST(reg_ead AS DOUBLE), 0)) AS risk_weight,
  CAST(econ_loss AS DOUBLE) / NULLIF(CAST(econ_ead AS DOUBLE), 0) AS econ_loss_ratio,
  CAST(reg_loss AS DOUBLE) / NULLIF(CAST(reg_ead AS DOUBLE), 0) AS reg_loss_ratio,
  'NA' AS internal_rating_model, 0 AS guaranteed_ccy, 0 AS guaranteed_eur,
  '{L.VALUE_DATE}' AS snapshot_date, '{L.VALUE_DATE}' AS risk_date, '{L.VALUE_DATE}' AS provision_date
FROM cube_base x
LEFT JOIN watchlist w ON x.customer_id = w.customer_id
LEFT JOIN (SELECT * FROM (SELECT customer_id, group_id, group_country, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY group_id NULLS LAST, group_country NULLS LAST) AS place FROM master)
           WHERE place = 1) m ON x.customer_id = m.customer_id
LEFT JOIN (SELECT * FROM (SELECT l.customer_id, c.customer_country, c.activity_id, ROW_NUMBER() OVER (PARTITION BY l.customer_id ORDER BY c.customer_country NULLS LAST, c.activity_id NULLS LAST) AS place
           FROM customers c LEFT JOIN links l ON c.golden_customer_id = l.golden_customer_id) WHERE place = 1) ca ON x.customer_id = ca.customer_id
LEFT JOIN ({_SPLIT} 'C164') u ON ca.activity_id = u.from_value LEFT JOIN ({_SPLIT} 'C162') k ON ca.activity_id = k.from_value
LEFT JOIN ({_TEXT} 'C164') ut ON u.to_value = ut.value LEFT JOIN ({_TEXT} 'C162') kt ON k.to_value = kt.value
LEFT JOIN countries pc ON x.project_country_id = pc.country_id LEFT JOIN countries cc ON ca.customer_country = cc.country_id
LEFT JOIN countries gc ON m.group_country = gc.country_id
LEFT JOIN (SELECT group_id, MIN(group_rating) AS group_rating FROM parent_rating GROUP BY 1) pr ON m.group_id = pr.group_id
LEFT JOIN cube_accredited a ON x.customer_id = a.customer_id LEFT JOIN customer_ratings cr ON x.customer_id = cr.customer_id
LEFT JOIN cube_settled s ON {on('x', 's')} LEFT JOIN sold sc ON {on('x', 'sc')}
LEFT JOIN guaranteed gu ON {on('x', 'gu')} LEFT JOIN esg es ON {on('x', 'es')} LEFT JOIN entities en ON x.entity_id = en.entity_id"""


@query("wide_cube", f"SELECT {sql_columns(CUBE)} FROM wide")
def wide_cube(t):
    dates = {"snapshot_date": L.VALUE_DATE, "risk_date": L.VALUE_DATE, "provision_date": L.VALUE_DATE}
    return project(cube.wide_cube(cube_sources(t), L.VALUE_DATE, dates, staged=True), CUBE)
