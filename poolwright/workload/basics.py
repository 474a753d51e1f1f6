"""Queries over single operators: scans, projections, filters, joins, aggregations, windows."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from poolwright import GRAIN
from poolwright.functions import codes
from poolwright.functions import exprs as E
from poolwright.operators import dedupe, lookups
from poolwright.plans import examples
from poolwright.sinks.writers import align_schema
from poolwright.sources import limit_sheets, snapshots
from poolwright.workload import literals as L
from poolwright.workload.registry import query
from poolwright.workload.spec import project, sql_columns
from poolwright.workload.sql_tables import CTES, case, in_list, letter, non_ig, ordinal, pad, text

# --- snapshots ---

CTES["dated_orders"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(20,4)) AS total,
       CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS closing_date FROM orders"""


def dated_orders(t):
    return t.raw("orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(20,4)").alias("total"),
        F.trunc("o_orderdate", "month").alias("closing_date"))


@query("latest_snapshot", "SELECT STRFTIME(MAX(closing_date), '%Y-%m-%d') AS closing_date FROM dated_orders")
def latest_snapshot(t):
    return project(snapshots.latest_snapshot(dated_orders(t), "closing_date"), "d:closing_date")


@query("latest_snapshot_filtered",
       "SELECT STRFTIME(MAX(closing_date), '%Y-%m-%d') AS closing_date FROM dated_orders WHERE o_orderstatus IN ('F') AND total > 400000")
def latest_snapshot_filtered(t):
    where = F.col("o_orderstatus").isin("F") & (F.col("total") > 400000)
    return project(snapshots.latest_snapshot(dated_orders(t), "closing_date", where), "d:closing_date")


@query("common_snapshot_date", """
SELECT STRFTIME(MIN(d), '%Y-%m-%d') AS value_date FROM (
  SELECT MAX(closing_date) AS d FROM dated_orders WHERE o_orderstatus = 'O'
  UNION ALL SELECT MAX(ship_date) FROM lines WHERE l_returnflag = 'A')""")
def common_snapshot_date(t):
    return project(snapshots.common_snapshot_date([
        (dated_orders(t), "closing_date", F.col("o_orderstatus") == "O"),
        (t.lines, "ship_date", F.col("l_returnflag") == "A"),
    ]), "d:value_date")


@query("has_snapshot", """
SELECT STRFTIME(w.closing_date, '%Y-%m-%d') AS closing_date,
       EXISTS (SELECT 1 FROM dated_orders d WHERE d.closing_date = w.closing_date) AS present
FROM (SELECT DISTINCT CAST(DATE_TRUNC('month', l_shipdate) AS DATE) AS closing_date FROM lineitem) w""")
def has_snapshot(t):
    wanted = t.raw("lineitem").select(F.trunc("l_shipdate", "month").alias("closing_date")).distinct()
    return project(snapshots.snapshot_presence(dated_orders(t), "closing_date", wanted), "d:closing_date b:present")


SCAN = "i:o_orderkey i:o_custkey o_orderstatus m:total d:closing_date"


@query("snapshot_scan", f"""
SELECT {sql_columns(SCAN)} FROM dated_orders WHERE closing_date = (SELECT MAX(closing_date) FROM dated_orders)""")
def snapshot_scan(t):
    return project(snapshots.scan_latest(dated_orders(t), "closing_date"), SCAN)


SHEET_SPEC = ("i:rule_id name_list_desc d:limit_date limit_type concept1_desc concept1_value concept2_desc "
              "concept2_value limit_value corporate_loan_flag project_finance_flag limit_scope i:visual_order")


@query("limits_snapshot", f"""
SELECT {sql_columns(SHEET_SPEC)} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY {', '.join(codes.LIMIT_KEY)} ORDER BY limit_date DESC, rule_id) AS place
  FROM sheet_history WHERE name_list_desc = 'List 3') WHERE place = 1""")
def limits_snapshot(t):
    return project(limit_sheets.select_sheet(t.sheet_history, scenario="List 3"), SHEET_SPEC)


# --- projections ---

RENAMES = {"o_orderkey": "contract_no", "o_custkey": "customer_no", "not_there": "ignored"}
RENAMED = "i:contract_no i:customer_no o_orderstatus f:o_totalprice"


@query("rename_map", """
SELECT CAST(o_orderkey AS BIGINT) AS contract_no, CAST(o_custkey AS BIGINT) AS customer_no,
       o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders""")
def rename_map(t):
    return project(lookups.rename_known(t.raw("orders"), RENAMES), RENAMED)


CLEAN = "contract_id m:econ_ead m:econ_loss r:econ_pd"


@query("sentinel_clean", f"""
SELECT {sql_columns(CLEAN)} FROM (
  SELECT contract_id, econ_loss,
         CASE WHEN econ_ead = {codes.MISSING_AMOUNT} THEN 0 ELSE econ_ead END AS econ_ead,
         CASE WHEN econ_pd = {codes.MISSING_PERCENT} THEN 0 ELSE econ_pd END AS econ_pd
  FROM econ_capital)""")
def sentinel_clean(t):
    return project(E.clean_sentinels(t.econ_capital, ["econ_ead", "econ_loss"], ["econ_pd"]), CLEAN)


CTES["rated"] = f"SELECT customer_id, CASE WHEN customer_id LIKE '%7' THEN ' ' || internal_rating || ' ' WHEN customer_id LIKE '%3' THEN 'odd' ELSE internal_rating END AS letter FROM customer_ratings"


def rated(t):
    name = F.col("internal_rating")
    return t.customer_ratings.select("customer_id", F.when(F.col("customer_id").endswith("7"), F.concat(F.lit(" "), name, F.lit(" ")))
                                     .when(F.col("customer_id").endswith("3"), "odd").otherwise(name).alias("letter"))


@query("rating_ordinal", f"""
SELECT customer_id, letter, CAST(COALESCE(o, -1) AS BIGINT) AS ordinal, CAST(CASE WHEN o <= 10 THEN 1 ELSE 0 END AS BIGINT) AS investment_grade
FROM (SELECT *, {ordinal('letter')} AS o FROM rated)""")
def rating_ordinal(t):
    df = rated(t).withColumn("o", E.rating_ordinal(F.col("letter")))
    df = df.withColumns({"ordinal": F.coalesce("o", F.lit(-1)), "investment_grade": E.investment_grade(F.col("o"))})
    return project(df, "customer_id letter i:ordinal i:investment_grade")


@query("rating_pairs", f"""
SELECT DISTINCT CAST({ordinal('letter')} AS BIGINT) AS ordinal, TRIM(letter) AS letter FROM rated WHERE {ordinal('letter')} IS NOT NULL""")
def rating_pairs(t):
    pairs = rated(t).select(E.rating_ordinal(F.col("letter")).alias("ordinal"), F.trim("letter").alias("letter"))
    return project(pairs.filter(F.col("ordinal").isNotNull()).distinct().orderBy("ordinal"), "i:ordinal letter")


SIGNS = "facility_id tranche_id movement_type m:movement_amount m:var_total m:var_drawn m:runoff d:start_date"
SQL_EFFECTS = f"""
 CASE WHEN movement_type IN {in_list(codes.TOTAL_REDUCTIONS)} THEN -base_eur WHEN movement_type = '{codes.TOTAL_INCREASE}' THEN base_eur ELSE 0 END AS var_total,
 CASE WHEN movement_type IN {in_list(codes.DRAWN_INCREASES)} THEN base_eur WHEN movement_type IN {in_list(codes.DRAWN_REDUCTIONS)} THEN -base_eur ELSE 0 END AS var_drawn,
 CASE WHEN movement_type IN {in_list(codes.TOTAL_REDUCTIONS)} THEN amount_eur ELSE 0 END AS runoff,
 CASE WHEN movement_type IN {in_list(codes.DATED_BY_END)} THEN end_date ELSE start_date END AS start_date"""


@query("movement_signs", f"""
SELECT {sql_columns(SIGNS)} FROM (
  SELECT facility_id, tranche_id, movement_type, movement_amount, {SQL_EFFECTS}
  FROM (SELECT *, base_amount AS base_eur, movement_amount AS amount_eur FROM movements))""")
def movement_signs(t):
    df = t.movements.withColumns({
        **E.movement_effects("movement_type", "base_amount", "movement_amount"),
        "start_date": E.effective_date("movement_type", "start_date", "end_date")})
    return project(df, SIGNS)


@query("movement_filter", f"""
SELECT facility_id, tranche_id, branch_id, movement_class, COUNT(*) AS n, CAST(SUM(movement_amount) AS DOUBLE) AS amount
FROM movements WHERE movement_class IN {in_list(codes.BALANCE_CLASSES)} GROUP BY ALL""")
def movement_filter(t):
    from poolwright.operators.ledger import balance_movements

    kept = balance_movements(t.movements).groupBy(*GRAIN, "movement_class").agg(
        F.count(F.lit(1)).alias("n"), F.sum("movement_amount").alias("amount"))
    return project(kept, "facility_id tranche_id branch_id movement_class i:n m:amount")


FX_SPEC = "contract_id currency m:econ_ead m:econ_ead_eur r:fx"


@query("fx_convert", f"""
SELECT {sql_columns(FX_SPEC)} FROM (
  SELECT contract_id, c.currency, econ_ead, econ_ead * COALESCE(fx, 1) AS econ_ead_eur, COALESCE(fx, 1) AS fx
  FROM (SELECT *, CASE entity_id WHEN 'MX' THEN 'MXN' WHEN 'ES' THEN 'EUR' END AS currency FROM econ_capital) c
  LEFT JOIN fx ON c.currency = fx.currency)""")
def fx_convert(t):
    df = t.econ_capital.withColumn("currency", E.entity_currency(F.col("entity_id")))
    return project(lookups.convert_currency(df, t.fx, {"econ_ead": "econ_ead_eur"}, keep_original=True), FX_SPEC)


RATIOS = ("facility_id tranche_id branch_id r:exchange_rate m:total_ccy m:total_eur r:econ_capital_ratio "
          "r:reg_capital_ratio r:risk_weight r:econ_loss_ratio r:reg_loss_ratio")


@query("risk_ratios", f"""
SELECT {sql_columns(RATIOS)} FROM (
  SELECT facility_id, tranche_id, branch_id,
   CAST(funded_ccy AS DOUBLE) / NULLIF(CAST(funded_eur AS DOUBLE), 0) AS exchange_rate,
   funded_ccy + available_ccy AS total_ccy, funded_eur + available_eur AS total_eur,
   CAST(available_eur AS DOUBLE) / NULLIF(CAST(commitment AS DOUBLE), 0) AS econ_capital_ratio,
   CAST(available_eur AS DOUBLE) / NULLIF(CAST(funded_eur AS DOUBLE), 0) AS reg_capital_ratio,
   12.5::DOUBLE * (CAST(available_eur AS DOUBLE) / NULLIF(CAST(funded_eur AS DOUBLE), 0)) AS risk_weight,
   CAST(funded_eur AS DOUBLE) / NULLIF(CAST(commitment AS DOUBLE), 0) AS econ_loss_ratio,
   CAST(commitment AS DOUBLE) / NULLIF(CAST(funded_eur AS DOUBLE), 0) AS reg_loss_ratio
  FROM balances)""")
def risk_ratios(t):
    named = t.balances.withColumns({
        "nominal_ccy": F.col("funded_ccy"), "nominal_eur": F.col("funded_eur"),
        "econ_ead": F.col("commitment"), "reg_ead": F.col("funded_eur"), "econ_capital": F.col("available_eur"),
        "reg_capital": F.col("available_eur"), "econ_loss": F.col("funded_eur"), "reg_loss": F.col("commitment")})
    return project(named.withColumns(E.risk_ratios()), RATIOS)


CTES["gaps"] = """
SELECT facility_id, tranche_id, branch_id, group_rating,
       CASE WHEN sector <> 'PROMO' THEN sector END AS sector,
       CASE WHEN bei_flag = 0 THEN reg_ead END AS reg_ead,
       CASE WHEN esg_linked_flag = 1 THEN TRUE END AS marked FROM facility"""


def gaps(t):
    return t.facility.select(
        *GRAIN, "group_rating", F.when(F.col("sector") != "PROMO", F.col("sector")).alias("sector"),
        F.when(F.col("bei_flag") == 0, F.col("reg_ead")).alias("reg_ead"),
        F.when(F.col("esg_linked_flag") == 1, F.lit(True)).alias("marked"))


@query("typed_fill", f"""
SELECT facility_id, tranche_id, branch_id, COALESCE(group_rating, '{codes.UNRATED}') AS group_rating,
       COALESCE(sector, '{codes.UNKNOWN_TEXT}') AS sector, CAST(COALESCE(reg_ead, 0) AS DOUBLE) AS reg_ead,
       COALESCE(marked, FALSE) AS marked FROM gaps""")
def typed_fill(t):
    filled = E.typed_fill(gaps(t), overrides={"group_rating": codes.UNRATED, "marked": False})
    return project(filled, "facility_id tranche_id branch_id group_rating sector m:reg_ead b:marked")


@query("coalesce_cascade", """
SELECT o.facility_id, o.tranche_id, o.branch_id, COALESCE(o.insured_type, h.v, z.v) AS insured_type
FROM operations o
LEFT JOIN (SELECT facility_id, MIN(insured_type) AS v FROM operations WHERE financial_product = 'Multitranche' GROUP BY 1) h ON o.facility_id = h.facility_id
LEFT JOIN (SELECT facility_id, MIN(insured_type) AS v FROM operations WHERE tranche_id = '3' GROUP BY 1) z ON o.facility_id = z.facility_id""")
def coalesce_cascade(t):
    ops = t.operations
    out = lookups.cascade(ops, "facility_id", "insured_type", [
        ops.filter(F.col("financial_product") == "Multitranche"), ops.filter(F.col("tranche_id") == "3")])
    return project(out, "facility_id tranche_id branch_id insured_type")


@query("condition_flags", """
SELECT contract_id, ROUND(CAST(rw AS DOUBLE), 6) AS reg_rw, COALESCE(100 * rw <= 100, TRUE) AS sts_rw_condition
FROM (SELECT contract_id, CASE WHEN reg_lgd <> 0.1 THEN reg_rw END AS rw FROM reg_capital)""")
def condition_flags(t):
    df = t.reg_capital.withColumn("reg_rw", F.when(F.col("reg_lgd") != F.lit("0.1").cast("decimal(9,6)"), F.col("reg_rw")))
    return project(df.withColumn("sts_rw_condition", E.within_full_weight(F.col("reg_rw"))),
                   "contract_id r:reg_rw b:sts_rw_condition")


@query("key_parts", """
SELECT contract_id, SUBSTR(contract_id, 1, 2) AS entity_id, SUBSTR(contract_id, 11, 26) AS contract_tail,
       facility_id || '_' || tranche_id || '_' || branch_id AS facility_key FROM relations""")
def key_parts(t):
    df = t.relations.withColumns({**E.contract_parts(F.col("contract_id")), "facility_key": E.grain_key(*GRAIN)})
    return project(df, "contract_id entity_id contract_tail facility_key")


@query("non_ig_flag", f"SELECT customer_id, internal_rating, CAST({non_ig('internal_rating')} AS BIGINT) AS non_ig_flag FROM customer_ratings")
def non_ig_flag(t):
    letter_col = F.col("internal_rating")
    flag = E.non_investment_flag(E.rating_ordinal(letter_col), letter_col)
    return project(t.customer_ratings.withColumn("non_ig_flag", flag), "customer_id internal_rating i:non_ig_flag")


FLAGS = ["ico_flag", "non_ig_flag", "building_project_flag", "workout_flag", "sts_payment_flag", "sts_rw_flag",
         "esg_linked_flag", "bei_flag"]
FLAG_SPEC = "facility_id tranche_id branch_id " + " ".join(f"i:{f}" for f in FLAGS)


@query("feature_flags", f"""
SELECT facility_id, tranche_id, branch_id,
 CAST(CASE WHEN TRIM(purpose) = '{codes.PUBLIC_AGENCY_PURPOSE}' THEN 1 ELSE 0 END AS BIGINT) AS ico_flag,
 CAST({non_ig('letter')} AS BIGINT) AS non_ig_flag,
 CAST(CASE WHEN TRIM(construction_type) = 'S' THEN 1 ELSE 0 END AS BIGINT) AS building_project_flag,
 CAST(CASE WHEN TRY_CAST(TRIM(watch_list) AS INTEGER) <> 0 THEN 1 ELSE 0 END AS BIGINT) AS workout_flag,
 CAST(CASE WHEN sts_payment THEN 1 ELSE 0 END AS BIGINT) AS sts_payment_flag,
 CAST(CASE WHEN sts_rw THEN 1 ELSE 0 END AS BIGINT) AS sts_rw_flag,
 CAST(CASE WHEN tranche_id = '2' THEN 1 ELSE 0 END AS BIGINT) AS esg_linked_flag,
 CAST(CASE WHEN COALESCE(bei, 0) <> 0 THEN 1 ELSE 0 END AS BIGINT) AS bei_flag
FROM (SELECT o.*, {letter('CAST(facility_id AS BIGINT) + CAST(tranche_id AS BIGINT)')} AS letter,
  CASE WHEN com_product = 'Project Finance' THEN ' S' ELSE 'N' END AS construction_type,
  CASE tranche_id WHEN '1' THEN ' 1 ' WHEN '2' THEN '0' WHEN '3' THEN 'a' END AS watch_list,
  financial_product = 'RCF' AS sts_payment, currency <> 'USD' AS sts_rw,
  CASE WHEN currency = 'MXN' THEN 100 WHEN currency = 'EUR' THEN 0 END AS bei FROM operations o)""")
def feature_flags(t):
    from poolwright.workload.tables import letter as letter_at

    rating = letter_at(F.col("facility_id").cast("long") + F.col("tranche_id").cast("long"))
    df = t.operations.withColumns({
        "rating_letter": rating, "rating_ordinal": E.rating_ordinal(rating),
        "construction_type": F.when(F.col("com_product") == "Project Finance", " S").otherwise("N"),
        "watch_list": E.lookup({"1": " 1 ", "2": "0", "3": "a"}, F.col("tranche_id")),
        "sts_payment_condition": F.col("financial_product") == "RCF",
        "sts_rw_condition": F.col("currency") != "USD",
        "esg_linked": F.when(F.col("tranche_id") == "2", 1).otherwise(0),
        "bei_guaranteed": F.when(F.col("currency") == "MXN", 100).when(F.col("currency") == "EUR", 0),
    })
    return project(df.withColumns(E.feature_flags()), FLAG_SPEC)


@query("parse_locale_decimal", """
SELECT CAST(rule_id AS BIGINT) AS rule_id, limit_value,
       TRY_CAST(REPLACE(REPLACE(TRIM(limit_value), '.', ''), ',', '.') AS DOUBLE) AS parsed FROM sheet_history""")
def parse_locale_decimal(t):
    df = t.sheet_history.withColumn("parsed", E.parse_locale_decimal(F.col("limit_value")))
    return project(df, "i:rule_id limit_value f:parsed")


@query("parse_flexible_date", """
SELECT CAST(rule_id AS BIGINT) AS rule_id, limit_date_text,
 STRFTIME(CASE WHEN LENGTH(runs) = 3 THEN CASE WHEN LENGTH(runs[1]) = 4 THEN TRY_CAST(runs[1] || '-' || runs[2] || '-' || runs[3] AS DATE)
      ELSE TRY_CAST(runs[3] || '-' || runs[2] || '-' || runs[1] AS DATE) END END, '%Y-%m-%d') AS parsed
FROM (SELECT rule_id, limit_date_text, REGEXP_EXTRACT_ALL(limit_date_text, '[0-9]+') AS runs FROM sheet_history)""")
def parse_flexible_date(t):
    df = t.sheet_history.withColumn("parsed", E.parse_flexible_date(F.col("limit_date_text")))
    return project(df, "i:rule_id limit_date_text d:parsed")


@query("avg_term", """
SELECT facility_id, tranche_id, branch_id,
       ROUND(COALESCE(DATE_DIFF('day', signing_date, m) / 365.0::DOUBLE, 0), 6) AS avg_term
FROM (SELECT *, CASE WHEN tranche_id <> '4' THEN expiry_date END AS m FROM operations)""")
def avg_term(t):
    maturity = F.when(F.col("tranche_id") != "4", F.col("expiry_date"))
    df = t.operations.withColumn("avg_term", E.average_term(maturity, F.col("signing_date")))
    return project(df, "facility_id tranche_id branch_id r:avg_term")


@query("row_hash", """
SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_returnflag,
       SHA256(CONCAT_WS('||', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), l_returnflag)) AS hash
FROM lineitem""")
def row_hash(t):
    df = t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    df = df.withColumn("hash", E.row_hash(df.columns))
    return project(df, "i:l_orderkey i:l_linenumber l_returnflag hash")


@query("threshold_flag", """
SELECT CAST(event_id AS BIGINT) AS event_id, CAST(CASE WHEN v <= 25 THEN 0 ELSE 1 END AS BIGINT) AS high
FROM (SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS v FROM events)""")
def threshold_flag(t):
    value = F.when(F.col("event_type") != "error", F.col("value"))
    return project(t.raw("events").withColumn("high", E.threshold_flag(value, 25)), "i:event_id i:high")


# --- example job and small ETL ---

CTES["clients"] = """
SELECT CAST(c_custkey AS VARCHAR) AS client_id, c_name AS name, 18 + c_custkey % 50 AS age, c_mktsegment AS province,
       CASE WHEN c_acctbal > 0 THEN 'true' ELSE 'false' END AS vip FROM customer"""
CTES["client_contracts"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS contract_id, CAST(o_custkey AS VARCHAR) AS holder_id,
       CAST(o_orderkey % (SELECT COUNT(*) FROM part) AS BIGINT) AS product_id, STRFTIME(o_orderdate, '%Y-%m-%d') AS opened FROM orders"""
CTES["products"] = "SELECT p_partkey AS product_id, p_name AS product_name FROM part"
CTES["joined_clients"] = """
SELECT c.contract_id, c.product_id, c.opened, p.product_name, k.client_id, k.name, k.age, k.province, k.vip
FROM client_contracts c JOIN (SELECT * FROM clients WHERE age BETWEEN 30 AND 50 AND vip = 'true') k ON c.holder_id = k.client_id
     JOIN products p ON c.product_id = p.product_id"""
JOINED = "contract_id i:product_id opened product_name client_id name i:age province vip"


def clients(t):
    return t.raw("customer").select(
        F.col("c_custkey").cast("string").alias("client_id"), F.col("c_name").alias("name"),
        (18 + F.col("c_custkey") % 50).alias("age"), F.col("c_mktsegment").alias("province"),
        F.when(F.col("c_acctbal") > 0, "true").otherwise("false").alias("vip"))


def client_contracts(t):
    products = t.raw("part").count()  # footer row counts only
    return t.raw("orders").select(
        F.col("o_orderkey").cast("string").alias("contract_id"), F.col("o_custkey").cast("string").alias("holder_id"),
        (F.col("o_orderkey") % products).alias("product_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("opened"))


def products(t):
    return t.raw("part").select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"))


@query("range_filter", "SELECT client_id, name, CAST(age AS BIGINT) AS age, province, vip FROM clients WHERE age BETWEEN 30 AND 50 AND vip = 'true'")
def range_filter(t):
    return project(examples.vip_clients(clients(t)), "client_id name i:age province vip")


@query("broadcast_join", f"SELECT {sql_columns(JOINED)} FROM joined_clients")
def broadcast_join(t):
    return project(examples.contracts_of_clients(examples.vip_clients(clients(t)), client_contracts(t), products(t)), JOINED)


@query("sql_filter_having", f"""
SELECT {sql_columns(JOINED)} FROM joined_clients WHERE client_id IN (SELECT client_id FROM joined_clients GROUP BY client_id HAVING COUNT(*) > 3)""")
def sql_filter_having(t):
    joined = examples.contracts_of_clients(examples.vip_clients(clients(t)), client_contracts(t), products(t))
    return project(examples.busy_clients(joined), JOINED)


@query("clients_contracts_job", f"""
SELECT {sql_columns(JOINED)}, SHA256(CONCAT_WS('||', contract_id, CAST(product_id AS VARCHAR), opened, product_name, client_id, name, CAST(age AS VARCHAR), province, vip)) AS hash
FROM joined_clients WHERE client_id IN (SELECT client_id FROM joined_clients GROUP BY client_id HAVING COUNT(*) > 3)""")
def clients_contracts_job(t):
    return project(examples.clients_contracts(clients(t), client_contracts(t), products(t)), JOINED + " hash")


@query("distinct_names", "SELECT DISTINCT name FROM joined_clients")
def distinct_names(t):
    joined = examples.contracts_of_clients(examples.vip_clients(clients(t)), client_contracts(t), products(t))
    return joined.select("name").distinct()


CTES["people"] = """
SELECT c_name AS name, 15 + c_custkey % 40 AS age, CASE WHEN c_nationkey % 6 <> 0 THEN n_name END AS city,
       CASE WHEN c_custkey % 17 <> 0 THEN STRFTIME(o_orderdate, '%Y-%m-%d') END AS date
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""


def people(t):
    nation = t.raw("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    customer = t.raw("customer").join(nation, "c_nationkey")
    key = F.col("c_custkey")
    return t.raw("orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderdate").join(customer, "c_custkey").select(
        F.col("c_name").alias("name"), (15 + key % 40).alias("age"),
        F.when(F.col("c_nationkey") % 6 != 0, F.col("n_name")).alias("city"),
        F.when(key % 17 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"))


PEOPLE = "name i:age city d:date i:day i:month i:year"


@query("clean_and_date_parts", """
SELECT name, CAST(age AS BIGINT) AS age, city, date, DAY(CAST(date AS DATE)) AS day, MONTH(CAST(date AS DATE)) AS month, YEAR(CAST(date AS DATE)) AS year
FROM people WHERE city IS NOT NULL AND date IS NOT NULL""")
def clean_and_date_parts(t):
    return project(examples.clean_with_date_parts(people(t)), PEOPLE)


@query("size_by_period", """
SELECT CAST(YEAR(CAST(date AS DATE)) AS BIGINT) AS year, city, COUNT(*) AS n
FROM people WHERE city IS NOT NULL AND date IS NOT NULL AND age > 18 GROUP BY 1, 2""")
def size_by_period(t):
    return project(examples.size_by_period(people(t), min_age=18, by_city=True), "i:year city i:n")


# --- joins ---

CTES["settled"] = f"SELECT DISTINCT facility_id, tranche_id, branch_id FROM movements WHERE payment_state IN {in_list(codes.SETTLED_STATES)} AND movement_class IN {in_list(codes.PAYMENT_CLASSES)}"


def settled(t):
    return t.movements.filter(
        F.col("payment_state").isin(codes.SETTLED_STATES) & F.col("movement_class").isin(codes.PAYMENT_CLASSES))


@query("payment_made_flag", """
SELECT o.facility_id, o.tranche_id, o.branch_id, s.facility_id IS NOT NULL AS payment_made
FROM operations o LEFT JOIN settled s ON o.facility_id = s.facility_id AND o.tranche_id = s.tranche_id AND o.branch_id = s.branch_id""")
def payment_made_flag(t):
    out = lookups.existence_flag(t.operations, settled(t), GRAIN, "payment_made")
    return project(out, "facility_id tranche_id branch_id b:payment_made")


COUNTRY_ROLES = {"project_country_id": "project_country", "customer_country_id": "customer_country"}


@query("country_lookup", f"""
SELECT o.facility_id, o.tranche_id, o.branch_id, p.country_name AS project_country, c.country_name AS customer_country, g.country_desc AS home_country
FROM (SELECT *, {pad('CAST(facility_id AS BIGINT) % 27', 2)} AS customer_country_id FROM operations) o
LEFT JOIN countries p ON o.project_country_id = p.country_id LEFT JOIN countries c ON o.customer_country_id = c.country_id
LEFT JOIN (SELECT * FROM (VALUES ('{L.HOME}', 'Spain'), ('{L.ABROAD}', 'Mexico')) v(entity_id, country_desc)) g ON o.entity_id = g.entity_id""")
def country_lookup(t):
    from poolwright.sources.files import literal_dimension
    from poolwright.workload.tables import pad as pad_col

    ops = t.operations.withColumn("customer_country_id", pad_col(F.col("facility_id").cast("long") % 27, 2))
    homes = literal_dimension(t.spark, {L.HOME: "Spain", L.ABROAD: "Mexico"}, "home_id", "home_name")
    out = lookups.role_lookup(ops, t.countries, "country_id", "country_name", COUNTRY_ROLES)
    out = lookups.role_lookup(out, homes, "home_id", "home_name", {"entity_id": "home_country"})
    return project(out, "facility_id tranche_id branch_id project_country customer_country home_country")


@query("taxonomy_hop", """
SELECT DISTINCT c.golden_customer_id, c.activity_id, u.to_value AS subsector_code, k.to_value AS sector_code,
       ut.description AS subsector_desc, kt.description AS sector_desc
FROM customers c
LEFT JOIN taxonomy_relation u ON c.activity_id = u.from_value AND u.to_catalogue = 'C164'
LEFT JOIN taxonomy_relation k ON c.activity_id = k.from_value AND k.to_catalogue = 'C162'
LEFT JOIN taxonomy_values ut ON ut.catalogue = 'C164' AND ut.value = u.to_value
LEFT JOIN taxonomy_values kt ON kt.catalogue = 'C162' AND kt.value = k.to_value""".replace(
    "taxonomy_relation u", "(SELECT DISTINCT * FROM taxonomy_relation) u").replace(
    "taxonomy_relation k", "(SELECT DISTINCT * FROM taxonomy_relation) k").replace(
    "taxonomy_values ut", "(SELECT DISTINCT * FROM taxonomy_values) ut").replace(
    "taxonomy_values kt", "(SELECT DISTINCT * FROM taxonomy_values) kt"))
def taxonomy_hop(t):
    customers = t.customers.select("golden_customer_id", "activity_id").distinct()
    out = lookups.taxonomy_hop(customers, t.taxonomy_relation, t.taxonomy_values, "activity_id")
    return project(out, "golden_customer_id activity_id subsector_code sector_code subsector_desc sector_desc")


# --- dedupe, windows, profiles ---

HISTORY_KEY = ["name_list_desc", "limit_type", "concept1_value"]


@query("latest_per_key", f"""
SELECT name_list_desc, limit_type, concept1_value, STRFTIME(limit_date, '%Y-%m-%d') AS limit_date, limit_value, CAST(rule_id AS BIGINT) AS rule_id FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY {', '.join(HISTORY_KEY)} ORDER BY limit_date DESC, rule_id DESC) AS place FROM sheet_history) WHERE place = 1""")
def latest_per_key(t):
    out = dedupe.keep_first(t.sheet_history, HISTORY_KEY, [F.desc("limit_date"), F.desc("rule_id")])
    return project(out, "name_list_desc limit_type concept1_value d:limit_date limit_value i:rule_id")


@query("top1_per_key", "SELECT branch_id, entity_id, MAX(entity_product) AS entity_product FROM branches GROUP BY branch_id, entity_id")
def top1_per_key(t):
    return project(dedupe.keep_first(t.branches, ["branch_id", "entity_id"], [F.desc("entity_product")]),
                   "branch_id entity_id entity_product")


@query("duplicate_keys", f"""
SELECT {', '.join(HISTORY_KEY)}, COUNT(*) AS n FROM sheet_history WHERE active_flag = 1 GROUP BY ALL HAVING COUNT(*) > 1""")
def duplicate_keys(t):
    dup = dedupe.duplicate_keys(t.sheet_history.filter(F.col("active_flag") == 1), HISTORY_KEY)
    return project(dup, "name_list_desc limit_type concept1_value i:n")


@query("null_profile", """
SELECT * FROM (
 SELECT 'group_rating' AS column_name, COUNT(group_rating) AS non_null FROM gaps UNION ALL
 SELECT 'sector', COUNT(sector) FROM gaps UNION ALL SELECT 'reg_ead', COUNT(reg_ead) FROM gaps UNION ALL
 SELECT 'marked', COUNT(marked) FROM gaps UNION ALL SELECT 'nothing', 0)""")
def null_profile(t):
    df = gaps(t).drop(*GRAIN).withColumn("nothing", F.lit(None).cast("string"))
    return project(dedupe.null_profile(df), "column_name i:non_null")


TARGET = T.StructType([
    T.StructField("o_orderkey", T.StringType()), T.StructField("o_totalprice", T.DecimalType(18, 1)),
    T.StructField("o_orderdate", T.DateType()), T.StructField("absent", T.StringType())])


@query("align_schema", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey,
       CAST(CAST(CAST(o_totalprice AS DECIMAL(20,2)) AS DECIMAL(18,1)) AS DOUBLE) AS o_totalprice,
       STRFTIME(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS o_orderdate FROM orders""")
def align_schema_query(t):
    df = t.raw("orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(20,2)").alias("o_totalprice"), "o_orderdate")
    return project(align_schema(df, TARGET), "o_orderkey i:o_custkey f:o_totalprice d:o_orderdate")
