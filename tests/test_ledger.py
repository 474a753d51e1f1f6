from datetime import date
from decimal import Decimal as D

from pyspark.sql import functions as F

from poolwright.contracts import CONTRACTS
from poolwright.operators import ledger

MOVES = CONTRACTS["movements"]


def day(text):
    return date.fromisoformat(text)


def move(kind, start, amount, end=None, klass="Drawdown", currency="EUR", signing="2024-01-15", expiry="2025-01-15", facility="1"):
    return (facility, "2", "A", "E", currency, day(signing), day(expiry), klass, kind, "Settled",
            day(start), day(end or start), D(amount), D(amount))


def evolve(spark, rows, value_date):
    fx = spark.createDataFrame([("EUR", D(1)), ("USD", D("0.914244"))], CONTRACTS["fx"])
    moves = ledger.balance_movements(spark.createDataFrame(rows, MOVES))
    return ledger.balance_evolution(ledger.signed_movements(moves, fx), value_date)


def test_untyped_movement_gives_bridge_and_step_of_zero(spark):
    rows = [move("Schedule 1", "2024-02-01", 100, currency="USD")]
    out = evolve(spark, rows, "2024-01-15").orderBy("start_date").collect()
    assert [(r.start_date, r.end_date) for r in out] == [
        (day("2024-01-15"), day("2024-02-01")), (day("2024-02-01"), day("2025-01-15"))]
    for r in out:
        assert {r.var_total, r.var_drawn, r.runoff, r.var_total_cum, r.var_drawn_cum, r.runoff_cum} == {D(0)}


def test_both_sides_of_the_value_date(spark):
    rows = [
        move("Term Loan Drawdown", "2024-02-01", 100),
        move("Term Loan Drawdown", "2024-03-01", 40),
        move("Authorized Amount Increase", "2024-03-01", 10, klass="Authorized Amount Increase"),
        move("Term Loan Repayment", "2024-05-20", 30, end="2024-06-01", klass="Repayment of Principal"),
        move("Term Loan Repayment", "2024-07-01", 20, klass="Repayment of Principal"),
        move("Whatever", "2024-07-01", 999, klass="Fees"),
    ]
    out = evolve(spark, rows, "2024-03-15")
    before = ledger.evolution_part(out, "before").orderBy("end_date").collect()
    assert [(r.start_date, r.end_date, r.var_drawn, r.var_drawn_cum, r.var_total_cum) for r in before] == [
        (day("2024-01-15"), day("2024-02-01"), -100, -140, -10),
        (day("2024-02-01"), day("2024-03-01"), -40, -40, -10)]
    after = ledger.evolution_part(out, "after").orderBy("start_date").collect()
    # a repayment is dated by its end
    assert [(r.start_date, r.end_date, r.var_total, r.var_total_cum, r.runoff, r.runoff_cum) for r in after] == [
        (day("2024-06-01"), day("2024-07-01"), -30, -30, 30, 30),
        (day("2024-07-01"), day("2025-01-15"), -20, -50, 20, 50)]
    bridge = ledger.evolution_part(out, "bridge").collect()
    assert [(r.start_date, r.end_date) for r in bridge] == [(day("2024-03-01"), day("2024-06-01"))]


def test_missing_rate_counts_as_one(spark):
    rows = [move("Term Loan Drawdown", "2024-02-01", 100, currency="JPY"),
            move("Term Loan Drawdown", "2024-02-01", 100, currency="USD", facility="9")]
    out = ledger.evolution_part(evolve(spark, rows, "2024-01-31"), "after")
    got = {r.facility_id: r.var_drawn for r in out.collect()}
    assert got == {"1": D(100), "9": D("91.4244")}


def test_runoff_profile_fixture(spark):
    rows = [("1", "2", "A", day("2024-02-01"), 20.0), ("1", "2", "A", day("2024-03-01"), 30.0),
            ("1", "3", "B", day("2024-04-01"), 40.0), ("1", "3", "B", day("2024-01-31"), 7.0),
            ("1", "4", "B", day("2024-04-01"), 0.0)]
    df = spark.createDataFrame(rows, "facility_id string, tranche_id string, branch_id string, start_date date, runoff double")
    out = {r.tranche_id: r for r in ledger.runoff_profile(df, "2024-01-31").collect()}
    assert (out["2"].runoff_total, out["2"].runoff_y0, out["2"].avg_maturity) == (50.0, 50.0, day("2024-02-18"))
    assert (out["3"].runoff_total, out["3"].avg_maturity) == (40.0, day("2024-04-01"))
    assert round(out["2"].runoff_day_sum / 100) == 369467 and round(out["3"].runoff_day_sum / 100) == 295591
    assert all(out["2"][f"runoff_y{n}"] == 0 for n in range(1, 11))
    assert out["4"].avg_maturity is None


def test_ledger_join_uses_four_keys(spark):
    items = spark.createDataFrame([("1", "2", "A", "B"), ("2", "3", "C", "D")],
                                  "facility_id string, tranche_id string, entity_id string, branch_id string")
    out = ledger.ledger_join(items, items.withColumn("amount", F.when(F.col("facility_id") == "1", 100).otherwise(200)))
    assert {(r.facility_id, r.amount) for r in out.collect()} == {("1", 100), ("2", 200)}


def test_one_shuffle_after_the_daily_rollup(spark):
    plan = evolve(spark, [move("Term Loan Drawdown", "2024-02-01", 100)], "2024-01-31")
    text = plan._jdf.queryExecution().executedPlan().toString()
    by_facility = [line for line in text.splitlines() if "Exchange hashpartitioning(facility_id" in line]
    assert len(by_facility) == 2  # the roll-up and the windows


def test_run_off_after_the_value_date_is_summed_without_steps(spark):
    late = {"signing": "2024-09-01"}
    rows = [
        move("Term Loan Repayment", "2024-02-01", 500, klass="Repayment of Principal", **late),  # before the value date, whatever the signing date
        move("Term Loan Repayment", "2024-06-01", 30, klass="Repayment of Principal", **late),
        move("Term Loan Repayment", "2024-06-05", 30, klass="Repayment of Principal", **late),
        move("Term Loan Repayment", "2024-07-01", 70, klass="Repayment of Principal", facility="9")]
    fx = spark.createDataFrame([("EUR", D(1))], CONTRACTS["fx"])
    signed = ledger.signed_movements(ledger.balance_movements(spark.createDataFrame(rows, MOVES)), fx)
    balances = spark.createDataFrame([("1", "2", "A", "E"), ("1", "2", "A", "E"), ("9", "2", "A", "F")], "facility_id string, tranche_id string, branch_id string, entity_id string")
    out = ledger.average_maturity(signed, balances, "2024-03-15")
    assert [(r.facility_id, r.runoff_total, r.avg_maturity) for r in out.collect()] == [("1", D(60), day("2024-06-03"))]
