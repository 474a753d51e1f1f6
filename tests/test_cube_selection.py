"""From the wide table to a selected pool, and the tables of one run."""

import pytest
from pyspark.sql import functions as F

from poolwright import GRAIN
from poolwright.plans import cube, selection
from poolwright.sinks import writers
from poolwright.workload import literals as L
from poolwright.workload.enrichment import cube_sources
from poolwright.workload.tables import Tables

DATA = "/root/testdata/sf0.001"
DATES = {"snapshot_date": L.VALUE_DATE, "risk_date": L.VALUE_DATE, "provision_date": L.VALUE_DATE}


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, DATA)


@pytest.fixture(scope="module")
def wide(tables):
    return cube.wide_cube(cube_sources(tables), L.VALUE_DATE, DATES).cache()


def test_one_row_per_facility(wide):
    assert wide.groupBy(*GRAIN).count().filter("count > 1").count() == 0
    assert wide.count() > 0


@pytest.mark.parametrize("kind", ["corporate_loan", "project_finance"])
def test_flags_read_the_rating_of_the_portfolio(wide, kind):
    flagged = selection.flag_facilities(wide, portfolio_type=kind)
    column = {"corporate_loan": "reg_rating", "project_finance": "internal_rating"}[kind]
    for r in flagged.select(column, "non_ig_flag", "bei_flag", "agency_guaranteed").collect():
        assert r.non_ig_flag == 0 if str(r[column]).startswith(("A", "BBB")) else True
        assert r.bei_flag == int((r.agency_guaranteed or 0) != 0)


def test_sources_are_checked_by_name(tables):
    s = cube_sources(tables)
    s.operations = s.operations.withColumn("signing_date", F.lit("not a date").cast("binary"))
    with pytest.raises(Exception, match="signing_date"):
        cube.wide_cube(s, L.VALUE_DATE, DATES).count()


def test_sources_are_left_as_they_are(tables):
    s = cube_sources(tables)
    before = dict(vars(s))
    cube.wide_cube(s, L.VALUE_DATE, DATES)
    assert all(vars(s)[k] is v for k, v in before.items())


def test_a_facility_with_two_rows_is_refused(wide, tables):
    facilities = selection.cube_facilities(wide, "corporate_loan")
    with pytest.raises(ValueError, match="more than one row"):
        selection.select_pool(facilities.union(facilities), tables.sheet, tables.relation)


def test_tables_of_a_run_are_dated_written_and_read_back(spark, wide, tables, tmp_path):
    constants = selection.pool_constants(tables.sheet, wide, "reg_lgd", selection.cost_income(tables.cost_income), {"tax_rate": 0.3})
    for kind, day in (("corporate_loan", "1998-05-31"), ("corporate_loan", "1998-06-30"), ("corporate_loan", "1998-06-30")):
        chosen = selection.select_pool(selection.cube_facilities(wide, kind), tables.sheet, tables.relation, constants)
        selection.write_selection(chosen, str(tmp_path), day)
    for name in selection.OUTPUTS:
        back = writers.read_history(spark, str(tmp_path), name)
        assert {str(r[0]) for r in back.select("closing_date").distinct().collect()} == {"1998-05-31", "1998-06-30"}
        mine = getattr(chosen, name)
        assert back.filter("closing_date = '1998-06-30'").count() == mine.count() > 0 or name == "excluded"
    assert {r.constant_type for r in writers.read_current(spark, str(tmp_path), "constants").collect()} >= {"tax_rate", "lgd", "ci_ratio"}


def test_cost_income_takes_the_home_office_at_the_newest_cutoff(spark):
    rows = [("2024-01-01", "GF", "ESPAÑA", 0.1), ("2024-02-01", "GF", " ESPAÑA ", 0.2), ("2024-02-01", "GF", "MEXICO", 0.3), ("2024-02-01", "XX", "ESPAÑA", 0.4)]
    df = spark.createDataFrame(rows, "cutoff_date string, area_id string, office_desc string, ratio double")
    assert selection.cost_income(df).first()[0] == 0.2


def test_ledger_rows_and_long_ids_are_not_sorted_as_they_are(tables):
    """The cube needs no steps of the ledger, and joins on contract ids compare their digests first."""
    plan = cube.wide_cube(cube_sources(tables), L.VALUE_DATE, DATES)._jdf.queryExecution().optimizedPlan().toString()
    assert "distance" not in plan and "side#" not in plan
    assert plan.count("(_digest#") >= 4


def test_staged_joins_leave_the_same_cube_and_no_relations(spark, wide, tables):
    """The joins with all relations run one after the other; what is left to run has none of them."""
    from pathlib import Path

    from poolwright.session import Run

    with (run := Run(spark)):
        staged = cube.wide_cube(cube_sources(tables), L.VALUE_DATE, DATES, staged=True)
        kept = {p.name.rsplit("-", 1)[0] for p in Path(run.folder).iterdir()}
    assert kept >= {"econ-capital", "reg-capital", "provisions", "guarantees", "marked"} and "relations" not in kept
    assert "_digest#" not in staged._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, staged.collect())) == sorted(map(str, wide.select(*staged.columns).collect()))
    run.drop()
