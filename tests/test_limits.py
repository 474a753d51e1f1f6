from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from poolwright.contracts import CONTRACTS
from poolwright.operators import allocation, eligibility, limits
from poolwright.plans import selection
from poolwright.session import literal_rows
from poolwright.sources.limit_sheets import read_limit_sheet, select_sheet
from poolwright.workload import literals as L

SHEET = CONTRACTS["limit_sheet"]
NAME, DATE = "escenario", "2024-11-11"


def rule(kind, value1, share, scope, value2=None, concept1="c", complex_limit=0, corp="1", active=1, when=DATE, place=5):
    return (NAME, when, kind, concept1, value1, "d" if value2 else None, value2, share, corp, "1", scope, active, place, complex_limit)


HEADER = [rule("portfolio_type", "total", 1.0, "portfolio"), rule("portfolio_size", "total", 2e9, "portfolio"),
          rule("ccf", "total", 0.5, "portfolio"), rule("risk_retention", "total", 0.2, "individual")]


def book_of(spark, rules):
    relation = literal_rows(spark, L.LIMIT_RELATION, L.LIMIT_RELATION_SCHEMA)
    resolved = limits.resolve_limits(spark.createDataFrame(HEADER + rules, SHEET), relation, "corporate_loan")
    return limits.rule_book(resolved)


FACILITY = ("facility_id string, tranche_id string, branch_id string, sector string, country string, group_rating string, "
            "rating_letter string, expiry_date date, bei_flag int, group_id string, base_amount decimal(20,4), currency string, financial_product string")


def facility(name, **values):
    base = {"sector": "S", "country": "C", "group_rating": "A", "rating_letter": "A", "expiry_date": None,
            "bei_flag": 0, "group_id": "g", "base_amount": D(100), "currency": "EUR", "financial_product": "P"}
    return (name, "0", "b", *{**base, **values}.values())


def shares(spark, rules, rows, name):
    out = eligibility.apply_row_limits(spark.createDataFrame(rows, FACILITY), book_of(spark, rules))
    return {r.facility_id: r[name] for r in out.collect()}


def test_resolved_values(spark):
    book = book_of(spark, [rule("maturity_min", "365", 0.0, "individual"), rule("bei", "1", 0.0, "individual"),
                           rule("group", "total", 0.0075, "portfolio")])
    assert book.pool_size == D(2_000_000_000)
    assert book.shares == {"ccf": 0.5, "risk_retention": 0.8}
    assert {s.name: (s.columns, s.scope) for s in book.specs} == {
        "risk_retention": (["reg_ead"], "row"), "maturity_min": (["expiry_date"], "row"),
        "bei": (["bei_flag"], "row"), "group": (["group_id"], "pool")}


def test_one_column_rules(spark):
    rules = [rule("rating_sp", "B", 0.0, "individual"), rule("rating_sp", "C", 0.5, "individual"),
             rule("rating_sp", "C", 0.25, "individual", corp="0")]  # a repeated rule never multiplies rows
    rows = [facility("b", group_rating="B"), facility("c", group_rating="C"), facility("a"), facility("n", group_rating=None)]
    assert shares(spark, rules, rows, "limit_rating_sp") == {"b": 0.0, "c": 0.25, "a": 1.0, "n": 1.0}
    out = eligibility.apply_row_limits(spark.createDataFrame(rows, FACILITY), book_of(spark, rules))
    notes = {r.facility_id: (r.limits_applied, r.exclusion_limits) for r in out.collect()}
    assert notes["b"] == ("rating_sp,risk_retention", "rating_sp") and notes["a"] == ("risk_retention", "")


TWO = [rule("geo_sector", "S", 0.0, "individual", "C", complex_limit=1),
       rule("geo_sector", "T", 0.5, "individual", "total", complex_limit=1),
       rule("geo_sector", "total", 0.25, "individual", "X", complex_limit=1)]


def padding(kind, n, **more):
    """Rules that match nothing, to make a list long."""
    return [rule(kind, f"none{i}", 0.9, "individual", **more) for i in range(n)]


def test_two_column_rules_with_wildcards(spark):
    rows = [facility("sc"), facility("t", sector="T"), facility("x", country="X"), facility("tx", sector="T", country="X"),
            facility("other", sector="U"), facility("null", country=None), facility("tnull", sector="T", country=None)]
    expected = {"sc": 0.0, "t": 0.5, "x": 0.25, "tx": 0.25, "other": 1.0, "null": 0.0, "tnull": 0.5}
    assert shares(spark, TWO, rows, "limit_geo_sector") == expected
    assert shares(spark, TWO + padding("geo_sector", 80, value2="none", complex_limit=1), rows, "limit_geo_sector") == expected


@pytest.mark.parametrize("n", [1, 2, 64, 65, 300])
def test_the_number_of_rules_decides_nothing_but_a_lone_total(spark, n):
    """Rules (value, total): a missing second column gets the limit's share for nulls, unless there is one rule only."""
    rules = [rule("geo_sector", f"S{i}", 0.25, "individual", "total", complex_limit=1) for i in range(n)]
    rows = [facility("hit", sector="S0", country=None), facility("miss", sector="Q", country=None), facility("full", sector="Q")]
    assert shares(spark, rules, rows, "limit_geo_sector") == {"hit": 0.25, "miss": 1.0 if n == 1 else 0.0, "full": 1.0}


@pytest.mark.parametrize("n", [0, 1, 64, 300])
def test_one_column_total(spark, n):
    rules = [rule("rating_sp", "total", 0.5, "individual"), rule("rating_sp", "total", 0.25, "individual")] + padding("rating_sp", n)
    rows = [facility("a"), facility("null", group_rating=None)]
    wanted = {"a": 0.25, "null": 0.25} if n == 0 else {"a": 1.0, "null": 1.0}
    assert shares(spark, rules, rows, "limit_rating_sp") == wanted


@pytest.mark.parametrize("seed", range(3))
def test_short_and_long_lists_agree(spark, seed):
    import random

    rng = random.Random(seed)
    pick = lambda values: rng.choice(values)
    rules = [rule("geo_sector", pick(["A", "B", "total"]), pick([0.0, 0.2, 0.5]), "individual", pick(["X", "Y", "total"]), complex_limit=1) for _ in range(rng.randint(2, 6))]
    rows = [facility(f"f{i}", sector=pick(["A", "B", "C", None]), country=pick(["X", "Y", "Z", None])) for i in range(40)]
    short = [*rules, rule("geo_sector", "none", 0.9, "individual", "none", complex_limit=1)]
    long_ = rules + padding("geo_sector", 150, value2="none", complex_limit=1)
    by_hand = {}
    for name, _, _, sector, country, *_ in rows:
        found = [r[7] for r in rules if r[4] in ("total", sector) and r[6] in ("total", country)]
        by_hand[name] = min(found) if found else 0.0 if country is None else 1.0
    assert shares(spark, short, rows, "limit_geo_sector") == shares(spark, long_, rows, "limit_geo_sector") == by_hand


def test_long_exclusion_list_is_joined(spark):
    rules = [rule("excluded_facilities", f"f{i}", 0.0, "individual") for i in range(200)]
    rows = [facility("f3"), facility("f500")]
    assert shares(spark, rules, rows, "limit_excluded_facilities") == {"f3": 0.0, "f500": 1.0}


@pytest.mark.parametrize("kind,expected", [("maturity_min", {"in": 0.1, "on": 1.0, "out": 1.0, "null": 0.0}),
                                           ("maturity_max", {"in": 1.0, "on": 1.0, "out": 0.1, "null": 0.0})])
def test_maturity_limits_compare_dates(spark, kind, expected):
    from datetime import date

    rows = [facility("in", expiry_date=date(2024, 11, 20)), facility("on", expiry_date=date(2024, 11, 21)),
            facility("out", expiry_date=date(2024, 11, 22)), facility("null")]
    assert shares(spark, [rule(kind, "10", 0.1, "individual")], rows, f"limit_{kind}") == expected


@pytest.mark.parametrize("kind,expected", [("maturity_min", {"a": 0.1, "b": 0.4, "c": 1.0, "null": 0.0}),
                                           ("maturity_max", {"a": 1.0, "b": 0.4, "c": 0.1, "null": 0.0})])
@pytest.mark.parametrize("more", [0, 90])
def test_all_maturity_rules_of_a_limit_count(spark, kind, expected, more):
    from datetime import date

    rows = [facility("a", expiry_date=date(2024, 11, 15)), facility("b", expiry_date=date(2024, 12, 1)),
            facility("c", expiry_date=date(2026, 1, 1)), facility("null")]
    short, long_ = ("10", "100") if kind == "maturity_min" else ("100", "10")
    rules = [rule(kind, short, 0.1, "individual"), rule(kind, long_, 0.4, "individual")]
    rules += [rule(kind, str((100 if kind == "maturity_min" else 10) + 0 * i), 0.5 + i / 1000, "individual") for i in range(more)]
    assert shares(spark, rules, rows, f"limit_{kind}") == expected
    pool = [rule(kind, short, 0.1, "portfolio"), rule(kind, long_, 0.4, "portfolio")]
    limited = allocation.with_pool_limits(spark.createDataFrame(rows, FACILITY), book_of(spark, pool), {})
    got = {r.facility_id: r.limits[0].allowed_units / 1e7 for r in limited.collect()}
    assert got == {**expected, "null": 0.1}


def test_eligible_amount_with_pool_basis(spark):
    book = book_of(spark, [rule("rating_rga_esl", "BB", 0.00000001 * 2, "individual"), rule("rating_rga_esl", "D", 0.0, "individual")])
    book.pool_size = D(1_000_000_000)
    book_rows = [facility("free"), facility("capped", rating_letter="BB"), facility("zero", rating_letter="D"),
                 facility("negative", base_amount=D(-5))]
    limited = eligibility.apply_row_limits(spark.createDataFrame(book_rows, FACILITY), book)
    got = {r.facility_id: (r.eligible_amount, r.excluded, r.is_candidate, r.exclusion_reason)
           for r in eligibility.eligible_amount(limited, book).collect()}
    assert got["free"] == (D(80), 0, 1, "NA")
    assert got["zero"] == (D(0), 1, 0, "row limit 0")
    assert got["negative"] == (D(-4), 0, 0, "base amount 0")
    variant = {r.facility_id: r.eligible_amount for r in eligibility.eligible_amount_mincap(limited, book).collect()}
    assert variant["free"] == D(80) and variant["zero"] == 0


def test_universe_falls_back_to_total(spark):
    book = book_of(spark, [rule("group", "g1", 0.01, "portfolio"), rule("group", "total", 0.05, "portfolio"),
                           rule("sts_group", "1", 0.02, "portfolio", "g2", complex_limit=1)])
    rows = [facility("a", group_id="g1"), facility("b", group_id="g2"), facility("n", group_id=None)]
    limited = allocation.with_pool_limits(spark.createDataFrame(rows, FACILITY), book)
    got = {(r.limit_type, r.limit_value): r.allowed_share for r in allocation.limit_universe(limited, book.pool_size).collect()}
    assert got == {("group", "g1"): 0.01, ("group", "g2"): 0.05, ("group", "None"): 0.05, ("sts_group", "g1"): 1.0,
                   ("sts_group", "g2"): 0.02, ("sts_group", "None"): 1.0, ("divisa", "EUR"): 1.0, ("financial_product", "P"): 1.0}


def test_a_currency_rule_of_the_sheet_is_the_tracked_limit(spark):
    book = book_of(spark, [rule("divisa", "USD", 0.1, "portfolio")])
    limited = allocation.with_pool_limits(spark.createDataFrame([facility("a")], FACILITY), book)
    assert [x.limit_type for x in limited.first().limits] == ["divisa", "financial_product"]


def test_long_pool_rule_list_keeps_its_total(spark):
    rules = [rule("group", f"g{i}", 0.01, "portfolio") for i in range(100)] + [rule("group", "total", 0.05, "portfolio")]
    book = book_of(spark, rules)
    rows = [facility("a", group_id="g7"), facility("b", group_id="other")]
    limited = allocation.with_pool_limits(spark.createDataFrame(rows, FACILITY), book, {})
    got = {r.limit_value: r.allowed_share for r in allocation.limit_universe(limited, book.pool_size).collect()}
    assert got == {"g7": 0.01, "other": 0.05}


def test_active_limits(spark):
    sheet = [rule("sts", "0", 0.02, "individual", concept1="sts_flag"),
             rule("sts_group", "1", 0.02, "portfolio", "total", concept1="sts_flag"),
             rule("group", "total", 0.1, "portfolio", when="2024-01-01"), rule("group", "total", 0.2, "portfolio", when="2024-02-01"),
             rule("bei", "1", 0.0, "individual", active=0)]
    out = limits.active_limits(spark.createDataFrame(sheet, SHEET))
    assert {(r.limit_type, r.limit_value) for r in out.collect()} == {("sts", 0.02), ("group", 0.2)}
    on = [rule("sts", "1", 0.02, "individual", concept1="sts_flag"), *sheet[1:]]
    assert limits.active_limits(spark.createDataFrame(on, SHEET)).filter("limit_type = 'sts_group'").count() == 1


def test_header(spark):
    row = limits.portfolio_header(spark.createDataFrame(HEADER, SHEET)).first()
    assert (row.portfolio_type, row.limit_date, row.pool_size) == ("corporate_loan", DATE, 2e9)


def test_sheet_values_and_choice(spark):
    raw = spark.createDataFrame([("a", "2024-01-01", "1000,00", "2.000.000.000,0000")],
                                "list_name string, list_date string, x string, value_text string")
    names = {"list_name": "name_list_desc", "list_date": "limit_date", "value_text": "limit_value"}
    row = read_limit_sheet(raw, names).first()
    assert (row.name_list_desc, row.limit_date, row.limit_value, row.x) == ("a", "2024-01-01", 2e9, "1000,00")
    sheets = spark.createDataFrame([(*rule("group", "total", v, "portfolio", when=w), c) for v, w, c in
                                    ((0.1, "2024-01-01", "d1"), (0.2, "2024-03-01", "d2"), (0.3, "2024-02-01", "d3"))], SHEET + ", closing_date string")
    value = lambda df: [r.limit_value for r in df.collect()]
    assert value(select_sheet(sheets)) == [0.3]
    assert value(select_sheet(sheets, scenario=NAME)) == [0.2]
    assert value(select_sheet(sheets, scenario=NAME, limit_date="2024-01-01")) == [0.1]
    assert value(select_sheet(sheets, limit_date="2024-01-01")) == [0.2]


def test_product_filter(spark):
    df = spark.createDataFrame([("Corporate Facilities",), ("Project Finance",)], "com_product string")
    assert selection.product_facilities(df, "corporate_loan").count() == 1


def test_constants(spark):
    sheet = spark.createDataFrame([rule("constant_type", "total", 3.56, "portfolio", concept1="B")], SHEET)
    lgd = spark.createDataFrame([(0.4,), (0.5,), (None,)], "lgd double")
    ci = spark.createDataFrame([(0.7,)], "constant_value double")
    out = selection.pool_constants(sheet, lgd, "lgd", ci, {"tax_rate": 0.3})
    assert {r.constant_type: round(r.constant_value, 6) for r in out.collect()} == {
        "B": 3.56, "tax_rate": 0.3, "lgd": 0.45, "ci_ratio": 0.7}


def test_methods_of_the_eligible_amounts_are_compiled(spark):
    """The JVM interprets methods of more than 8000 bytes: lookups, amounts and what made the rows must not become one method."""
    import re

    from poolwright.plans import selection
    from poolwright.workload.selection import setup
    from poolwright.workload.tables import Tables

    facilities, book = setup(Tables(spark, "/root/testdata/sf0.001"))
    query = selection.eligible(facilities, book)._jdf.queryExecution()
    query.toRdd().count()
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(query.executedPlan()))]
    assert sizes and max(sizes) < 6000, sizes
