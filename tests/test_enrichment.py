import pytest
from datetime import date
from decimal import Decimal as D

from pyspark.sql import functions as F

from poolwright.contracts import CONTRACTS
from poolwright.operators import customers as C
from poolwright.operators import guarantees, lookups, risk

from poolwright.functions import codes

ES, MX = codes.ENTITY_CUSTOMER_PREFIX["ES"], codes.ENTITY_CUSTOMER_PREFIX["MX"]
FX = [("EUR", D(1)), ("MXN", D("0.05")), ("USD", D("0.85"))]
BANDS = [(0.0, 1.0, "S0", "L0"), (1.0, 10.0, "S1", "L1")]


def frame(spark, name, rows):
    return spark.createDataFrame(rows, CONTRACTS[name])


def relations(spark, *pairs, level="FACILITY"):
    return frame(spark, "relations", [(c, f, "0", "b", level) for c, f in pairs])


def test_currency_conversion_fixture(spark):
    fx = spark.createDataFrame([("USD", 0.85), ("EUR", 1.0)], "currency string, fx double")
    df = spark.createDataFrame([(1, "USD", 100.0), (2, "EUR", 200.0), (3, "JPY", 5.0)], "id int, currency string, amount double")
    out = lookups.convert_currency(df, fx, {"amount": "amount_eur"})
    assert out.columns == ["id", "currency", "amount_eur", "fx"]
    assert {tuple(r) for r in out.collect()} == {(1, "USD", 85.0, 0.85), (2, "EUR", 200.0, 1.0), (3, "JPY", 5.0, 1.0)}
    kept = lookups.convert_currency(df, fx, {"amount": "amount_eur"}, keep_original=True)
    assert set(kept.columns) == {"id", "currency", "amount", "amount_eur", "fx"}


def test_capital(spark):
    missing = D("999999999999999.99")
    rows = [("c1", "ES", D(100), D(1), D(10), D("0.005")), ("c2", "ES", D(300), D(2), D(20), D("0.02")),
            ("c3", "MX", D(1000), D(20), D(40), D("999.999999")), ("c4", "ES", missing, missing, missing, D("0.5")),
            ("c6", "ES", D(10), D(0), D(0), D("0.10"))]
    rel = relations(spark, ("c1", "f1"), ("c2", "f1"), ("c3", "f2"), ("c4", "f3"), ("c5", "f4"), ("c6", "f5"))
    out = risk.econ_capital_by_facility(frame(spark, "econ_capital", rows), rel, frame(spark, "fx", FX), frame(spark, "bands", BANDS))
    got = {r.facility_id: r for r in out.collect()}
    assert (got["f1"].econ_ead, got["f1"].econ_capital, got["f1"].econ_pd, got["f1"].econ_long_letter) == (300, 20, 0.01625, "L1")
    assert (got["f2"].econ_ead, got["f2"].econ_pd, got["f2"].econ_short_letter) == (50, 0.0, "S0")
    assert (got["f3"].econ_ead, got["f3"].econ_pd) == (0, None)          # zero exposure
    assert (got["f4"].econ_ead, got["f4"].econ_long_letter) == (None, None)  # relation without capital
    assert (got["f5"].econ_pd, got["f5"].econ_long_letter) == (0.10, None)   # outside every band


def test_provisions_and_watchlist(spark):
    tail = "T" * 26
    rows = [("00" + "0001", tail, "ES", D(10), 1, "000000001", "1", "EUR"), ("00" + "0001", tail, "ES", D(5), 3, "000000001", "0", "JPY"),
            ("00" + "0002", tail, "ES", D(99), 2, "000000002", "0", "EUR"),
            ("00" + "0001", tail, "MX", D("999999999999999.99"), 2, "000000001", "2", "EUR")]
    rel = frame(spark, "relations", [("ES" + "0000" + "0001" + tail, "f1", "0", "0001", "FACILITY"), ("MX" + "0000" + "0001" + tail, "f2", "0", "0001", "FACILITY")])
    prov = frame(spark, "provisions", rows)
    out = {r.facility_id: (r.provision_amount, r.provision_stage) for r in risk.provision_by_facility(prov, rel, frame(spark, "fx", FX)).collect()}
    assert out == {"f1": (15, 3), "f2": (0, 2)}
    marks = {r.customer_id: r.watch_list for r in risk.customer_watchlist(prov).collect()}
    assert marks == {ES + "000000001": "1", ES + "000000002": "0", MX + "000000001": "2"}


def test_sold_share(spark):
    rows = [("f", "0", "b", D("0.5"), 7, date(2024, 1, 1)), ("f", "0", "b", D("0.5"), 7, date(2024, 2, 1)),
            ("g", "0", "b", D("0.1"), None, date(2024, 1, 1))]
    out = {r.facility_id: tuple(r)[3:] for r in risk.sold_share(frame(spark, "prior_deals", rows)).collect()}
    assert out == {"f": (1, "Y", date(2024, 2, 1)), "g": (D("0.1"), "N", date(2024, 1, 1))}


def test_guarantees(spark):
    d = date
    rows = [("c1", "g1", "EUR", D(100), d(2024, 1, 1), d(2025, 1, 1), d(2024, 6, 1)),
            ("c1", "g2", "USD", D(100), d(2024, 1, 1), d(2025, 1, 1), d(2024, 6, 1)),
            ("c1", "g3", "EUR", D(999), d(2023, 1, 1), d(2024, 1, 1), d(2024, 6, 1)),  # expired
            ("c2", "g4", "EUR", D(7), d(2024, 6, 1), d(2024, 6, 1), d(2024, 6, 1))]    # no guarantor
    board = frame(spark, "guarantee_board", [("g1", "agency"), ("g1", "other"), ("g2", "other"), ("g2", "third")])
    agency = spark.createDataFrame([("agency",)], "customer_id string")
    rel = relations(spark, ("c1", "f1"), ("c2", "f1"), ("c9", "f9"))
    out = guarantees.guarantee_amounts(frame(spark, "guarantee_assignments", rows), board, agency, rel, frame(spark, "fx", FX))
    got = {r.facility_id: (r.agency_guaranteed, r.other_guaranteed) for r in out.collect()}
    assert got == {"f1": (100, 92), "f9": (None, None)}


def test_sustainability_flag(spark):
    rel = relations(spark, ("c1", "f1"), ("c2", "f1"), ("c3", "f2")).unionByName(relations(spark, ("c4", "f3"), level="CONTRACT"))
    marks = frame(spark, "marks", [("c1", "RBES"), ("c1", "RBES"), ("c3", "X"), ("c4", "RBES")])
    assert {r.facility_id: r.esg_linked for r in guarantees.sustainability_flag(marks, rel).collect()} == {"f1": 1, "f2": 0}


def test_customer_master(spark):
    customers = frame(spark, "customers", [("A1", "n", "act", "01")] * 2 + [("A2", "m", "act", "02")])
    links = frame(spark, "links", [("A1", ES + "000000001"), ("A2", ES + "000000002")])
    members = frame(spark, "members", [
        (ES + "000000001", "CP", "B", "G2", "N"), (ES + "000000001", "CP", "A", "G1", "S"),
        (ES + "000000002", "CC", "B", "G1", "N"), (ES + "000000002", "SC", "B", "G2", "N"),  # a tie stays
        (ES + "000000002", "XX", "A", "G3", "N"), (ES + "000000002", "CP", "Z", "G3", "N")])
    groups = frame(spark, "groups", [("G1", "01", " name ", " full ", "T1", "00005")])
    master = C.customer_master(customers, links, members, groups, {"T1": "Gold"})
    got = {(r.local_customer_id, r.group_id): (r.group_name, r.tier_desc, r.segment_desc) for r in master.collect()}
    assert got == {("000000001", "G1"): ("name", "Gold", "Corporate"), ("000000002", "G1"): ("name", "Gold", "Corporate"),
                   ("000000002", "G2"): (None, None, None)}
    ratings = spark.createDataFrame([("A1", "AA"), ("A1", "B+"), ("A2", "D")], "golden_customer_id string, external_rating string")
    assert [tuple(r) for r in C.group_parent_rating(master, links, ratings).collect()] == [("G1", "B+")]


def test_cascade_and_taxonomy(spark):
    df = spark.createDataFrame([("f1", None), ("f2", None), ("f3", "own")], "facility_id string, kind string")
    header = spark.createDataFrame([("f1", "head"), ("f1", "zed")], df.schema)
    tranche = spark.createDataFrame([("f1", "x"), ("f2", "tr"), ("f3", "x")], df.schema)
    out = {r.facility_id: r.kind for r in lookups.cascade(df, "facility_id", "kind", [header, tranche]).collect()}
    assert out == {"f1": "head", "f2": "tr", "f3": "own"}
    hop = spark.createDataFrame([("C039", "a", "C164", "u"), ("C039", "a", "C162", "k"), ("C000", "b", "C162", "k")],
                                CONTRACTS["taxonomy_relation"])
    texts = spark.createDataFrame([("C164", "u", "U text"), ("C162", "u", "wrong")], CONTRACTS["taxonomy_values"])
    acts = spark.createDataFrame([("a",), ("b",)], "activity string")
    got = {r.activity: (r.subsector_desc, r.sector_code, r.sector_desc) for r in lookups.taxonomy_hop(acts, hop, texts, "activity").collect()}
    assert got == {"a": ("U text", "k", None), "b": (None, None, None)}


def test_bands_of_any_number_equal_a_comparison_with_each(spark):
    import random

    rng = random.Random(1)
    for n in (0, 1, 7, 400):
        edges = sorted(rng.uniform(0, 1e4) for _ in range(n + 1))
        bands = [(lo, hi, f"s{i}", f"l{i}") for i, (lo, hi) in enumerate(zip(edges, edges[1:]))]
        values = [(i, v) for i, v in enumerate([None, -5.0, 2e4, *edges, *[rng.uniform(-10, 1.1e4) for _ in range(200)]])]
        df = spark.createDataFrame(values, "i int, v double")
        out = lookups.range_band(df, spark.createDataFrame(bands, CONTRACTS["bands"]), F.col("v"), ["short_letter"])
        wanted = {(i, next((s for lo, hi, s, _ in bands if v is not None and lo <= v < hi), None)) for i, v in values}
        assert {(r.i, r.short_letter) for r in out.collect()} == wanted and out.count() == len(values)


def test_overlapping_and_growing_bands(spark):
    import random

    rng = random.Random(2)
    # a scale of growing widths, as of default probabilities, and some bands across several of them
    bands = [(1e-6 * 1.6**i, 1e-6 * 1.6 ** (i + 1), f"g{i}", "l") for i in range(40)] + [(1e-5, 1e-2, "wide", "l"), (0.3, 0.3, "empty", "l"), (0.5, 0.2, "turned", "l")]
    values = [(i, 1e-6 * 1.6 ** rng.uniform(-2, 42)) for i in range(2000)] + [(2000, None), (2001, float("nan"))]
    df, table = spark.createDataFrame(values, "i int, v double"), spark.createDataFrame(bands, CONTRACTS["bands"])
    got = {(r.i, r.short_letter) for r in lookups.range_band(df, table, F.col("v"), ["short_letter"]).collect()}
    wanted = set()
    for i, v in values:
        found = [s for lo, hi, s, _ in bands if v is not None and lo <= v < hi]
        wanted |= {(i, s) for s in found} or {(i, None)}
    assert got == wanted
    # no interval holds more than a tenth of the rows
    cuts = F.array(*[F.lit(x) for x in sorted({e for lo, hi, *_ in bands if lo < hi for e in (lo, hi)})])
    sizes = [r["count"] for r in df.groupBy(lookups.interval_of(cuts, F.col("v"))).count().collect()]
    assert max(sizes) < len(values) / 10


@pytest.mark.parametrize("most", [1000, 0])
def test_many_lookups_in_one_index(spark, monkeypatch, most):
    """A small index is broadcast once for all lookups, a large one is joined once: the same rows."""
    monkeypatch.setattr(lookups, "INDEX_ROWS", most)
    index = spark.createDataFrame([(f"k{i}", i) for i in range(50)], "id string, value int")
    rows = [(f"k{i % 60}" if i % 7 else None, f"k{i % 11}", i % 3) for i in range(300)] * 2
    df = spark.createDataFrame(rows, "a string, b string, c int")
    keys = {"x": F.col("a"), "y": F.col("b"), "z": F.concat("b", F.lit("?")), "w": F.concat(F.lit("k"), F.col("c").cast("string"))}
    out = lookups.lookup_many(df, index, 50, keys)
    held = {f"k{i}": i for i in range(50)}
    wanted = [(a, b, c, held.get(a), held[b], None, c) for a, b, c in rows]
    assert sorted(out.collect(), key=str) == sorted([type(out.first())(*w) for w in wanted], key=str)
    for _ in range(3):  # more lookups, no more shuffles
        keys |= {f"{k}{len(keys)}": v for k, v in keys.items()}
    plan = lookups.lookup_many(df, index, 50, keys)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == (0 if most else 4)
