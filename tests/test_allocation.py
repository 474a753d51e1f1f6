import random
from decimal import Decimal
from pathlib import Path

import pytest
from brute_force import fill
from pyspark.sql import functions as F

from poolwright.operators import allocation as A
from poolwright.operators.ranking import ranked, running_totals

SCHEMA = (
    "facility_id string, tranche_id string, branch_id string, place int, is_candidate int, "
    "base_amount decimal(20,4), eligible_amount decimal(20,4), exclusion_reason string, exclusion_detail string, "
    "limits array<struct<limit_type:string,limit_value:string,allowed_units:long>>"
)


def case(seed, count=200):
    rng = random.Random(seed)
    pool = Decimal(rng.choice([10_000, 50_000, 1_000_000]))
    allowed = {}
    for kind, values in (("group", 9), ("country", 5), ("currency", 2)):
        for v in range(values):
            if kind == "currency":
                share = rng.choice([10_000_000, 6_000_000])
            else:
                share = rng.choice([0, 150_000, 700_001, 2_000_000, 10_000_000])
            allowed[kind, f"{kind}{v}"] = share
    rows = []
    for i in range(count):
        wanted = Decimal(rng.randint(1, int(pool) // 4 * 100)) / 100 if rng.random() < 0.9 else pool / 50
        candidate = int(rng.random() < 0.9)
        limits = []
        for kind in ("group", "country", "currency"):
            value = rng.choice([v for k, v in allowed if k == kind])
            limits.append((kind, value, allowed[kind, value]))
        rows.append((f"f{i}", "0", "b", i, candidate, wanted, wanted if candidate else Decimal(0), "NA", "", limits))
    return pool, rows


@pytest.mark.parametrize("seed,bucket_rows", [(s, b) for s, b in ((0, 16), (1, 500), (2, 48))])
def test_fill_equals_row_by_row(spark, seed, bucket_rows):
    pool, rows = case(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    filled = A.fill_pool(df, pool, [F.asc("place")], bucket_rows=bucket_rows)
    got = {r.facility_id: r for r in A.allocation(filled).collect()}
    expected = fill([(r[4], r[6], r[9]) for r in rows], pool)
    for row, (state, taken, why) in zip(rows, expected):
        mine = got[row[0]]
        assert mine.allocated_amount == taken, (row[0], mine, taken)
        assert (mine.candidate_rank > 0) == (state == "visited")
        if why:
            assert (mine.exclusion_reason, mine.exclusion_detail) == why
    assert sum(r.allocated_amount for r in got.values()) <= pool

    ledger = A.limit_ledger(filled, "s").collect()
    assert all(r.used_share <= r.allowed_share + 1e-12 for r in ledger)
    trace = A.allocation_trace(filled)
    last = trace.filter("candidate_rank > 0").groupBy("limit_type", "limit_value").agg(F.max("used_share").alias("u"))
    ledger_used = {(r.limit_type, r.limit_value): r.used_share for r in ledger}
    for r in last.collect():
        assert r.u == pytest.approx(ledger_used[r.limit_type, r.limit_value])


@pytest.mark.parametrize("seed", [3, 6])
def test_several_folds_correct_the_sums(spark, monkeypatch, seed):
    """Slices of 20 rows: later ones start from sums without the rows that used-up caps reject."""
    monkeypatch.setattr(A, "FOLD_ROWS", 20)
    monkeypatch.setattr(A, "BLOCK_ROWS", 7)
    pool, rows = case(seed, 300)
    # amounts small enough that the pool lasts for several slices
    rows = [(*r[:5], r[5] / 10, (r[6] / 10).quantize(Decimal("0.0001")), *r[7:]) for r in rows]
    filled = A.fill_pool(spark.createDataFrame(rows, SCHEMA).repartition(3), pool, [F.asc("place")], bucket_rows=10)
    got = {r.facility_id: r for r in A.allocation(filled).collect()}
    for row, (state, taken, why) in zip(rows, fill([(r[4], r[6], r[9]) for r in rows], pool)):
        mine = got[row[0]]
        assert mine.allocated_amount == taken and (mine.candidate_rank > 0) == (state == "visited"), (row[0], mine, taken)
        if why:
            assert (mine.exclusion_reason, mine.exclusion_detail) == why
    assert filled.events.rounds > 1 or filled.events.count < 2


def test_many_events_do_not_grow_the_plan(spark):
    """Events are tables: a fill with hundreds of used-up caps has the plan of one with none."""
    sizes = []
    for share in (10_000_000, 20_000):
        rows = []
        for i in range(1500):
            limits = [("group", f"g{i % 400}", share), ("currency", "EUR", 10_000_000)]
            rows.append((f"f{i}", "0", "b", i, 1, Decimal(1500), Decimal(1500), "NA", "", limits))
        filled = A.fill_pool(spark.createDataFrame(rows, SCHEMA), Decimal(1_000_000), [F.asc("place")])
        sizes.append((filled.events.count, len(filled.rows._jdf.queryExecution().analyzed().toString()), len(A.allocation(filled)._jdf.queryExecution().analyzed().toString())))
    assert sizes[0][0] < 3 and sizes[1][0] > 300
    assert sizes[1][1] < 1.2 * sizes[0][1] and sizes[1][2] < 1.2 * sizes[0][2]


def test_a_saved_fill_gives_the_same_reports(spark, tmp_path):
    pool, rows = case(11, 60)
    filled = A.fill_pool(spark.createDataFrame(rows, SCHEMA), pool, [F.asc("place")])
    filled.save(str(tmp_path / "fill"))
    back = A.load_fill(spark, str(tmp_path / "fill"))
    for report in (A.allocation, A.allocation_trace, lambda f: A.limit_ledger(f, "s")):
        assert sorted(map(str, report(back).collect())) == sorted(map(str, report(filled).collect()))


def test_sorted_rows_are_narrow(spark, monkeypatch):
    """Only key, order, amount and limits are sorted and written; the rest is joined back."""
    written = {}
    own = A.materialize
    from poolwright.operators import ranking

    def note(df, label):
        written[label] = df.columns
        return own(df, label)

    monkeypatch.setattr(A, "materialize", note)
    monkeypatch.setattr(ranking, "materialize", note)
    pool, rows = case(12, 30)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"limit_a": F.lit(1.0), "limit_b": F.lit(2.0), "note": F.lit("x")})
    filled = A.fill_pool(df, pool, [F.asc("place")], order_columns=("place",))
    for label in ("ranked", "ranked-input", "placed", "decided", "filled"):
        assert not {"limit_a", "limit_b", "note", "base_amount"} & set(written[label])
    assert {"limit_a", "note"} <= set(A.allocation(filled).columns)


def test_pool_filled_exactly_stops(spark):
    limits = [("currency", "EUR", 10_000_000)]
    rows = [(f"f{i}", "0", "b", i, 1, Decimal(50), Decimal(50), "NA", "", limits) for i in range(5)]
    out = A.allocation(A.fill_pool(spark.createDataFrame(rows, SCHEMA), Decimal(100), [F.asc("place")]))
    got = {r.facility_id: (r.allocated_amount, r.candidate_rank) for r in out.collect()}
    assert got == {"f0": (50, 1), "f1": (50, 2), "f2": (0, 0), "f3": (0, 0), "f4": (0, 0)}


def test_last_row_never_overshoots(spark):
    limits = [("currency", "EUR", 10_000_000)]
    rows = [("a", "0", "b", 0, 1, Decimal(70), Decimal(70), "NA", "", limits),
            ("c", "0", "b", 1, 1, Decimal(90), Decimal(90), "NA", "", limits)]
    out = A.allocation(A.fill_pool(spark.createDataFrame(rows, SCHEMA), Decimal(100), [F.asc("place")]))
    assert {r.facility_id: r.allocated_amount for r in out.collect()} == {"a": 70, "c": 30}


def test_rank_equals_sorted_position(spark):
    rng = random.Random(1)
    rows = [(rng.randint(0, 20), f"k{i:04d}") for i in range(1000)]
    df = spark.createDataFrame(rows, "v int, k string").repartition(7)
    out, count = ranked(df, [F.desc_nulls_last("v"), F.desc("k")])
    expected = {k: n for n, (v, k) in enumerate(sorted(rows, key=lambda r: (r[0], r[1]), reverse=True), start=1)}
    assert count == 1000
    assert {r.k: r["rank"] for r in out.collect()} == expected


def test_running_totals_of_a_hot_key(spark):
    rows = [("hot" if i % 3 else "cold", i, i // 10) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, i int, bucket int").repartition(5)
    out = running_totals(df, ["k"], "bucket", "i", {"total": F.col("i")})
    for r in out.collect():
        assert r.total == sum(i for k, i, _ in rows if k == r.k and i <= r.i)


def test_jobs_of_a_fill_follow_the_buckets_not_the_events(spark):
    """Many small caps: over a hundred are used up in few buckets."""
    pool, share = Decimal(1_000_000), 75_000  # 0.0075 of the pool for each group
    rng = random.Random(3)
    rows = []
    for i in range(1200):
        limits = [("group", f"g{i % 120}", share), ("currency", "EUR", 10_000_000)]
        wanted = Decimal(rng.randint(100_000, 400_000)) / 100
        rows.append((f"f{i}", "0", "b", i, 1, wanted, wanted, "NA", "", limits))
    df = spark.createDataFrame(rows, SCHEMA)
    jobs = {}
    for bucket_rows in (300, 1200):
        spark.sparkContext.setJobGroup(f"fill-{bucket_rows}", "fill")
        filled = A.fill_pool(df, pool, [F.asc("place")], bucket_rows=bucket_rows)
        jobs[bucket_rows] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"fill-{bucket_rows}"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert filled.events.count == filled.events.used_up.count() > 100
        got = {r.facility_id: r.allocated_amount for r in A.allocation(filled).collect()}
        expected = fill([(r[4], r[6], r[9]) for r in rows], pool)
        assert [got[r[0]] for r in rows] == [taken for _, taken, _ in expected]
    # neither buckets nor events cost jobs as long as one fold takes them
    assert jobs[1200] < 45 and jobs[300] < 45, jobs


def test_totals_hold_only_rows_before_the_pool_was_full(spark):
    """Rows that come after the one that filled the pool are neither marked nor summed, and all results keep them."""
    rows = [(f"f{i}", "0", "b", i, 1, Decimal(10), Decimal(10), "NA", "", [("group", f"g{i % 3}", 10_000_000), ("country", "c", 10_000_000)]) for i in range(120)]
    filled = A.fill_pool(spark.createDataFrame(rows, SCHEMA), Decimal(400), [F.asc("place")], bucket_rows=16)
    assert filled.events.full_at == 40 and filled.rows.count() == filled.draws.count() == 40 and filled.rest.count() == 80
    portfolio = {r.facility_id: r for r in A.allocation(filled).collect()}
    assert len(portfolio) == 120 and sum(r.is_selected for r in portfolio.values()) == 40
    assert (portfolio["f99"].candidate_rank, portfolio["f99"].cumulative_amount, portfolio["f99"].pool_limit, portfolio["f99"].exclusion_reason) == (0, 0, 1.0, "NA")
    trace = A.allocation_trace(filled).collect()
    assert len(trace) == 240 and sum(r.candidate_rank > 0 for r in trace) == 80
    assert all((r.allowed_share, r.cap_amount, r.available_share, r.used_share, r.used_amount) == (1.0, 400.0, None, 0.0, 0) for r in trace if not r.candidate_rank)


def test_tables_that_only_lead_to_the_fill_are_removed(spark):
    """What is written before and after the sort goes once the rows that follow from it are written."""
    from poolwright.session import Run, discard, materialize

    pool, rows = case(13, 40)
    with (run := Run(spark)):
        filled = A.fill_pool(spark.createDataFrame(rows, SCHEMA), pool, [F.asc("place")])
        kept = {p.name.rsplit("-", 1)[0] for p in Path(run.folder).iterdir()}
    assert {"facilities", "placed", "decided", "filled"} <= kept and not {"ranked", "ranked-input"} & kept
    assert A.allocation(filled).count() == 40 and A.allocation_trace(filled).count() == 120
    with run:
        table = materialize(spark.range(3), "other")
    with pytest.raises(ValueError, match="this run"):
        discard(table)
    assert table.count() == 3
    run.drop()


def test_the_trace_moves_facilities_not_a_row_per_limit(spark):
    """Facilities are dealt by bucket before they become a row per limit; totals reach over buckets all the same."""
    rows = [(f"f{i}", "0", "b", i, 1, Decimal(10), Decimal(10 + i % 3), "NA", "", [("group", f"g{i % 4 if i < 60 else 9}", 10_000_000), ("country", "c", 10_000_000)]) for i in range(90)]
    filled = A.fill_pool(spark.createDataFrame(rows, SCHEMA).repartition(3), Decimal(100_000), [F.asc("place")], bucket_rows=7)
    trace = A.allocation_trace(filled)
    plan = trace._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan and plan.index("Generate explode(caps") < plan.index("REPARTITION_BY_COL")
    used = {}
    got = {(r.facility_id, r.limit_type): r for r in trace.collect()}
    assert len(got) == 180
    for r in rows:
        for kind, value, _ in r[9]:
            used[kind, value] = used.get((kind, value), 0) + r[6]
            mine = got[r[0], kind]
            assert (mine.limit_value, mine.used_amount) == (value, used[kind, value])
            assert mine.used_share == pytest.approx(float(used[kind, value]) / 100_000)


def test_sums_of_buckets_are_exact_beyond_a_long(spark):
    big = (1 << 62) + 12_345
    df = spark.createDataFrame([(0, big, 7, "a", 5), (0, big, 8, "a", 5), (0, -3, 1, "b", 5)], "bucket long, wanted long, units long, value_0 string, allowed_0 long")
    got = {r.id: (int(r.draw), r.room) for r in A._bucket_sums(df, Decimal(1), ["group"], [0]).collect()}
    assert got == {A.POOL: (2 * big - 3, 10_000), f"group{A.SEP}a": (15, 5), f"group{A.SEP}b": (1, 5)}
