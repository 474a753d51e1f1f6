import time
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poolwright.functions import codes
from poolwright.functions import exprs as E
from poolwright.operators import dedupe
from poolwright.plans import examples, selection
from poolwright.sinks import writers
from poolwright.sources import files, snapshots


def test_rating_scale():
    ordinals = E.codes.rating_ordinals()
    assert (ordinals["AAA"], ordinals["BBB+2"], ordinals["BB+1"], ordinals["D2"]) == (1, 10, 18, 49)
    assert ordinals["No Rating"] == ordinals["XXXX"] == 50 and len(ordinals) == 51


def test_feature_flags_fixture(spark):
    rows = [("1", "a", "BB+1", 18, "ICO España", "S", "true", "true", 1, 1000), ("2", "b", "AA", 3, "Other", "N", "false", "false", 0, 0),
            ("3", " 2 ", "BBB-2", 30, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "id string, watch_list string, rating_letter string, rating_ordinal int, purpose string, "
                                     "construction_type string, sts_payment_condition string, sts_rw_condition string, esg_linked int, bei_guaranteed int")
    flags = [tuple(r) for r in df.select("id", *[c.alias(n) for n, c in E.feature_flags().items()]).orderBy("id").collect()]
    assert flags == [("1", 1, 1, 1, 0, 1, 1, 1, 1), ("2", 0, 0, 0, 0, 0, 0, 0, 0), ("3", 0, 0, 0, 1, 0, 0, 0, 0)]


def test_project_sector_is_trimmed(spark):
    df = spark.createDataFrame([(" GAS ",), ("OIL",)], "project_sector_desc string").withColumns({
        "watch_list": F.lit("0"), "rating_letter": F.lit("AA"), "rating_ordinal": F.lit(3), "purpose": F.lit("x"),
        "construction_type": F.lit("N"), "sts_payment_condition": F.lit(True), "sts_rw_condition": F.lit(False),
        "esg_linked": F.lit(0), "bei_guaranteed": F.lit(0)})
    catalogue = spark.createDataFrame([("GAS  ", "sub")], "project_sector_desc string, project_subsector_desc string")
    out = {r.project_sector_desc: (r.project_subsector_desc, r.sts_payment_flag) for r in selection.flag_facilities(df, catalogue).collect()}
    assert out == {"GAS": ("sub", 1), "OIL": (codes.UNKNOWN_TEXT, 1)}


@pytest.mark.parametrize("text,expected", [("2.000.000.000,0000", 2e9), ("0,0200", 0.02), ("1000,00", 1000.0), ("n/a", None), (None, None)])
def test_locale_decimal(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(E.parse_locale_decimal(F.col("t"))).first()[0] == expected


def test_flexible_dates(spark):
    rows = [("2023-11-07", date(2023, 11, 7)), ("07/11/2023", date(2023, 11, 7)), ("7 11 2023", date(2023, 11, 7)),
            ("12", None), ("32/13/2023", None), (None, None)]
    df = spark.createDataFrame(rows, "t string, d date")
    assert df.filter(~E.parse_flexible_date(F.col("t")).eqNullSafe(F.col("d"))).count() == 0


def test_ratios_survive_zero(spark):
    df = spark.createDataFrame([(D(1), D(0)), (D(1), D(4))], "a decimal(20,4), b decimal(20,4)")
    assert [r[0] for r in df.select(E.ratio(F.col("a"), F.col("b"))).collect()] == [None, 0.25]


def test_least_of(spark):
    df = spark.createDataFrame([(3, 2)], "a int, b int")
    row = df.select(E.least_of([], F.lit(9)).alias("n"), E.least_of([F.col("a")], F.lit(9)).alias("o"),
                    E.least_of([F.col("a"), F.col("b")], F.lit(9)).alias("t")).first()
    assert tuple(row) == (9, 3, 2)


def test_keep_latest_fixture(spark):
    rows = [(1, "2024-01-01", 100), (1, "2024-01-02", 200), (2, "2024-01-01", 300), (2, "2024-01-03", 400)]
    out = dedupe.keep_first(spark.createDataFrame(rows, "id int, day string, value int"), ["id"], [F.desc("day")])
    assert {(r.id, r.value) for r in out.collect()} == {(1, 200), (2, 400)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan  # a hot key is trimmed before the shuffle


def test_null_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, None, "y")], "a int, b string, c string")
    assert {r.column_name: r.non_null for r in dedupe.null_profile(df).collect()} == {"a": 1, "b": 0, "c": 2}
    assert dedupe.drop_empty_columns(df).columns == ["a", "c"]


def test_threshold_flag_fixture(spark):
    times = [6000, 1500, 5500, 5000, 6000, 2500, 3000, 3000, 4500, 6500]
    df = spark.createDataFrame([(t,) for t in times], "time int")
    assert df.filter(E.threshold_flag(F.col("time"), 1500) == 1).count() == 9


# --- sources and sinks ---

def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "2024-01-31", "ES"), (2, "2024-02-29", "ES"), (3, "2024-03-31", "XX")], "id int, day string, e string") \
        .write.partitionBy("day").parquet(path)
    df = snapshots.read_merged(spark, path)
    assert str(snapshots.latest_snapshot(df, "day").first()[0]) == "2024-03-31"
    assert str(snapshots.latest_snapshot(df, "day", F.col("e") == "ES").first()[0]) == "2024-02-29"
    assert snapshots.has_snapshot(df, "day", date(2024, 1, 31)) and not snapshots.has_snapshot(df, "day", date(2025, 1, 31))
    latest = snapshots.scan_latest(df, "day")
    assert [r.id for r in latest.collect()] == [3]
    assert "PartitionFilters: [isnotnull(day" in latest._jdf.queryExecution().executedPlan().toString()
    one = snapshots.read_partition(spark, path, "day", "2024-02-29")
    assert [(r.id, str(r.day)) for r in one.collect()] == [(2, "2024-02-29")]
    both = snapshots.common_snapshot_date([(df, "day", None), (df, "day", F.col("e") == "ES")])
    assert str(both.first()[0]) == "2024-02-29"
    with pytest.raises(ValueError):
        snapshots.require_rows(df.filter("id > 9"), "nothing")
    assert snapshots.require_rows(df, "t") is df


def test_catalogue_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS pw_test")
    try:
        spark.createDataFrame([(1, "a", "2024-01-01"), (2, "b", "2024-02-01")], "id int, kind string, closing_date string") \
            .write.mode("overwrite").format("parquet").partitionBy("kind", "closing_date").saveAsTable("pw_test.lim")
        assert snapshots.catalog_latest(spark, "pw_test.lim", "closing_date") == "2024-02-01"
        assert [r.id for r in snapshots.scan_catalog_latest(spark, "pw_test.lim", "closing_date").collect()] == [2]
    finally:
        spark.sql("DROP DATABASE pw_test CASCADE")


def test_schema_merge(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.createDataFrame([(1,)], "a int").write.parquet(path + "/d=1")
    spark.createDataFrame([(2, "x")], "a int, b string").write.parquet(path + "/d=2")
    assert {(r.a, r.b) for r in snapshots.read_merged(spark, path).collect()} == {(1, None), (2, "x")}


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.createDataFrame([("a", "1,5")], "k string, v string")
    writers.write_csv(df, path, sep=";")
    assert [tuple(r) for r in files.read_csv(spark, path, ["k", "v"]).collect()] == [("a", "1,5")]


def test_partitioned_overwrite_replaces_only_touched_values(spark, tmp_path):
    path = str(tmp_path / "p")
    writers.write_partitioned(spark.createDataFrame([(1, "d1"), (2, "d2")], "v bigint, day string"), path, ["day"])
    writers.write_partitioned(spark.createDataFrame([("7", "d2", "new")], "v string, day string, extra string"), path, ["day"])
    out = snapshots.read_merged(spark, path)
    assert dict(out.dtypes)["v"] == "bigint"  # aligned to the table
    assert {(r.v, r.day, r.extra) for r in out.collect()} == {(1, "d1", None), (7, "d2", "new")}


def test_align_and_stamp(spark):
    target = T.StructType([T.StructField("v", T.DecimalType(10, 2)), T.StructField("gone", T.StringType())])
    out = writers.stamp(writers.align_schema(spark.createDataFrame([("1.256", 2)], "v string, w int"), target), closing_date="2024-01-01")
    assert [tuple(r) for r in out.collect()] == [(D("1.26"), 2, "2024-01-01")]


def test_history_and_current(spark, tmp_path):
    root = str(tmp_path / "root")
    for day, v in (("2024-01-01", 1), ("2024-02-01", 2), ("2024-01-01", 3)):
        writers.publish({"a": spark.createDataFrame([(v,)], "v int"), "b": spark.createDataFrame([(10 * v,)], "v int")}, root, day)
    assert {(r.v, r.closing_date) for r in writers.read_history(spark, root, "a").collect()} == {(3, "2024-01-01"), (2, "2024-02-01")}
    assert [(r.v, r.closing_date) for r in writers.read_current(spark, root, "b").collect()] == [(20, "2024-02-01")]
    with pytest.raises(ValueError, match="never published"):
        writers.read_current(spark, root, "c")
    writers.write_compacted(spark.range(10), str(tmp_path / "k"), files=1)
    assert len(list((tmp_path / "k").glob("*.parquet"))) == 1


def test_a_publication_that_fails_in_between_leaves_the_old_tables(spark, tmp_path):
    root = str(tmp_path / "root")
    old = {name: spark.createDataFrame([(1,)], "v int") for name in ("history", "ledger")}
    writers.publish(old, root, "2024-01-01")
    broken = spark.range(1).select(F.raise_error(F.lit("lost")).cast("int").alias("v"))
    with pytest.raises(Exception, match="lost"):
        writers.publish({"history": spark.createDataFrame([(2,)], "v int"), "ledger": broken}, root, "2024-01-01")
    # the first table of the failed run was written, but no commit names it
    assert len(list((tmp_path / "root" / "history" / "closing_date=2024-01-01").iterdir())) == 2
    assert [[r.v for r in writers.read_current(spark, root, name).collect()] for name in old] == [[1], [1]]


def test_dates_come_from_listing_and_footers_only(spark, tmp_path):
    """Files whose data is overwritten with zeros still give dates and largest values: nothing but names and footers is read."""
    path = tmp_path / "dated"
    rows = [(i, date(2024, 1 + i % 3, 1)) for i in range(300)]
    spark.createDataFrame(rows, "k int, day date").repartition(2).write.partitionBy("day").parquet(str(path))
    spark.createDataFrame([], "k int").write.parquet(str(tmp_path / "none" / "day=2024-01-01"))
    for file in path.rglob("*.parquet"):
        raw = file.read_bytes()
        footer = int.from_bytes(raw[-8:-4], "little") + 8
        file.write_bytes(raw[:4] + bytes(len(raw) - 4 - footer) + raw[-footer:])
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    found = {r.day: r.files for r in snapshots.snapshots_of(spark, str(path), "day").collect()}
    assert set(found) == {date(2024, m, 1) for m in (1, 2, 3)} and all(n > 0 for n in found.values())
    assert snapshots.newest_snapshot(spark, str(path), "day") == date(2024, 3, 1)
    assert snapshots.common_snapshot(spark, [str(path), str(tmp_path / "none")], "day") == date(2024, 1, 1)
    assert snapshots.snapshot_exists(spark, str(path), "day", date(2024, 2, 1)) and not snapshots.snapshot_exists(spark, str(path), "day", date(2023, 2, 1))
    assert snapshots.newest_in_footers(spark, str(path), "k") == 299
    with pytest.raises(Exception):
        spark.read.parquet(str(path)).filter("k = 5").collect()


def test_interleaved_runs_drop_their_own_tables(spark):
    from poolwright import session

    first, second = session.Run(spark), session.Run(spark)
    with first:
        a = session.materialize(spark.range(3), "a")
    with second:
        b = session.materialize(spark.range(4), "b")
        with first:
            c = session.materialize(spark.range(5), "c")
        d = session.materialize(spark.range(6), "d")
    outside = session.materialize(spark.range(7), "e")
    assert first.drop() == 2
    assert (b.count(), d.count(), outside.count()) == (4, 6, 7)
    for gone in (a, c):
        with pytest.raises(Exception):
            gone.count()
    assert second.drop() == 2 and outside.count() == 7
    with session.scratch(spark) as run:
        inside = session.materialize(spark.range(2), "f")
        assert inside.count() == 2 and run.tables == 1
    with pytest.raises(Exception):
        inside.count()
    with pytest.raises(ValueError, match="no rows"):
        snapshots.require_rows(spark.range(0), "orders")


def test_shuffle_files_go_with_the_query_that_wrote_a_table(spark):
    from poolwright import session

    def shuffled():
        return {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}

    before = shuffled()
    setting = spark.conf.get(session.CLEANUP)
    table = session.materialize(spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count(), "sums")
    end = time.time() + 20
    while shuffled() - before and time.time() < end:  # executors remove them in the background
        time.sleep(0.2)
    assert not shuffled() - before and table.count() == 7
    assert spark.conf.get(session.CLEANUP) == setting


def test_jdbc_options():
    assert writers.jdbc_options("jdbc:x", "t", user="u") == {
        "url": "jdbc:x", "dbtable": "t", "truncate": "true", "numPartitions": "8", "batchsize": "10000", "user": "u"}


# --- example jobs ---

def test_clients_contracts(spark, tmp_path):
    clients = spark.createDataFrame([("1", "Ann", 30, "P", "true"), ("2", "Bob", 50, "P", "true"), ("3", "Cid", 51, "P", "true"),
                                     ("4", "Dan", 40, "P", "false")], "client_id string, name string, age int, province string, vip string")
    contracts = spark.createDataFrame([(f"k{i}", "1" if i < 4 else "2", 1, "2024-01-01") for i in range(7)],
                                      "contract_id string, holder_id string, product_id int, opened string")
    products = spark.createDataFrame([(1, "loan"), (2, "card")], "product_id int, product_name string")
    joined = examples.contracts_of_clients(examples.vip_clients(clients), contracts, products)
    assert joined.count() == 7
    out = examples.clients_contracts(clients, contracts, products, str(tmp_path / "o"))
    assert out.count() == 4 and {r.name for r in out.collect()} == {"Ann"}
    assert all(len(r.hash) == 64 for r in spark.read.parquet(str(tmp_path / "o")).collect())


def test_size_by_period_fixture(spark):
    rows = [("John", 28, "London", "2024-04-11"), ("Anna", 24, "Madrid", "2022-05-25"), ("Peter", 35, None, "2022-09-16"),
            ("Linda", 32, "Madrid", "2024-12-11"), ("Em", 15, "Madrid", "2022-01-05"), ("Mark", 41, "Madrid", "2022-07-07")]
    people = spark.createDataFrame(rows, "name string, age int, city string, date string")
    by_city = examples.size_by_period(people, 18, True)
    assert {tuple(r) for r in by_city.collect()} == {(2024, "London", 1), (2022, "Madrid", 2), (2024, "Madrid", 1)}
    assert {tuple(r) for r in examples.size_by_period(people, 18, False).collect()} == {(2024, 2), (2022, 2)}
