"""Queries that write the given tables through a sink and read them back through a source."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from poolwright.session import materialize, work_folder
from poolwright.sinks import writers
from poolwright.sources import files, snapshots
from poolwright.workload.basics import SCAN, dated_orders
from poolwright.workload.registry import query
from poolwright.workload.spec import project, sql_columns
from poolwright.workload.sql_tables import CTES


def folder(t, label: str) -> str:
    return f"{work_folder(t.spark)}/{label}-{uuid.uuid4().hex}"


@query("catalogue_scan", f"SELECT {sql_columns(SCAN)} FROM dated_orders WHERE closing_date = (SELECT MAX(closing_date) FROM dated_orders)")
def catalogue_scan(t):
    """Newest partition of a catalogue table, found in its partition list."""
    name = f"orders_{uuid.uuid4().hex}"
    by_date = dated_orders(t).hint("rebalance", F.col("closing_date"))
    by_date.write.format("parquet").option("path", folder(t, "catalogue")).partitionBy("closing_date").saveAsTable(name)
    try:
        return project(materialize(snapshots.scan_catalog_latest(t.spark, name, "closing_date"), "scan"), SCAN)
    finally:
        t.spark.sql(f"DROP TABLE {name}")


@query("partition_read", f"SELECT {sql_columns(SCAN)} FROM dated_orders WHERE closing_date = DATE '1995-03-01'")
def partition_read(t):
    """One dated folder of a partitioned write."""
    path = folder(t, "dated")
    writers.write_partitioned(dated_orders(t), path, ["closing_date"])
    return project(snapshots.read_partition(t.spark, path, "closing_date", "1995-03-01"), SCAN)


MONTHS = "d:closing_date i:n m:total"


@query("partition_overwrite", f"""
SELECT {sql_columns(MONTHS)} FROM (
  SELECT closing_date, COUNT(*) AS n, SUM(CASE WHEN closing_date >= DATE '1997-01-01' THEN 2 * total ELSE total END) AS total
  FROM dated_orders GROUP BY 1)""")
def partition_overwrite(t):
    """A second write replaces the dates that it holds and leaves the others."""
    path = folder(t, "dated")
    orders = dated_orders(t)
    writers.write_partitioned(orders, path, ["closing_date"])
    later = orders.filter(F.col("closing_date") >= F.lit("1997-01-01").cast("date"))
    writers.write_partitioned(later.withColumn("total", 2 * F.col("total")), path, ["closing_date"])
    back = t.spark.read.parquet(path)
    return project(back.groupBy("closing_date").agg(F.count(F.lit(1)).alias("n"), F.sum("total").alias("total")), MONTHS)


MERGED = "i:o_orderkey o_orderstatus m:total i:part"


@query("merged_scan", f"""
SELECT {sql_columns(MERGED)} FROM (
  SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 2 = 1 THEN total END AS total, o_orderkey % 2 AS part FROM dated_orders)""")
def merged_scan(t):
    """Snapshots of which the older one lacks a column."""
    path = folder(t, "merged")
    orders = dated_orders(t).select("o_orderkey", "o_orderstatus", "total")
    orders.filter("o_orderkey % 2 = 0").drop("total").write.parquet(f"{path}/part=0")
    orders.filter("o_orderkey % 2 = 1").write.parquet(f"{path}/part=1")
    return project(snapshots.read_merged(t.spark, path), MERGED)


TEXT = "i:o_orderkey o_orderstatus m:total d:closing_date"


@query("csv_round_trip", f"SELECT {sql_columns(TEXT)} FROM dated_orders")
def csv_round_trip(t):
    """Delimited text out and in; every column comes back as text and is cast."""
    path = folder(t, "text")
    columns = ["o_orderkey", "o_orderstatus", "total", "closing_date"]
    writers.write_csv(dated_orders(t).select(*columns), path, sep=";")
    back = files.read_csv(t.spark, path, columns, sep=";")
    return project(back.withColumns({"total": F.col("total").cast("decimal(20,4)"), "closing_date": F.col("closing_date").cast("date")}), TEXT)


@query("guarded_scan", f"SELECT {sql_columns('i:o_orderkey m:total')} FROM dated_orders")
def guarded_scan(t):
    """A mandatory source: it would stop here if it were empty."""
    return project(snapshots.require_rows(dated_orders(t), "orders"), "i:o_orderkey m:total")


@query("compacted_write", f"SELECT {sql_columns(SCAN)}, TRUE AS few_files FROM dated_orders")
def compacted_write(t):
    """Everything in three files at most."""
    path = folder(t, "compacted")
    writers.write_compacted(dated_orders(t), path, files=3)
    back = t.spark.read.parquet(path)
    few = len(back.inputFiles()) <= 3
    return project(back.withColumn("few_files", F.lit(few)), f"{SCAN} b:few_files")


KEPT = "i:o_orderkey m:total d:closing_date source"


CTES["copies"] = """
SELECT o_orderkey, total, CASE o_orderstatus WHEN 'P' THEN DATE '1998-06-01' WHEN 'F' THEN DATE '1998-07-01' ELSE DATE '1998-08-01' END AS closing_date FROM dated_orders"""


@query("history_and_current", f"""
SELECT {sql_columns(KEPT)} FROM (
  SELECT *, 'history' AS source FROM copies UNION ALL SELECT *, 'current' FROM copies WHERE closing_date = (SELECT MAX(closing_date) FROM copies))""")
def history_and_current(t):
    """Dated copies pile up in the history, of which the last one is current; orders of a status are a copy, an earlier one is published twice."""
    root = folder(t, "published")
    orders = dated_orders(t).select("o_orderkey", "o_orderstatus", "total")
    for status, day in (("P", "1998-06-01"), ("F", "1998-07-01"), ("P", "1998-06-01"), ("O", "1998-08-01")):
        writers.publish({"orders": orders.filter(F.col("o_orderstatus") == status)}, root, day)
    both = [read(t.spark, root, "orders").select("o_orderkey", "total", F.col("closing_date").cast("date"), F.lit(name).alias("source"))
            for read, name in ((writers.read_history, "history"), (writers.read_current, "current"))]
    return project(both[0].unionByName(both[1]), KEPT)


@query("folder_dates", """
SELECT STRFTIME(MAX(closing_date), '%Y-%m-%d') AS newest, STRFTIME(LEAST(MAX(closing_date), MAX(CASE WHEN o_orderstatus = 'F' THEN closing_date END)), '%Y-%m-%d') AS common,
  COUNT(CASE WHEN closing_date = DATE '1995-03-01' THEN 1 END) > 0 AS present, COUNT(CASE WHEN closing_date = DATE '1895-03-01' THEN 1 END) > 0 AS absent,
  CAST(MAX(o_orderkey) AS BIGINT) AS last_key, CAST(COUNT(DISTINCT closing_date) AS BIGINT) AS folders FROM dated_orders""")
def folder_dates(t):
    """Dates of partitioned writes from their folders, and a largest key from the files' footers; no data is read back."""
    every, some = folder(t, "dated"), folder(t, "dated")
    writers.write_partitioned(dated_orders(t), every, ["closing_date"])
    writers.write_partitioned(dated_orders(t).filter("o_orderstatus = 'F'"), some, ["closing_date"])
    day = F.lit("1995-03-01").cast("date")
    return t.spark.range(1).select(
        F.lit(str(snapshots.newest_snapshot(t.spark, every, "closing_date"))).alias("newest"),
        F.lit(str(snapshots.common_snapshot(t.spark, [every, some], "closing_date"))).alias("common"),
        F.lit(snapshots.snapshot_exists(t.spark, every, "closing_date", day)).alias("present"),
        F.lit(snapshots.snapshot_exists(t.spark, every, "closing_date", F.lit("1895-03-01").cast("date"))).alias("absent"),
        F.lit(snapshots.newest_in_footers(t.spark, every, "o_orderkey")).cast("long").alias("last_key"),
        F.lit(snapshots.snapshots_of(t.spark, every, "closing_date").count()).cast("long").alias("folders"))
