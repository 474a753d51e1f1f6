"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR    folder of the Parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS      local cores (default 8)
BENCH_QUERIES   comma-separated names (default: the headline list)
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "capital_by_facility", "reg_capital_by_facility", "provision_by_facility", "risk_enrich",
    "balance_evolution", "runoff_by_year", "guarantee_amounts", "customer_master", "any_flag",
    "limits_active", "row_limits", "eligible_amount", "limit_universe", "ordered_candidates",
    "wide_cube", "cube_selection", "allocate_pool", "limit_ledger",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from poolwright.session import drop_scratch
    from poolwright.workload.catalog import QUERIES

    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("poolwright-bench")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for table in ("lineitem", "orders", "customer", "part"):
        spark.read.parquet(f"{path}/{table}.parquet").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name].run(spark, path).write.format("noop").mode("overwrite").save()
        drop_scratch(spark)
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    scale = Path(path).name.removeprefix("sf")
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }))


if __name__ == "__main__":
    main()
