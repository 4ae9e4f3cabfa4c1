"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then RUNS times; the median is reported. Every
result is read in full through a sink that keeps nothing. Tables that a query reads
in a prepared form (partitioned, materialised) are written before the clock starts,
as they are in the published numbers.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from lakeworks.catalog import QUERIES  # noqa: E402
from lakeworks.catalog.registry import table, trips  # noqa: E402
from lakeworks.functions import month_range  # noqa: E402
from lakeworks.operators import marts  # noqa: E402
from lakeworks.session import get_session, new_folder  # noqa: E402
from lakeworks.sources import layout, writers  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))

# Queries timed as they are registered.
REGISTERED = [
    "monthly_status_rollup", "monthly_trip_stats", "star_join_all", "star_join_codes", "top_n_per_month",
    "monthly_zone_summary", "daily_zone_summary", "daily_revenue", "monthly_customer_value", "recent_kpis",
    "top_products", "category_weekly", "daily_conditional", "share_of_total", "moving_avg_7", "session_gaps",
    "match_with_tolerance", "recon_rules", "schema_failure_counts", "rule_log", "keep_latest", "version_diff",
    "topk_cosine", "topk_cosine_batch",
]


def prepared(spark) -> dict:
    """Queries over tables written beforehand, and what they are compared with."""
    orders, root = table(spark, SF_DIR, "orders"), new_folder(spark, "bench")
    layout.write_by_date(orders, f"{root}/orders", "o_orderdate")
    writers.write_parquet(marts.materialised_daily(orders, "o_orderdate", "o_custkey", "o_totalprice"), f"{root}/daily")
    writers.write_parquet(marts.monthly_zone_summary(trips(spark, SF_DIR)), f"{root}/zones")
    tree, daily, zones = (spark.read.parquet(f"{root}/{n}") for n in ("orders", "daily", "zones"))
    one_month = (F.col("year") == 1998) & (F.col("month") == 1)
    return {
        "month_total_partition": lambda: marts.month_total(tree, "o_totalprice", one_month),
        "month_total_full_scan": lambda: marts.month_total(orders, "o_totalprice", month_range("o_orderdate", "1998-01")),
        "daily_raw": lambda: marts.materialised_daily(orders, "o_orderdate", "o_custkey", "o_totalprice"),
        "daily_materialised": lambda: daily,
        "top_zones_summary": lambda: marts.top_zones(zones, "1998-01-01", "1998-12-31"),
    }


def sizes(spark) -> dict:
    """Bytes of the orders as CSV and as Parquet."""
    orders, root = table(spark, SF_DIR, "orders"), new_folder(spark, "bench-size")
    writers.write_csv(orders, f"{root}/csv")
    writers.write_parquet(orders, f"{root}/parquet")
    return {fmt: spark.read.format("binaryFile").load(f"{root}/{fmt}").agg(F.sum("length")).first()[0]
            for fmt in ("csv", "parquet")}


def timed(build) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = get_session("bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS, spark__ui__enabled="false",
                        spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    jobs = {n: (lambda q=QUERIES[n]: q(spark, SF_DIR)) for n in REGISTERED} | prepared(spark)
    seconds = {}
    for name, build in jobs.items():
        timed(build)
        seconds[name] = round(statistics.median(timed(build) for _ in range(RUNS)), 4)
    size = sizes(spark)
    print(json.dumps({
        "metric": "total of median query times", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "ratios": {
            "partition_speedup": round(seconds["month_total_full_scan"] / seconds["month_total_partition"], 2),
            "materialised_speedup": round(seconds["daily_raw"] / seconds["daily_materialised"], 2),
            "csv_to_parquet_size": round(size["csv"] / size["parquet"], 2)}}))


if __name__ == "__main__":
    main()
