"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data folder and ``BENCH_CPUS`` the local cores. Each
query runs once cold and four more times into the ``noop`` sink; ``queries`` holds
the best of those four, ``cold`` the first run, ``jobs`` one run of the whole jobs.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from checks import feeds
from checks.queries import all_queries, write_csv
from tidemark import Layout, refresh
from tidemark.plans.jobs import refresh_reports
from tidemark.sources.workspace import Workspace

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINES = (
    "daily_sales",
    "product_performance",
    "category_performance",
    "customer_metrics",
    "sales_lines",
    "unique_item_ids",
    "standardize_order_items",
    "validate_order_items",
    "validate_orders",
    "error_counts",
    "merge_incremental_orders",
    "merge_incremental_order_items",
    "merge_snapshot_products",
    "merge_snapshot_customers",
    "quarantine_new_rows",
    "latest_file_states",
)


def seconds(query, spark: SparkSession) -> float:
    start = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def job_seconds(spark: SparkSession) -> dict[str, float]:
    """A full refresh of an empty lake from CSV, a rebuild of its reports alone, and a refresh without changes."""
    with Workspace(spark, "bench") as work:
        sources = {name: f"{work.path}/{name}" for name in feeds.RAW}
        for name, feed in feeds.RAW.items():
            write_csv(feed.frame(spark, SF_DIR), sources[name])
        layout, taken = Layout(f"{work.path}/lake"), {}
        for name, run in (
            ("refresh", lambda: refresh(spark, sources, layout)),
            ("build_reports", lambda: refresh_reports(spark, layout, full=True)),
            ("follow_reports", lambda: refresh_reports(spark, layout)),
        ):
            start = time.perf_counter()
            run()
            taken[name] = round(time.perf_counter() - start, 3)
        return taken


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    cold, best = {}, {}
    for name in HEADLINES:
        cold[name] = seconds(queries[name], spark)
        best[name] = min(seconds(queries[name], spark) for _ in range(4))
    jobs = job_seconds(spark)
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of best times",
                "value": round(sum(best.values()), 3),
                "unit": "sec",
                "queries": best,
                "cold": cold,
                "jobs": jobs,
                "sf": SF_DIR.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
