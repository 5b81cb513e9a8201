"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  folder of test tables   (default /root/testdata/sf0.1)
BENCH_CPUS    local executor threads  (default 8)
BENCH_QUERIES comma-separated names   (default: the headline list)
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

from registry.queries import registered

HEADLINE = [
    "ingest_report",
    "bronze_report",
    "dedup_rides",
    "station_dim",
    "hourly_demand",
    "spatial_capacity",
    "silver_hourly",
    "pricing_analysis",
    "price_decision",
    "zone_summary",
    "hotspots",
    "headline_kpis",
    "demand_lookup",
    "price_requests",
    "station_forecast",
    "running_stock",
    "sample_rows",
    "standardized",
    "gold_features",
    "rf_demand",
    "gbt_demand",
    "param_search",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="velotide-tables-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()
    # Start the engine before the clock: class loading is not a query's cost.
    queries["hourly_demand"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in names:
        began = time.monotonic()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.monotonic() - began, 3)
    scale = Path(sf_dir.rstrip("/")).name.removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
