"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_RUNS (timed runs per query).
Each query runs once to warm up; its time is the median of the timed runs, planning included.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from crewcast.catalog import QUERIES
from crewcast.session import build_session

HEADLINE = [
    "dense_month_panel", "month_bucket_sum", "latest_attribute_pivot", "latest_with_ties", "status_folded_close",
    "star_fact", "worker_hierarchy", "service_fact", "composite_key_lookup", "unpivot_months", "prediction_scaffold",
    "daily_ingest", "cv_train", "sma_forecast", "seasonal_ar_forecast", "forecast_metrics_by_tier", "profile_numeric",
    "profile_top5", "marketing_calendar", "correction_grid_best", "efficiency_reduction", "display_union", "display_cube",
]


def timed(spark, name: str, folder: str) -> float:
    begin = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        timed(spark, name, folder)
        seconds[name] = round(statistics.median(timed(spark, name, folder) for _ in range(runs)), 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
