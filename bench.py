"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the local threads. Each query
is run in full into a sink that discards rows: once to warm up, then BENCH_RUNS (default 2) times, the best counting.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "hourly_station_demand",
    "incident_table",
    "feature_table",
    "star_enrich",
    "join_two_systems",
    "late_events",
    "lag_by_key",
    "lookup_by_year",
    "hourly_counts",
    "concat_text",
    "daily_pivot",
    "heat_dow_hour",
    "per_event",
    "delete_duplicates",
    "drop_columns_with_at_most_two_values",
    "total_transports_lastweek_by_station",
    "station_lags",
    "operator_experience",
    "regular_hourly_series",
    "autocorrelation",
    "idle_time",
    "busy_units",
    "saturation_episodes",
    "created_while_saturated",
    "metrics_at_k",
    "metrics_at_k_per_group",
    "pr_curve",
    "k_search",
    "reg_metrics_exp",
    "point_in_square",
    "point_in_diamond",
    "area_weighted",
    "dispatch_dictionary",
    "regressor_grid_metrics",
    "logistic_gain_by_type",
    "model_registry",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from callgrid.catalog import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in names:
        once(name)
        times[name] = round(min(once(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
