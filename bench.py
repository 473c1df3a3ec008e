"""Time the headline queries: one warm-up, then the median of BENCH_RUNS runs, all on the same tables.

Prints one JSON line. BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS and BENCH_QUERIES (comma-separated)
override the defaults.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tarmac.session import build_session  # noqa: E402
from workload import QUERIES  # noqa: E402

HEADLINE = [
    "nearest_join", "nearest_join_6h", "nearest_join_hot_key", "departure_weather_6h", "training_features",
    "serving_features", "latest_snapshot_join", "dimension_last_wins", "large_dimension_lookup", "unknown_codes",
    "delay_minutes_clamped", "delay_columns", "calendar_features", "parse_timestamps_lenient", "schedule_features",
    "backfill_grid", "flatten_nested", "bad_weather_flag", "polymorphic_weather", "codeshare_filter",
    "prefer_else_all", "priority_fallback", "per_group_cap", "group_opening_cap", "priority_cap", "top_rows",
    "numbered_predictions", "null_profile", "value_counts_with_null", "mode_impute", "mean_impute", "r2_score",
    "inventory_counts", "upsert_last_wins", "upsert_table_written", "insert_if_absent", "validate_rows",
    "one_hot", "linear_regression", "ridge", "elastic_net", "production_model", "stream_city_hour", "stream_upsert",
    "stream_enrich",
]


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.log.level": "ERROR",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="bench-warehouse-"),
        },
    )
    times = {}
    for name in chosen:
        run(spark, name, sf_dir)
        times[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(runs)), 3)
        print(f"{name}: {times[name]}", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
