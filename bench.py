"""Time the headline queries: one warm-up, then the median of three full runs each.

BENCH_SF_DIR   folder of the parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     local threads (default 8)
BENCH_QUERIES  comma-separated names, or 'all' (default: the headline list)

Prints one JSON line. A run computes every row and column of the result (noop sink).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from custodia.catalog import ENTRIES  # noqa: E402
from custodia.session import build_session  # noqa: E402

HEADLINE = [
    "trip_total", "trips_by_code", "top_zones_by_revenue", "zone_rank_in_borough", "curated_trips", "enrich_two_roles",
    "zone_day_metrics", "revenue_borough_month", "quality_report", "quality_samples", "quarantine_rows", "lookup_gate",
    "scorecard", "column_profile", "scd2_apply", "scd2_hash_apply", "scd2_rollback", "upsert_type1", "change_log",
    "exact_duplicates", "pairs_levenshtein", "fuzzy_duplicates", "dedup_candidates", "auto_merge", "golden_record",
    "star_fact", "dashboard_kpis", "run_state", "metric_series_5m", "alarm_states", "partitioned_roundtrip",
    "snapshot_time_travel", "stream_metric_series", "mv_refresh",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(ENTRIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = build_session(
        "custodia-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    seconds = {}
    for name in names:
        runs = []
        for _ in range(4):
            start = time.perf_counter()
            ENTRIES[name][0](spark, sf).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:]), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    result = {
        "metric": "total of median query times",
        "value": total,
        "unit": "sec",
        "queries": seconds,
        "sf": sf.rstrip("/").rsplit("sf", 1)[-1],
        "lineitem_rows": lines,
        "lineitem_rows_per_sec": {n: round(lines / s) for n, s in seconds.items()},
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
