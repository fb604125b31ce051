"""Time the headline queries: one JSON line on standard output.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the local cores,
``BENCH_RUNS`` the timed runs per query (median) after one warm-up.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from transitlake.session import build  # noqa: E402
from workloads import QUERIES  # noqa: E402

HEADLINE = """
latest_order_per_customer endpoints_per_user user_first_last_fused lag_event_gap lag_event_gap_hot_keys
flag_late_ship star_left_distinct composite_left array_member_join lookup_enrich recent_slice
diff_append bag_diff_keeps_dups gtfs_time_normalize haversine_pairs sliding_window_counts
motion_windows stream_windows stg_stop_times stg_real_stop_times stg_routes dim_routes
service_days fact_trips dim_historical_trips trip_kpis_by_line_direction trip_kpis_by_date
live_vehicles dq_unique dq_suite date_dimension csv_multipart zip_members incremental_load
""".split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.sql.shuffle.partitions": cpus,
            # the bench tables are small; let AQE keep all cores busy with them
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in names:
        times = []
        for attempt in range(runs + 1):
            began = time.perf_counter()
            # building is part of the time; the sink takes every row and column
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            if attempt:
                times.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(times), 3)
        if os.environ.get("BENCH_ROWS"):
            rows[name] = QUERIES[name](spark, folder).count()
        print(f"{name:32s} {seconds[name]:7.3f}", rows.get(name, ""), file=sys.stderr, flush=True)
    found = re.search(r"sf([0-9.]+)", folder)
    result = {
        "metric": "total_median_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(found.group(1)) if found else folder,
    }
    if rows:
        result["rows"] = rows
    print(json.dumps(result))


if __name__ == "__main__":
    main()
