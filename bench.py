"""Benchmark: run the headline jobs on the driver tables and print ONE JSON line.

    BENCH_SF_DIR  (default /root/testdata/sf0.1)   input tables
    BENCH_CPUS    (default 8)                      local[N]

Stand-in source tables are stored once first (reported as ``setup_sec``, not in the
total).  Each query is executed in full with the ``noop`` sink (every row computed, none
collected to the driver), three times; the middle time counts.  The statistics and marts read the
dimension, locations, users and statistics that were stored once (by the first of them), as the
daily run does; ``first_sec`` has the first time of each query, that storing included."""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "trailing_windows", "song_features", "song_influence", "singer_influence", "top_influence",
    "song_dim", "machine_dim", "machine_location", "consumption_detail", "machine_stats", "merchant_share",
    "region_stats", "active_users", "newly_active_users", "client_log_parse",
]
STANDINS = ["plays", "songs", "songs_raw", "client_log", "mac_a", "mac_b", "mac_addr", "prvc_lookup", "cty_lookup",
            "area_lookup", "store_map", "store", "cnsm", "users", "logins", "loc_reports", "loc_lookup"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))

    from encore.registry import build
    from encore.session import build_session
    from encore.sources.standins import standin

    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app="encore-bench",
                          extra={"spark.driver.memory": "16g"})
    t0 = time.time()
    for name in STANDINS:
        standin(spark, sf_dir, name)
    setup = time.time() - t0

    queries = build().queries
    times: dict[str, float] = {}
    first: dict[str, float] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(3):
            t = time.time()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(round(time.time() - t, 3))
        first[name], times[name] = runs[0], median(runs)
    total = round(sum(times.values()), 3)

    # The daily jobs end to end over stored tables (each table computed once, read by the
    # next job), as a scheduler would run them: yesterday first, then the analysis day.
    from encore import jobs
    from encore.session import scratch_path
    from encore.sources.standins import build_warehouse

    root = scratch_path(spark, "bench-warehouse")
    build_warehouse(spark, sf_dir, root)
    wh = jobs.Warehouse(spark, root)
    jobs.run_day(wh, "20240129")
    t = time.time()
    jobs.run_day(wh, "20240130")
    daily = round(time.time() - t, 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_headline_sec", "value": total, "unit": "sec", "queries": times,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": cpus,
                      "first_sec": first, "setup_sec": round(setup, 3), "daily_run_sec": daily}))
    spark.stop()


if __name__ == "__main__":
    main()
