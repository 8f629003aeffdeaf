"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then `$BENCH_RUNS` times; the best time
counts. Results go to the noop sink, so everything is computed and nothing is
collected. Preparing the schedule table is not timed.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roomtide.plans.queries import QUERIES  # noqa: E402
from roomtide.session import build_session  # noqa: E402

HEADLINE = (
    "session_metrics", "session_view_metrics", "session_comment_metrics",
    "session_gift_income", "session_heartbeats", "new_viewers", "viewer_identity_set",
    "planner_rollup", "metrics_refresh", "metrics_upsert", "points_by_viewer_sec",
    "room_points_devices", "online_now", "online_with_average", "peak_online_running",
    "dwell_gap_batch", "watch_sessions", "slot_event_all", "slot_banner", "pv_uv_planner",
    "heartbeat_flatten", "heartbeat_repair", "minute_coverage", "online_now_stream",
    "dwell_stretches_stream", "dwell_state",
)


def fixed_work(spark) -> float:
    """Seconds of a job that no change of this repository touches: a slower machine shows in
    it, slower code does not."""
    start = time.perf_counter()
    spark.range(20_000_000).selectExpr("sum(xxhash64(id) % 1000)", "count(DISTINCT id % 100000)").collect()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    control = []
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(min(taken[1:]), 3)
        control.append(fixed_work(spark))
    found = re.search(r"sf([0-9.]+)/?$", sf_dir)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "control": round(sorted(control)[len(control) // 2], 3),
        "sf": float(found.group(1)) if found else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
