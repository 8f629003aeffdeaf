"""Queries on skewed events: one room and one uid have a third of the rows.

Makes $SKEW_ROWS events (10 million) below $SKEW_DIR (a new temporary folder), times the
preparation of the session table and then each query once on local[$BENCH_CPUS], and
reads from Spark's event log how the longest task of a stage compares with the median
one, over all stages that take longer than $SKEW_STAGE_S (1.5 s). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections import defaultdict
from pathlib import Path
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from roomtide.plans.queries import QUERIES, Given  # noqa: E402
from roomtide.session import build_session  # noqa: E402

NAMES = ("session_metrics", "new_viewers", "old_viewers", "dwell_gap_batch", "watch_sessions",
         "online_now", "peak_online_running")


def events(spark: SparkSession, rows: int) -> DataFrame:
    """A month of events; every third is of user 0 in the room `click`."""
    i, hot = F.col("id"), F.col("id") % 3 == 0
    spread = F.pmod(F.xxhash64("id"), F.lit(1 << 40))
    room = F.element_at(F.array(*map(F.lit, ("click", "error", "purchase", "signup", "view"))),
                        (spread % 5 + 1).cast("int"))
    return spark.range(rows, numPartitions=64).select(
        i.alias("event_id"),
        F.timestamp_seconds(F.lit(1704067200) + spread % (30 * 86400)).alias("ts"),
        F.when(hot, 0).otherwise(spread % 100_000).cast("bigint").alias("user_id"),
        F.when(hot, "click").otherwise(room).alias("event_type"),
        (spread % 1000 / 10).cast("double").alias("value"),
        F.format_string('{"k": %d}', spread % 200_000).alias("props"))


def task_seconds(log: Path) -> dict[int, list[float]]:
    stages = defaultdict(list)
    for file in log.iterdir():
        for line in file.open():
            if '"SparkListenerTaskEnd"' in line:
                e = json.loads(line)
                run = (e.get("Task Metrics") or {}).get("Executor Run Time", 0) / 1000
                stages[e["Stage ID"]].append(run)
    return stages


def main() -> None:
    folder = os.environ.get("SKEW_DIR") or tempfile.mkdtemp(prefix="skew-")
    rows, least = int(os.environ.get("SKEW_ROWS", 10_000_000)), float(os.environ.get("SKEW_STAGE_S", 1.5))
    cpus, log = os.environ.get("BENCH_CPUS", "8"), Path(folder, "log")
    log.mkdir(parents=True, exist_ok=True)
    spark = build_session("skew", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": str(4 * int(cpus)), "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": f"file://{log}", "spark.eventLog.compress": "false",
        "spark.eventLog.rolling.enabled": "false", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    if not Path(folder, "events.parquet").exists():
        events(spark, rows).write.parquet(f"{folder}/events.parquet")
    start = time.perf_counter()
    Given(spark, folder).session.count()
    times, last = {"session_preparation": round(time.perf_counter() - start, 2)}, 0
    stages_of = {}
    for name in NAMES:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 2)
        now = max(task_seconds(log), default=0) + 1
        stages_of[name], last = (last, now), now
    spark.stop()
    done = task_seconds(log)
    worst = {}
    for name, (a, b) in stages_of.items():
        long = [t for s, t in done.items() if a <= s < b and sum(t) > least and len(t) > 1]
        worst[name] = round(max((max(t) / max(median(t), 0.05) for t in long), default=1.0), 2)
    print(json.dumps({"metric": "skew", "rows": rows, "seconds": times, "longest_over_median": worst}))


if __name__ == "__main__":
    main()
