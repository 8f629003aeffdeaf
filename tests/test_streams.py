"""Streams over days, restarts and late rows: state, results and what is reported."""

import random
import shutil
import time
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import Row
from pyspark.sql import functions as F
from test_jobs import beat, table

from roomtide.functions import fixed
from roomtide.operators import rooms
from roomtide.plans import jobs
from roomtide.session import children, exists, keep_stream_state
from roomtide.sources import buckets, readers
from roomtide.streaming import dwell, feeds, late, online

MIDNIGHT = 1704412800  # 2024-01-05


def at(second):
    return datetime.fromtimestamp(MIDNIGHT + second)


class Held:
    """What a state store keeps for one key."""

    def __init__(self):
        self.value, self.timers = None, set()

    def getValueState(self, name, schema):  # noqa: N802
        return self

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, at):  # noqa: N802
        self.timers.add(at)


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.ms


def gaps(seconds):
    s = sorted(set(seconds))
    return sum(b - a if b - a <= 31 else 15 for a, b in zip(s, s[1:]))


@pytest.mark.parametrize("seed", range(6))
def test_running_dwell_of_a_day_in_any_order_has_constant_state(seed):
    rng = random.Random(seed)
    late, key = 60, (MIDNIGHT // 86400, "r", "t", "v")
    held = Held()
    run = dwell.RunningDwell()
    run.init(held)
    beats = sorted(MIDNIGHT + rng.randrange(0, 80000) for _ in range(rng.choice((3, 400, 9000))))
    arrived = sorted(beats, key=lambda s: s + rng.random() * late)
    seen, watermark, i = [], 0, 0
    while i < len(arrived):
        batch = arrived[i:i + rng.choice((1, 5, 200))]
        i += len(batch)
        out = list(run.handleInputRows(key, iter([Row(sec=s) for s in batch]), Clock(watermark * 1000)))
        seen += batch
        assert (out[0]["seconds"], out[0]["last"]) == (gaps(seen), max(seen))
        watermark = max(watermark, max(seen) - late)
        for due in sorted(t for t in held.timers if t <= watermark * 1000):
            held.timers.discard(due)
            told = list(run.handleExpiredTimer(key, Clock(watermark * 1000), None))
            if told:
                assert max(seen) + 35 < watermark + 1
                assert (told[0]["seconds"], told[0]["last"]) == (gaps(seen) + 15, None)
        assert len(held.timers) == 1 and len(held.value[2]) <= late + 1 + len(set(batch))
    # Once the day is over for good, nothing is kept.
    end = Clock((MIDNIGHT + 86400) * 1000)
    for _ in range(3):
        if held.value:
            held.timers.clear()
            list(run.handleExpiredTimer(key, end, None))
    assert held.value is None and not held.timers


def day_of_files(spark, path, first, last, step=600, viewers=3, every=10):
    for begin in range(first, last, step):
        table(spark, "heartbeat", [
            beat(at(s), uid=str(v)) for v in range(viewers)
            for s in range(begin, begin + step, every) if (s // 100 + v) % 4]).coalesce(1) \
            .write.mode("append").parquet(path)


def run_dwell(spark, path, out, mark):
    keep_stream_state(spark)
    stream = readers.stream_files(spark, readers.SCHEMAS["heartbeat"], path, max_files=1)
    query = dwell.dwell_state(stream).writeStream.outputMode("update").foreachBatch(
        feeds.batch_writer(out)).option("checkpointLocation", mark).trigger(availableNow=True).start()
    query.awaitTermination()
    return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]


def test_dwell_stream_is_flat_and_restarts_within_a_day(spark, tmp_path):
    path, out, mark = (str(tmp_path / n) for n in ("in", "out", "c"))
    day_of_files(spark, path, 0, 6000)
    kept = run_dwell(spark, path, out, mark)
    day_of_files(spark, path, 6000, 12000)
    kept += run_dwell(spark, path, out, mark)
    assert len(kept) >= 20 and max(kept[2:]) <= kept[2] + 3
    updates = spark.read.parquet(out)
    got = dwell.latest(updates, F.lit(MIDNIGHT + 90000))
    want = rooms.dwell_gaps(spark.read.parquet(path))
    assert rows(got.select("viewer", "seconds")) == rows(want.select("viewer", "seconds"))
    # The stream tells a silence by itself once its watermark is past it.
    assert updates.where("last IS NULL").count() > 0


def online_figures(spark, path, out, mark, max_files=1):
    keep_stream_state(spark)
    stream = readers.stream_files(spark, readers.SCHEMAS["heartbeat"], path, max_files=max_files)
    query = online.online_now(stream).writeStream.outputMode("append").foreachBatch(
        feeds.batch_writer(out)).option("checkpointLocation", mark).trigger(availableNow=True).start()
    query.awaitTermination()
    return query.recentProgress


def closed(figures, newest):
    return rows(figures.where(F.unix_seconds("window_end") <= newest - 5)
                .select("window_end", "online"))


def test_online_counts_go_on_in_the_middle_of_a_window(spark, tmp_path):
    path, out, mark = (str(tmp_path / n) for n in ("in", "out", "c"))
    for first, last in ((0, 95), (95, 123), (123, 300)):
        table(spark, "heartbeat", [beat(at(s), uid=str(v)) for v in range(4)
                                   for s in range(first, last) if (s // 7 + v) % 3]).coalesce(1) \
            .write.mode("append").parquet(path)
        online_figures(spark, path, out, mark)
    got = spark.read.parquet(out)
    want = rooms.online_now(spark.read.parquet(path))
    assert closed(got, MIDNIGHT + 299) == closed(want, MIDNIGHT + 299)
    assert got.count() > 20


def test_heartbeats_of_a_tick_are_one_before_windows_copy_them(spark, tmp_path):
    path = str(tmp_path / "in")
    # Three heartbeats a second of two viewers, all in one tick.
    table(spark, "heartbeat", [beat(at(100 + s // 3), uid=str(v)) for v in range(2) for s in range(12)]) \
        .coalesce(1).write.parquet(path)
    told = online_figures(spark, path, str(tmp_path / "out"), str(tmp_path / "c"))[0]
    state = {s["operatorName"]: s["numRowsTotal"] for s in told["stateOperators"]}
    assert state["dedupeWithinWatermark"] == 2
    assert all(n <= 12 for n in state.values())


def test_late_rows_are_told(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "late")
    listener = late.LateRows(spark, out)
    spark.streams.addListener(listener)
    try:
        for times in ((0, 10, 400), (405, 3, 4, 5, 410), (500,)):
            table(spark, "heartbeat", [beat(at(s), uid=f"u{s}") for s in times]).coalesce(1) \
                .write.mode("append").parquet(path)
            online_figures(spark, path, str(tmp_path / "out"), str(tmp_path / "c"))
        deadline = time.time() + 60
        while not exists(spark, f"{out}/_SUCCESS") and time.time() < deadline:
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(listener)
    told = spark.read.parquet(out)
    assert rows(told.select("late", "arrived")) == [(3, 5)]
    assert told.first()["watermark"].startswith("2024-01-05T00:06:35")


def test_day_averages_from_kept_sketches(spark, tmp_path):
    path, keep = str(tmp_path / "s"), online.sketch_keeper(str(tmp_path / "s"))
    batches = [table(spark, "heartbeat", [
        beat(at(600 * n + i % 600), device="" if i % 50 == 0 else f"d{(i * 7 + n * 500) % 9000}",
             room=f"r{i % 3}") for i in range(4000)]).cache() for n in range(6)]
    every = batches[0].limit(0)
    for number, batch in enumerate(batches):
        every = every.unionByName(batch)
        for _ in range(1 + number % 2):  # a repeated batch counts once
            keep(batch, number)
    asked = spark.createDataFrame([("r0", fixed.ROOM_VIDEO), ("r2", fixed.ROOM_VIDEO)],
                                  "extra_id string, type string")
    about = rooms.points_of_sketches(buckets.read(spark, path))
    exact = rooms.room_points_devices(every, "2024-01-05", "2024-01-06")
    both = about.toDF("extra_id", "type", "p", "n").join(exact, ["extra_id", "type"]).collect()
    assert len(both) == 3
    for r in both:
        assert r["points"] == r["p"]
        # Three standard errors of the sketch.
        assert abs(r["n"] / r["device_id_count"] - 1) < 3 * 1.04 / 2 ** (rooms.SKETCH_BITS / 2)
    average = online.average_of_day(spark, path, F.lit("2024-01-05 00:30:00").cast("timestamp"))
    assert [r[0] for r in rows(average(asked).select("extra_id"))] == ["r0", "r2"]
    assert average(asked.where("false")) is None


def test_sketches_are_merged_and_old_days_go(spark):
    old = table(spark, "heartbeat", [beat(at(s - 3 * 86400), device="x") for s in (1, 2)])
    new = table(spark, "heartbeat", [beat(at(s), device=str(s)) for s in (1, 2, 2, 70)])
    parts = rooms.device_sketches(old).unionByName(rooms.device_sketches(new)) \
        .unionByName(rooms.device_sketches(new))
    got = rooms.merge_sketches(parts).select(
        F.unix_seconds("minute") - MIDNIGHT, "points", F.hll_sketch_estimate("devices"))
    assert rows(got) == [(0, 6, 2), (60, 2, 1)]


def test_a_compaction_that_ended_halfway_is_made_up_for(spark, tmp_path):
    path = str(tmp_path / "b")
    write = feeds.batch_writer(path)
    for n in range(4):
        write(spark.range(n + 1), n)
    copied = str(tmp_path / "copy")
    shutil.copytree(path, copied)
    feeds.compact(spark, path, 2)
    # As if it had ended before it removed what it gathered.
    for n in (0, 1):
        shutil.copytree(f"{copied}/batch={n}", f"{path}/batch={n}")
    write(spark.range(5), 4)
    feeds.compact(spark, path, 3)
    got = spark.read.parquet(path)
    assert got.count() == 15 and len(children(spark, path)) <= 3


def test_comments_of_a_period(spark, tmp_path):
    said = [("u", "n", "r", text, when, "t") for text, when in (
        ("a", "2024-01-05T00:30:00+00:00"), ("b", "2024-01-05T23:59:59+00:00"),
        ("c", "2024-01-06T01:00:00+08:00"), ("d", "2024-01-07T00:00:00+00:00"), ("", "2024-01-05T01:00:00+00:00"),
        ("e", ""), ("f", "soon"))]
    tables, out = str(tmp_path / "t"), str(tmp_path / "o")
    table(spark, "room_comment", said).write.parquet(f"{tables}/room_comment")
    for _ in range(2):
        jobs.main(["comments", "2024-01-05", "2024-01-06", "--tables", tables, "--out", out])
    got = spark.read.parquet(out).select("content", "c_time", F.col("dt").cast("string"))
    assert rows(got) == [("a", "2024-01-05 08:30:00", "2024-01-05"), ("b", "2024-01-06 07:59:59", "2024-01-05"),
                         ("c", "2024-01-06 01:00:00", "2024-01-05")]
