import random
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_sessions import at, beat, table

from roomtide.functions import fixed
from roomtide.operators import records, reports, rooms
from roomtide.operators import viewers as vw
from roomtide.sources import scans, sinks
from roomtide.streaming import dwell


def test_online_window_bounds(spark):
    beats = table(spark, "heartbeat", [beat(at("10:00:00")), beat(at("10:00:05"), "", "d9"),
                                       beat(at("10:00:06"), "u", "other"),
                                       beat(at("10:00:06"), "x", room="null"),
                                       beat(at("10:00:06"), "x", is_online="0"),
                                       beat(at("10:00:06"), "", "")])
    got = {r["window_end"]: r["online"] for r in rooms.online_now(beats).collect()}
    assert got[at("10:01:00")] == 2 and at("10:01:10") not in got
    assert len(got) == 6


GAPS = [0, 10, 41, 73, 73]   # gaps of 10, 31, 32 and 0 seconds


def test_dwell_gaps(spark):
    beats = table(spark, "heartbeat", [beat(at("10:59:00"))])
    assert rooms.dwell_gaps(beats).first()["seconds"] == 15
    times = [at("10:58:50").timestamp() + g for g in GAPS]
    beats = table(spark, "heartbeat", [beat(datetime.fromtimestamp(t)) for t in times])
    assert rooms.dwell_gaps(beats).first()["seconds"] == 10 + 31 + 15 + 0 + 15


def test_latest_dwell(spark):
    """The newest batch of a key counts; a silence of more than 35 s is worth 15 s."""
    kinds = "day string, extra_id string, type string, viewer string, seconds bigint, last bigint, batch int"
    updates = spark.createDataFrame([("d", "r", "t", "a", 9, 109, 0), ("d", "r", "t", "a", 56, 173, 1),
                                     ("d", "r", "t", "b", 0, 190, 1)], kinds)
    assert dwell.newest_second(updates) == 190
    for as_of, a in ((208, 56), (209, 71)):
        got = dwell.latest(updates, F.lit(as_of)).select("viewer", "seconds")
        assert rows(got) == [("a", a), ("b", 0)]


def test_watch_sessions(spark):
    beats = table(spark, "heartbeat", [beat(at(t)) for t in (
        "10:00:00", "10:00:35", "10:00:35", "10:01:11")])
    got = rows(rooms.watch_sessions(beats).select("started", "ended", "beats"))
    assert got == [(at("10:00:00"), at("10:01:10"), 3), (at("10:01:11"), at("10:01:46"), 1)]


def test_peak_online_running(spark):
    ticks = spark.createDataFrame(
        [(at("10:00:00", d), "r", "t", n) for d, n in ((1, 5), (2, 3), (3, 9))]
        + [(at("11:00:00", 2), "r", "t", 4)],
        "window_end timestamp, extra_id string, type string, online bigint")
    got = rows(rooms.peak_online_running(ticks).select("window_end", "peak"))
    assert [p for _, p in got] == [5, 5, 5, 9]


def test_average_dwell(spark):
    points = spark.createDataFrame(
        [("r", fixed.ROOM_VIDEO, 7, 4), ("", fixed.ROOM_VIDEO, 7, 4), ("null", fixed.ROOM_TEXT, 1, 1),
         ("s", "other", 1, 1)], "extra_id string, type string, points bigint, device_id_count bigint")
    assert rows(rooms.average_dwell(points)) == [("r", fixed.ROOM_VIDEO, 52)]


def test_points(spark):
    beats = table(spark, "heartbeat", [beat(at("10:00:00")), beat(at("10:00:10"), second=None),
                                       beat(at("10:00:20")), beat(at("10:00:21"))])
    got = rows(vw.points_by_viewer(beats, "2024-01-01 10:00:00", "2024-01-01 10:00:20",
                                   by_second=True).select("sec", "points"))
    assert got == [("10", 2), ("30", 1)]


def test_approximate_devices_near_exact(spark, sf_dir):
    from roomtide.sources import fixtures
    beats = fixtures.heartbeat(spark, sf_dir)
    keys = ["extra_id", "type"]
    exact = rooms.room_points_devices(beats, "2000-01-01", "2100-01-01")
    close = rooms.room_points_devices(beats, "2000-01-01", "2100-01-01", approximate=True) \
        .withColumnRenamed("device_id_count", "about")
    for r in exact.join(close, keys).collect():
        assert abs(r["about"] - r["device_id_count"]) <= max(3, 0.2 * r["device_id_count"])


def test_slices_are_half_open(spark):
    df = spark.createDataFrame([(at("00:00:59"),), (at("00:01:00"),), (at("23:59:59"),)], "t timestamp")
    got = {r["slice_from"]: (r["slice_to"], r["n"])
           for r in rooms.slice_coverage(df, "t").collect()}
    assert len(got) == 1440
    assert got["00:00:00"] == ("00:01:00", 1) and got["00:01:00"][1] == 1
    assert got["23:59:00"] == ("24:00:00", 1)
    assert rooms.slice_coverage(df, "t", 30).count() == 2880


def test_scan_bounds(spark):
    beats = table(spark, "heartbeat", [beat(at("10:00:00")), beat(at("10:01:00")),
                                       beat(at("10:00:30"), type=fixed.BIG_LIVE)])
    args = ("2024-01-01 10:00:00", "2024-01-01 10:01:00")
    assert scans.heartbeats(beats, *args).count() == 1
    assert scans.heartbeats(beats, *args, closed=True).count() == 2
    assert scans.heartbeats(beats, *args, types=None).count() == 2
    assert scans.heartbeats(beats, *args, room="other").count() == 0


def test_date_spine(spark):
    assert [str(r[0]) for r in scans.date_spine(spark, "2024-02-28", "2024-03-01").collect()] == [
        "2024-02-28", "2024-02-29", "2024-03-01"]
    assert scans.date_spine(spark, "2024-03-01", "2024-02-28").count() == 0


def log(action, params=None, data=None, device="d", time="10:00:00"):
    return {"log_time": at(time), "deviceId": device, "action": action, "params": params,
            "data": data, "uid": "5", "client_ip": "ip"}


def test_reports(spark):
    view, page = fixed.VIEW_DETAIL_ACTION, fixed.PLANNER_PAGE_ACTION
    logs = table(spark, "api_log", [
        log(view, '{"get":{"v_id":"1"}}'), log(view, '{"get":{"v_id":"1"}}'),
        log(view, '{"get":{"v_id":"1"}}', device="e"), log(view, '{"get":{}}'),
        log(view, 'broken v_id', device=None), log(view, None),
        log(page, data='{"data":{"planner":{"planner_info":{"p_uid":"9"}}}}'),
        log(fixed.DYNAMIC_DETAIL_ACTION, '{"post":{"dynamic_id":"3"}}')])
    span = ("2024-01-01", "2024-01-02")
    assert rows(reports.view_details(logs, *span).select("v_id", "uv", "pv")) == [
        ("", 1, 1), ("1", 2, 3)]
    assert rows(reports.planner_pages(logs, *span).select("puid", "uv", "pv")) == [("9", 1, 1)]
    assert rows(reports.dynamic_details(logs, *span).select("dynamic_id", "count")) == [("3", 1)]


def test_repair(spark):
    logs = table(spark, "api_log", [log(
        fixed.HEARTBEAT_ACTION, '{"get":{"type":"t","extra_id":"r","is_small_window":"1","fr":null},'
        '"header":{"referer":"z"}}')])
    row = records.heartbeat_repair(logs, "2024-01-01 10:00:00", "2024-01-01 10:00:00").first()
    assert row["logtime"] == "2024-01-01T10:00:00+00:00" and row["c_time"] == "2024-01-01 10:00:00"
    assert (row["ext"], row["fr"], row["refer"], row["p_uid"], row["u_type"], row["is_insert"]) == (
        '{"is_small_window":"1"}', "null", "z", "", 1, "1")


def test_partition_writes(spark, tmp_path):
    path = str(tmp_path / "days")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "v int, dt string") \
        .withColumn("dt", F.col("dt").cast("date"))
    for _ in range(2):
        sinks.write_days(df, path)
    sinks.write_days(df.where("v = 2").withColumn("v", F.lit(9)), path)
    assert rows(spark.read.parquet(path).select("v")) == [(1,), (9,)]
    sinks.write_day(df.where("v > 5").select("v"), path, "2024-01-01")
    assert rows(spark.read.parquet(path).select("v")) == [(9,)]


def test_versions(spark, tmp_path):
    path = str(tmp_path / "versions")
    one = spark.createDataFrame([(1,)], "v int")
    sinks.write_version(one, path, 1)
    sinks.write_version(sinks.read_version(spark, path).selectExpr("v + 1 as v"), path, 2)
    assert rows(sinks.read_version(spark, path)) == [(2,)]
    assert rows(sinks.read_version(spark, path, 1)) == [(1,)]


@pytest.mark.parametrize("columns", [("a", "b")])
def test_json_snapshot_round_trip(spark, columns):
    df = spark.createDataFrame([(1, 2.5, at("10:00:00"))], "a bigint, b double, t timestamp")
    snap = records.json_snapshot(df, "a", ("a", "b", "t"))
    assert rows(snap) == [("1", '{"a":"1","b":"2.5","t":"2024-01-01 10:00:00"}')]
    assert rows(records.flatten(snap.select("value"), "value", ("b", "missing"))) == [("2.5", "")]


def test_watch_sessions_over_midnights(spark):
    """Days are stitched; the stretches are those of one session window over all."""
    rng = random.Random(5)
    midnight = datetime(2024, 1, 5).timestamp()
    data = []
    for v in range(12):
        t = midnight - 3 * 86400 + rng.randrange(86400)
        while t < midnight + 2 * 86400:
            # Some watch without end, some stop and come back, around midnight more often.
            near = abs((t - midnight) % 86400 - 86400) < 400 or (t - midnight) % 86400 < 400
            t += rng.choice((1, 34, 35) if v % 3 == 0 and near else (1, 34, 35, 36, 50) if near else ((30, 35) if v % 3 == 0 else (20, 4000, 9000)))
            data.append(beat(datetime.fromtimestamp(t), uid=str(v)))
    beats = table(spark, "heartbeat", data)
    plain = (rooms.presence(beats).groupBy("viewer", F.session_window("logtime", "35 seconds").alias("w"))
             .agg(F.count("*").alias("beats")).select("viewer", "w.start", "w.end", "beats"))
    got = rooms.watch_sessions(beats).select("viewer", "started", "ended", "beats")
    assert rows(got) == [tuple(r) for r in rows(plain)]
    assert max((r[2] - r[1]).total_seconds() for r in rows(got)) > 2 * 86400
    # The window merges within a viewer's day.
    lines = rooms.watch_segments(beats)._jdf.queryExecution().analyzed().toString().splitlines()
    assert any("session_window" in x and "to_date(at" in x for x in lines if "Aggregate" in x)
