"""The jobs on literal frames: reruns, neighbouring ranges, empty stores, zones, restarts."""

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from roomtide.functions import fixed
from roomtide.operators import viewers as vw
from roomtide.plans import jobs
from roomtide.session import children, exists, matching, shared_dir
from roomtide.sources import buckets, readers, scans, sinks
from roomtide.streaming import dwell, feeds, refresh


def table(spark, name, data):
    return spark.createDataFrame(data, readers.SCHEMAS[name])


def beat(at, device="d", uid="7", room="r"):
    return (str(at), device, "", room, None, "", "1", at, "1", None, "", "", fixed.ROOM_VIDEO, "1",
            uid, "30")


def show(n, start, end, room="r", status=0):
    return (n, room, 2, 1, "t", start, end, status, 4, 1, 0)


def day(d, h=0, m=0, s=0):
    return datetime(2024, 1, d, h, m, s)


@pytest.fixture
def utc(spark):
    yield
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_session_over_midnight_run_day_by_day(spark, tmp_path):
    sessions = table(spark, "session", [
        show(1, day(4, 10), day(4, 11)), show(2, day(5, 23), day(6, 2)), show(3, day(7, 10), day(7, 11))])
    beats = table(spark, "heartbeat", [beat(t) for t in (
        day(4, 10, 30), day(5, 23, 30), day(6, 1), day(6, 2), day(6, 3), day(7, 10, 5))])
    out = str(tmp_path / "o")
    want = [(1, "2024-01-04"), (2, "2024-01-05"), (2, "2024-01-06"), (2, "2024-01-06"), (3, "2024-01-07")]
    for d in ("2024-01-04", "2024-01-05", "2024-01-06", "2024-01-07"):
        jobs.extract_session_heartbeats(beats, sessions, d, d, out)
    for d in ("2024-01-07", "2024-01-05"):
        jobs.extract_session_heartbeats(beats, sessions, d, d, out)
        got = spark.read.parquet(out).select("live_id", F.col("dt").cast("string"))
        assert rows(got) == want


def test_neighbouring_repairs_keep_every_row(spark, tmp_path):
    params = '{"get":{"type":"x","extra_id":"r"},"header":{"referer":"f"}}'
    logs = [(day(5, 10, m), "d", fixed.HEARTBEAT_ACTION, None, params, "7", "ip")
            for m in (1, 5, 10, 15, 20, 25)]
    api, out = table(spark, "api_log", logs), str(tmp_path / "o")
    for first, last in ((0, 10), (10, 20), (10, 20), (20, 30), (0, 10)):
        jobs.repair_heartbeats(api, f"2024-01-05 10:{first:02}:00", f"2024-01-05 10:{last:02}:00", out)
    got = spark.read.parquet(out)
    assert got.drop("is_insert", "dt").schema.simpleString() == \
        table(spark, "heartbeat", []).select(*fixed.HEARTBEAT_COLUMNS).schema.simpleString()
    assert [r[0].minute for r in rows(got.select("logtime"))] == [1, 5, 10, 15, 20, 25]


def test_heartbeat_job_defaults_and_emptied_days(spark, tmp_path):
    out = str(tmp_path / "o")
    full = table(spark, "heartbeat", [beat(day(5, 1)), beat(day(6, 1))])
    jobs.extract_heartbeats(full, "2024-01-05", "2024-01-06", out)
    row = spark.read.parquet(out).where("dt = '2024-01-05'").first()
    assert (row["fr"], row["record_type"]) == ("", "")
    jobs.extract_heartbeats(full.where("dayofmonth(logtime) = 6"), "2024-01-05", "2024-01-06", out)
    assert [str(r["dt"]) for r in spark.read.parquet(out).collect()] == ["2024-01-06"]


def live_tables(spark):
    # Read once: the tables must not change while the clock goes on.
    now = F.timestamp_micros(F.lit(spark.sql("SELECT unix_micros(now())").first()[0]))
    sessions = table(spark, "session", [show(1, day(1), day(2), status=0)]).unionByName(
        spark.range(1).select(
            F.lit(2).cast("bigint").alias("id"), F.lit("r").alias("circle_id"), F.lit(2).alias("u_type"),
            F.lit(1).cast("bigint").alias("uid"), F.lit("t").alias("title"),
            F.date_trunc("day", now).alias("start_time"),
            (F.date_trunc("day", now) + F.expr("INTERVAL 30 HOURS")).alias("end_time"),
            F.lit(1).alias("live_status"), F.lit(4).alias("type"), F.lit(1).alias("audit"),
            F.lit(0).alias("status")))
    beats = table(spark, "heartbeat", [beat(day(1, 1))]).withColumn(
        "logtime", now - F.expr("INTERVAL 20 SECONDS"))
    return refresh.Tables(lambda: sessions, lambda: beats, lambda: table(spark, "comment", []),
                          lambda: table(spark, "income", []))


def test_refresh_from_an_empty_store_with_the_real_clock(spark, tmp_path):
    store = str(tmp_path / "store")
    run = jobs.refresh_target(spark, live_tables(spark), store)
    seen = []
    for number in (0, 1, 1):
        run(None, number)
        seen.append([rows(buckets.read(spark, f"{store}/{n}", number + 1))
                     for n in ("metrics", "live_info", "planners", "viewers")]
                    + [rows(sinks.read_version(spark, f"{store}/clock", number + 1))])
    assert [r[0] for r in seen[0][0]] == [2]  # the session of long ago is not polled
    assert seen[1] == seen[2] and seen[0][4] != seen[1][4]
    assert [r[1] for r in seen[0][3]] == ["7"]


def test_refreshes_leave_few_versions_and_no_work_folders(spark, tmp_path):
    store = str(tmp_path / "store")
    run = jobs.refresh_target(spark, live_tables(spark), store)
    app = f"{shared_dir(spark)}/roomtide/{spark.sparkContext.applicationId}"
    before = set(children(spark, app))
    for number in range(9):
        run(None, number)
    assert set(children(spark, app)) <= before
    assert sinks.versions(spark, f"{store}/clock") == [7, 8, 9]
    for name in ("metrics", "live_info", "planners", "viewers"):
        parts = matching(spark, f"{store}/{name}/buckets=64/bucket=*/part=*")
        assert [p[-1] for p in parts] == ["7", "8", "9"]
    # The uid was new in the first batch only.
    assert len(matching(spark, f"{store}/first_seen/buckets=64/bucket=*/part=*")) == 1
    assert buckets.read(spark, f"{store}/first_seen", 9).count() == 1


def test_batches_are_compacted(spark, tmp_path):
    path = str(tmp_path / "b")
    write = feeds.batch_writer(path)
    for n in range(5):
        write(spark.range(n + 1), n)
    for upto in (2, 3):
        feeds.compact(spark, path, upto)
        got = spark.read.parquet(path)
        assert got.count() == 15
        assert got.groupBy(F.coalesce("from_batch", "batch")).count().count() == 5
    assert children(spark, path)[-2:] == ["batch=3", "batch=4"] and exists(spark, path)


def test_dwell_state_does_not_grow_with_days(spark, tmp_path):
    path, schema = str(tmp_path / "in"), readers.SCHEMAS["heartbeat"]
    for d in range(1, 8):
        table(spark, "heartbeat", [beat(day(d, 10, 0, s), uid=str(u)) for u in range(5) for s in (0, 9)]) \
            .coalesce(1).write.mode("append").parquet(path)
    stream = readers.stream_files(spark, schema, path, max_files=1)
    states = dwell.dwell_state(stream).writeStream.outputMode("update").foreachBatch(
        feeds.batch_writer(str(tmp_path / "out"))).option(
        "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    states.awaitTermination()
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in states.recentProgress if p["stateOperators"]]
    assert max(kept) <= 20 and len(kept) >= 7
    updates = spark.read.parquet(str(tmp_path / "out"))
    total = dwell.latest(updates, F.lit(dwell.newest_second(updates)))
    assert rows(total.groupBy("seconds").count()) == [(9, 5), (24, 30)]


def test_feed_restarts_from_its_checkpoint(spark, tmp_path):
    path, out, mark = (str(tmp_path / n) for n in ("in", "out", "c"))
    for d in (1, 2, 3):
        table(spark, "heartbeat", [beat(day(d, 10))]).coalesce(1).write.mode("append").parquet(path)
        feed = feeds.heartbeat_feed(readers.stream_files(spark, readers.SCHEMAS["heartbeat"], path))
        feeds.files_writer(feed, out, mark).trigger(availableNow=True).start().awaitTermination()
        assert spark.read.parquet(out).count() == d


@pytest.mark.parametrize("zone,dt,offset", [("UTC", "2024-01-05", "+00:00"),
                                            ("Asia/Shanghai", "2024-01-06", "+08:00")])
def test_zone_decides_days_and_offsets(spark, tmp_path, utc, zone, dt, offset):
    from roomtide.operators import records
    logs = spark.sql("SELECT timestamp_seconds(1704474000) AS log_time").selectExpr(  # 17:00 UTC
        "log_time", "'d' AS deviceId", f"'{fixed.HEARTBEAT_ACTION}' AS action", "'' AS data",
        "'{}' AS params", "'' AS uid", "'' AS client_ip")
    tables, out = str(tmp_path / "t"), str(tmp_path / "o")
    logs.write.parquet(f"{tables}/api_log")
    jobs.main(["repair", dt, dt, "--tables", tables, "--out", out, "--zone", zone])
    assert children(spark, out)[-1] == f"dt={dt}"
    text = records.heartbeat_repair(logs, "2024-01-01", "2024-02-01").first()["logtime"]
    assert text.endswith(offset)
    assert spark.sql(f"SELECT unix_timestamp(timestamp '{text}')").first()[0] == 1704474000


def test_entry_points(spark, tmp_path, utc):
    tables, out = str(tmp_path / "t"), str(tmp_path / "o")
    given = live_tables(spark)
    for name in ("session", "heartbeat", "comment", "income"):
        getattr(given, name)().write.parquet(f"{tables}/{name}")
    table(spark, "room_comment", [("u", "n", "r", "hello", "2024-01-01T10:00:00+08:00", "t")]) \
        .write.parquet(f"{tables}/room_comment")
    jobs.main(["refresh", "--tables", tables, "--out", out, "--checkpoint", f"{out}-c", "--once"])
    jobs.main(["snapshot", "2024-01-05", "2024-01-05", "--tables", out, "--out", f"{out}-days"])
    assert spark.read.parquet(f"{out}-days/live_visit_count").count() == 1
    jobs.main(["online", "--tables", tables, "--out", f"{out}-on", "--checkpoint", f"{out}-oc", "--once"])
    assert spark.read.parquet(f"{out}-on/comments").count() == 1
    with pytest.raises(SystemExit):
        jobs.main(["refresh", "--tables", tables, "--out", out])


def test_repeated_members(spark):
    from roomtide.functions.jsonx import field, json_map
    df = spark.createDataFrame([('{"a":"1","b":"x","a":null,"a":"2"}',), ('{"a":"1"}',), ("[1]",)], "t string")
    got = rows(df.select(F.size(json_map(F.col("t"))).alias("n"),
                         field(json_map(F.col("t")), "a").alias("a")))
    assert got == [(0, ""), (1, "1"), (2, "2")]


def test_plans(spark, sf_dir):
    """One scan for the token search; windows of online counts and peaks hold a day."""
    from roomtide.plans.queries import QUERIES
    plan = lambda n: QUERIES[n](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan("api_log_token_scan").count("Relation [") == 1
    assert "day" in [x for x in plan("online_now").splitlines() if "Window [lead" in x][0]
    assert "_day" in [x for x in plan("peak_online_running").splitlines() if "Window [max(online" in x][0]


def test_clocks_of_clients_across_midnight_blank_or_wrong(spark, tmp_path):
    """Every row is on its own day once, whatever the order of the runs."""
    sessions = table(spark, "session", [show(1, day(4, 10), day(8, 10))])
    at, said = day(6, 0, 0, 1), day(5, 23, 59, 59)
    clocks = [(at, str(said), "05"), (day(5, 23, 59, 59), str(day(6, 0, 0, 1)), "06"),
              (day(5, 12), "", "05"), (day(6, 12), "1704542400", "06"), (day(6, 13), None, "06"),
              (day(6, 14), "2023-12-01 00:00:00", "06"), (day(7, 0), str(day(6, 0)), "06"),
              (day(7, 0, 0, 1), str(day(6, 0)), "07"), (day(6, 15), "soon", "06")]
    beats = table(spark, "heartbeat", [(s, *beat(t, device=f"d{i}")[1:])
                                       for i, (t, s, _) in enumerate(clocks)])
    want = sorted((f"d{i}", f"2024-01-{d}") for i, (_, _, d) in enumerate(clocks))
    days = [f"2024-01-0{d}" for d in range(4, 9)]
    for n, order in enumerate((days, days[::-1], [*days[::2], *days[1::2], *days])):
        out = str(tmp_path / str(n))
        for d in order:
            jobs.extract_session_heartbeats(beats, sessions, d, d, out)
        got = spark.read.parquet(out)
        assert rows(got.select("device_id", F.col("dt").cast("string"))) == want
        assert "logtime" not in got.columns


def scanned(df):
    """The scans of a plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan" in line]


def test_tables_kept_by_day_are_read_by_day(spark, tmp_path):
    tables, out = str(tmp_path / "t"), str(tmp_path / "o")
    sessions = table(spark, "session", [show(n, day(n, 10), day(n, 12)) for n in range(1, 9)])
    beats = table(spark, "heartbeat", [beat(day(n, 11, m), device=f"d{m % 3}") for n in range(1, 9)
                                       for m in range(20)])
    plain = vw.viewer_dwell(beats, vw.windows(sessions.where("id IN (3, 4)")))
    jobs.extract_heartbeats(beats, "2024-01-01", "2024-01-08", f"{tables}/heartbeat")
    kept = readers.read_files(spark, "heartbeat", f"{tables}/heartbeat")
    assert kept.columns[-1] == "dt"
    by_day = vw.viewer_dwell(kept, vw.windows(sessions.where("id IN (3, 4)")))
    assert rows(by_day) == rows(plain) and by_day.columns == plain.columns
    assert "dt" in scanned(by_day)[0].split("PartitionFilters: [")[1].split("]")[0]
    one = scans.heartbeats(kept, "2024-01-03", "2024-01-04")
    assert "dt" in scanned(one)[0].split("PartitionFilters: [")[1].split("]")[0]
    # The whole job on tables by day.
    sessions.write.parquet(f"{tables}/session")
    for name, at_column in (("comment", "c_time"), ("income", "c_time")):
        table(spark, name, []).withColumn("dt", F.to_date(at_column)).write.parquet(f"{tables}/{name}/dt=2024-01-01")
    jobs.main(["sessions", "2024-01-01", "2024-01-09", "--tables", tables, "--out", out])
    got = buckets.read(spark, f"{out}/metrics")
    assert rows(got.select("live_id", "view_count")) == [(n, 3) for n in range(1, 9)]
    jobs.main(["session-heartbeats", "2024-01-03", "2024-01-04", "--tables", tables, "--out", f"{out}-h"])
    assert spark.read.parquet(f"{out}-h").count() == 40


def test_facts_in_buckets_are_joined_where_they_lie(spark, tmp_path):
    from roomtide.operators import intervals
    spark.sql(f"CREATE DATABASE IF NOT EXISTS placed LOCATION '{tmp_path}/placed'")
    facts = spark.range(3000).select(
        F.concat(F.lit("r"), (F.col("id") % 37).cast("string")).alias("room"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 211).alias("t")).withColumn(
            "dt", F.to_date("t"))
    spans = spark.range(200).select(
        F.col("id"), F.concat(F.lit("r"), (F.col("id") % 37).cast("string")).alias("key"),
        F.timestamp_seconds(F.lit(1704067200 + 86400) + F.col("id") * 900).alias("start_time"),
        F.timestamp_seconds(F.lit(1704067200 + 97000) + F.col("id") * 1700).alias("end_time"))
    settings = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        sinks.write_placed(facts, "placed.facts", "room", 8)
        join = dict(key=("room", "key"), at="t", broadcast_rows=0)
        got = intervals.covered_by(spark.table("placed.facts"), spans, placed=True, **join)
        plan = got._jdf.queryExecution().executedPlan().toString()
        want = intervals.covered_by(facts, spans, **join)
        assert rows(got) == rows(want) and got.columns == want.columns and got.count() > 100
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.sql("DROP DATABASE placed CASCADE")
    side = plan.splitlines()
    at = next(i for i, line in enumerate(side) if "FileScan" in line)
    # Only the schedule is brought over.
    assert plan.count("Exchange") == 1 and "Range" in plan[plan.index("Exchange"):]
    assert "dt" in side[at].split("PartitionFilters: [")[1].split("]")[0]
