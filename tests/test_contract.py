"""The registered queries against their SQL, and the jobs end to end."""

import os

import pytest
from conftest import rows
from oracle_check import compare, connect
from pyspark.sql import functions as F

import __spark_entry__ as contract
from roomtide.functions import fixed
from roomtide.operators import sessions
from roomtide.plans import jobs
from roomtide.plans.queries import Given, texts
from roomtide.session import shared_dir
from roomtide.sources import buckets, fixtures, sinks
from roomtide.streaming import online

# ROOMTIDE_ALL=1 runs every query; the default is one of each kind.
SOME = ("session_metrics", "planner_rollup", "metrics_upsert", "metrics_refresh", "new_viewers",
        "viewer_identity_set", "slot_event_all", "slot_event_write", "heartbeat_flatten",
        "snapshot_flatten", "online_now", "peak_online_running", "dwell_gap_batch",
        "watch_sessions", "pv_uv_planner", "minute_coverage", "scalar_suite", "online_now_stream",
        "dwell_state", "comment_feed_stream", "metrics_refresh_stream",
        "session_heartbeats_days", "heartbeat_repair_merge", "report_tsv", "heartbeat_scan",
        "json_flatten", "old_viewers", "full_table_overwrite")
NAMES = sorted(contract.oracle_sql()) if os.environ.get("ROOMTIDE_ALL") else SOME


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sf_dir, con, name):
    df = contract.queries()[name](spark, sf_dir)
    assert compare(df, con, contract.oracle_sql()[name]) == ""


def test_entry(spark):
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_shared_dir_is_set(spark):
    assert shared_dir(spark)


def test_batch_jobs(spark, sf_dir, tmp_path):
    g, out = Given(spark, sf_dir), str(tmp_path)
    for _ in range(2):
        jobs.extract_slots(g.api_log, "2024-01-05", "2024-01-06", f"{out}/slots")
        jobs.extract_heartbeats(g.heartbeat, "2024-01-05", "2024-01-06", f"{out}/beats")
        jobs.extract_session_heartbeats(g.heartbeat, g.session, "2024-01-05", "2024-01-06",
                                        f"{out}/old")
        jobs.repair_heartbeats(g.api_log, "2024-01-05 00:00:00", "2024-01-05 23:59:59",
                               f"{out}/repair")
        jobs.write_reports(g.api_log, "2024-01-05", "2024-01-06", f"{out}/reports")
    for name in ("slots", "beats"):
        days = spark.read.parquet(f"{out}/{name}").select(F.col("dt").cast("string")).distinct()
        assert rows(days) == [("2024-01-05",), ("2024-01-06",)]
    wanted = g.heartbeat.where(F.col("type").isin(fixed.ROOM_VIDEO, fixed.ROOM_TEXT)
                               & F.to_date("logtime").isin("2024-01-05", "2024-01-06"))
    assert spark.read.parquet(f"{out}/beats").count() == wanted.count()
    assert spark.read.csv(f"{out}/reports/planner_pages", sep="\t", header=True).columns == [
        "date", "puid", "uv", "pv"]


def test_session_job_versions(spark, sf_dir, tmp_path):
    g, store = Given(spark, sf_dir), str(tmp_path / "store")
    now = [F.lit(f"2024-02-0{d} 00:00:00").cast("timestamp") for d in (1, 2)]
    tables = (g.session, g.heartbeat, g.comment, g.income)
    jobs.compute_sessions(*tables, "2024-01-01", "2024-01-16", store=store, version=1, now=now[0])
    for _ in range(2):
        jobs.compute_sessions(*tables, "2024-01-16", "2024-02-01", store=store, version=2, now=now[1])
    got = buckets.read(spark, f"{store}/metrics")
    # Two halves with the kept first-seen table give what one run over all gives.
    peak = [c for c in got.columns if c != "max_living_count"]
    assert rows(got.select(*peak), "live_id") == rows(g.metrics.select(*peak), "live_id")
    info = buckets.read(spark, f"{store}/live_info")
    assert info.count() == got.count()
    assert {str(r[0])[:10] for r in info.select("c_time").distinct().collect()} == {
        "2024-02-01", "2024-02-02"}
    planners = buckets.read(spark, f"{store}/planners")
    assert rows(planners, "lcs_id") == rows(sessions.planner_rollup(g.session, got)
                                            .select(*planners.columns), "lcs_id")
    jobs.snapshot_to_days(got, planners, "2024-02-02", str(tmp_path / "ads"))
    flat = spark.read.parquet(str(tmp_path / "ads" / "live_visit_count"))
    assert flat.columns == [*fixed.SESSION_SNAPSHOT, "dt"] and flat.count() == got.count()


def test_full_table_write(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS scratch LOCATION '{tmp_path}'")
    for v in (1, 2):
        sinks.write_table(spark.range(v), "scratch.whole")
    assert spark.table("scratch.whole").count() == 2
    spark.sql("DROP DATABASE scratch CASCADE")


def test_streams_in_small_batches(spark, sf_dir, con, tmp_path):
    """Many micro-batches in time order leave what one batch leaves."""
    from roomtide.streaming import dwell, feeds
    events = fixtures.events(spark, sf_dir)
    path = str(tmp_path / "ev" / "events.parquet")
    for first, last in ((1, 9), (10, 17), (18, 24), (25, 31)):
        events.where(F.day("ts").between(first, last)).coalesce(1).write.mode("append").parquet(path)
    stream = fixtures.event_stream(spark, str(tmp_path / "ev"), max_files=1)
    beats = fixtures.heartbeat_rows(stream, fixtures.TIME_SCALE)
    sql = contract.oracle_sql()
    assert compare(texts(feeds.replay(online.online_now(beats), "small")), con,
                   sql["online_now_stream"]) == ""
    updates = feeds.replay(dwell.dwell_state(beats), "small-dwell", updates=True)
    state = dwell.latest(updates, F.lit(dwell.newest_second(updates) - 5))
    assert compare(texts(state), con, sql["dwell_state"]) == ""


def test_approximate_stream_close(spark, sf_dir):
    from roomtide.streaming import feeds
    g = Given(spark, sf_dir)
    exact = feeds.replay(online.online_now(g.events_of(stream=True)), "exact")
    about = feeds.replay(online.online_now_approximate(g.events_of(stream=True)), "about") \
        .withColumnRenamed("online", "about")
    joined = exact.join(about, ["window_end", "extra_id", "type"])
    assert joined.count() == exact.count() == about.count()
    assert joined.where(F.abs(F.col("about") - F.col("online")) > 2).count() == 0


def test_online_job(spark, sf_dir, tmp_path):
    """All four feeds of the online job run on the same streams."""
    g, out = Given(spark, sf_dir), str(tmp_path / "out")
    queries = jobs.start_online_counts(
        g.events_of(stream=True), fixtures.room_comment_stream(spark, sf_dir), out,
        str(tmp_path / "checkpoint"), now=F.lit("2024-01-01").cast("timestamp"))
    for q in queries:
        q.processAllAvailable()
        q.stop()
    figures = spark.read.parquet(f"{out}/online")
    assert figures.count() > 0 and figures.where("average <= 0").count() == 0
    assert spark.read.parquet(f"{out}/comments").count() > 0
    assert spark.read.parquet(f"{out}/dwell").count() > 0
    beats = spark.read.parquet(f"{out}/heartbeats")
    assert beats.columns == ["extra_id", "type", "uid", "c_time"]


def test_refresh_job_twice(spark, sf_dir, tmp_path):
    """A repeated batch leaves the same versions; a later one builds on them."""
    from roomtide.streaming.refresh import Tables
    g, store = Given(spark, sf_dir), str(tmp_path / "store")
    buckets.put(g.previous.select(*fixed.SESSION_METRICS), f"{store}/metrics", 7, "live_id")
    buckets.put(g.known, f"{store}/first_seen", 7, "extra_id", "uid")
    tables = Tables(lambda: g.session, lambda: g.heartbeat, lambda: g.comment, lambda: g.income)
    run = jobs.refresh_target(spark, tables, store, g.now, base=7)
    seen = []
    for number in (0, 0, 1):
        run(None, number)
        seen.append([rows(buckets.read(spark, f"{store}/{name}", 8 + number))
                     for name in ("metrics", "live_info", "planners", "viewers")])
    assert seen[0] == seen[1]
    # Nothing changed in between, so the next refresh finds the same figures.
    assert seen[2] == seen[0]
