"""Bucketed tables: what an update reads and writes, versions, repeats, emptied buckets."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_jobs import day, live_tables, show, table

from roomtide.operators import records, sessions
from roomtide.operators import viewers as vw
from roomtide.plans import jobs
from roomtide.session import matching
from roomtide.sources import buckets
from roomtide.streaming import refresh


def over(old, new):
    return old.join(new, "k", "left_anti").unionByName(new)


def parts(spark, path, n=8):
    """(bucket, part) of every folder."""
    return [tuple(x.partition("=")[2] for x in p.rsplit("/", 2)[1:])
            for p in matching(spark, f"{path}/buckets={n}/bucket=*/part=*")]


def test_puts_against_a_dictionary(spark, tmp_path):
    path, rng, want, history = str(tmp_path / "t"), random.Random(2), {}, {}
    for version in range(1, 9):
        new = {k: version * 100 + k for k in rng.sample(range(40), 6)}
        frame = spark.createDataFrame(list(new.items()), "k long, v long")
        for _ in range(1 + version % 2):  # a repeated batch leaves the same
            buckets.put(frame, path, version, "k", buckets=8, over=over)
        want.update(new)
        history[version] = sorted(want.items())
    for version, kept in history.items():
        assert rows(buckets.read(spark, path, version, buckets=8)) == kept
    before = parts(spark, path)
    buckets.prune(spark, path, 6, buckets=8)
    assert set(parts(spark, path)) < set(before)
    for version in (6, 7, 8):
        assert rows(buckets.read(spark, path, version, buckets=8)) == history[version]
    assert buckets.newest(spark, path, 8) == 8
    at = buckets.touched(frame, "k", buckets=8)
    some = buckets.read(spark, path, only=at, buckets=8)
    assert rows(some) == [r for r in history[8] if r in set(rows(some))]
    assert {r[0] for r in rows(some)} >= set(new)
    assert buckets.read(spark, path, only=[], buckets=8) is None
    assert buckets.read(spark, str(tmp_path / "no"), buckets=8) is None


def test_an_emptied_bucket_stays_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1, 1)], "k long, v long")
    at = buckets.touched(one, "k", buckets=8)
    buckets.put(one, path, 1, "k", buckets=8)
    buckets.put(one.where("false"), path, 2, "k", buckets=8, also=at,
                over=lambda old, new: new)
    assert rows(buckets.read(spark, path, 1, buckets=8)) == [(1, 1)]
    assert buckets.read(spark, path, 2, buckets=8).count() == 0
    buckets.put(one, path, 3, "k", buckets=8, over=over)
    assert rows(buckets.read(spark, path, buckets=8)) == [(1, 1)]


def test_added_parts_become_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(buckets, "MOST_ADDED", 3)
    path, want = str(tmp_path / "t"), set()
    for version in range(12):
        new = [(k, version) for k in (1, 2, 3 + version % 5)]
        buckets.add(spark.createDataFrame(new, "k long, v long"), path, version, "k", buckets=2)
        want |= set(new)
        assert set(rows(buckets.read(spark, path, version, buckets=2))) == want
    kinds = [p.split("-")[0] for _, p in parts(spark, path, 2)]
    assert kinds.count("whole") >= 4
    buckets.prune(spark, path, 11, buckets=2)
    assert set(rows(buckets.read(spark, path, buckets=2))) == want
    assert len(parts(spark, path, 2)) <= 2 * (3 + 2)


@pytest.fixture(scope="module")
def large_store(spark, tmp_path_factory):
    """A store of 100 000 sessions of a thousand hosts, and 200 000 first-seen uids."""
    store = str(tmp_path_factory.mktemp("large"))
    wanted = table(spark, "session", [show(1, day(4), day(5))])
    one = sessions.session_metrics(wanted, *(table(spark, n, []) for n in (
        "heartbeat", "comment", "income")))
    ids = spark.range(100, 100_100)
    many = ids.crossJoin(one).withColumn("live_id", F.col("id")) \
        .withColumn("lcs_id", (F.col("id") % 1000 + 10).cast("long")).select(*one.columns)
    now = F.lit("2024-01-05 00:00:00").cast("timestamp")
    for name, df, key in (
            ("metrics", many, ["live_id"]), ("live_info", records.live_info(many, now), ["notice_id"]),
            ("viewers", vw.with_expiry(many.select("live_id", F.lit("u").alias("identity")),
                                       F.current_timestamp()), ["live_id"]),
            ("first_seen", spark.range(200_000).select(
                F.lit("r").alias("extra_id"), (F.col("id") + 1000).cast("string").alias("uid"),
                now.alias("first_at")), ["extra_id", "uid"])):
        buckets.put(df, f"{store}/{name}", 0, *key)
    return store


def test_a_refresh_of_one_session_writes_one_bucket(spark, large_store):
    run = jobs.refresh_target(spark, live_tables(spark), large_store)
    seen = []
    for _ in range(2):
        run(None, 0)
        for name in ("metrics", "live_info", "planners", "viewers", "first_seen"):
            new = [p for p in parts(spark, f"{large_store}/{name}", buckets.BUCKETS)
                   if p[1].endswith("-1")]
            assert len(new) == 1, (name, new)
        seen.append([rows(buckets.read(spark, f"{large_store}/{n}", 1, [
            int(b) for b, p in parts(spark, f"{large_store}/{n}", buckets.BUCKETS)
            if p.endswith("-1")])) for n in ("metrics", "live_info", "planners", "viewers")])
    assert seen[0] == seen[1]
    assert buckets.read(spark, f"{large_store}/metrics", 1).count() == 100_001
    assert buckets.read(spark, f"{large_store}/first_seen", 1).count() == 200_001


def test_history_is_read_by_bucket_and_bloom_filter(spark, large_store, tmp_path):
    viewers = spark.createDataFrame(
        [(2, "r", u, "d", 15, day(5, 2), day(5, 1), day(6)) for u in ("1001", "1002", "x", "")],
        "live_id long, extra_id string, uid string, device_id string, dwell long, "
        "first_at timestamp, win_start timestamp, win_end timestamp")
    viewers.write.parquet(str(tmp_path / "v"))
    viewers = spark.read.parquet(str(tmp_path / "v"))
    known = refresh.known_of(spark, large_store, 0, viewers)
    asked = viewers.where("uid <> ''")
    at = buckets.touched(asked, "extra_id", "uid")
    assert len(at) <= 3
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in known.inputFiles()} == set(at)
    # A sixty-fourth of the history for each uid that is asked for, about.
    assert known.count() < 3.5 * 200_000 / buckets.BUCKETS
    assert rows(vw.uids_of_sessions(viewers, known).select("uid", "is_new")) == [
        ("", False), ("1001", False), ("1002", False), ("x", True)]
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
                "spark.sql.optimizer.runtime.bloomFilter.enabled": "true"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        plan = vw.uids_of_sessions(viewers, known)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "might_contain" in plan
