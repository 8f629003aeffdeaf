from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from roomtide.functions import fixed
from roomtide.operators import intervals, records, sessions
from roomtide.operators import viewers as vw
from roomtide.sources import readers, scans


def at(clock, day=1):
    return datetime.fromisoformat(f"2024-01-{day:02d} {clock}")


def table(spark, name, given):
    """Rows given as dicts; missing columns are NULL."""
    schema = spark.createDataFrame([], readers.SCHEMAS[name]).schema
    return spark.createDataFrame([tuple(r.get(f) for f in schema.names) for r in given], schema)


def beat(time, uid="u", device="d", room="r", second="10", **more):
    return {"logtime": time, "uid": uid, "device_id": device, "extra_id": room,
            "second": second, "type": fixed.ROOM_VIDEO, "is_online": "1", **more}


def show(id_, start, end, room="r", host=1, live_status=0, **more):
    return {"id": id_, "circle_id": room, "u_type": 2, "uid": host, "title": "t",
            "start_time": start, "end_time": end, "live_status": live_status, "type": 4,
            "audit": 1, "status": 0, **more}


def metrics(spark, shows, beats=(), comments=(), incomes=(), **options):
    out = sessions.session_metrics(
        table(spark, "session", shows), table(spark, "heartbeat", beats),
        table(spark, "comment", comments), table(spark, "income", incomes), **options)
    return {r["live_id"]: r for r in out.collect()}


def test_empty_session(spark):
    row = metrics(spark, [show(1, at("10:00:00"), at("11:00:00"))])[1]
    assert row["lcs_name"] == "#"
    for c in fixed.SESSION_METRICS[8:]:
        assert row[c] == 0, c


def test_bounds_are_closed_and_dwell_is_capped(spark):
    shows = [show(1, at("10:00:00"), at("10:00:20"))]
    beats = [beat(at("10:00:00")), beat(at("10:00:20")), beat(at("10:00:21")),
             beat(at("09:59:59")), beat(at("10:00:05"), second=None),
             beat(at("10:00:05"), device=""), beat(at("10:00:05"), type=fixed.ROOM_TEXT)]
    row = metrics(spark, shows, beats)[1]
    assert (row["view_count"], row["first_view_count"], row["new_user_staying_max"]) == (1, 1, 20)
    assert row["new_user_staying_average"] == 20.0


def test_new_and_old(spark):
    shows = [show(1, at("10:00:00"), at("11:00:00")), show(2, at("12:00:00"), at("13:00:00")),
             show(3, at("12:00:00"), at("13:00:00"), room="s")]
    beats = [beat(at("10:01:00"), "123"), beat(at("12:01:00"), "123"),
             beat(at("12:02:00"), "12", "e"), beat(at("12:03:00"), "", "f"),
             beat(at("12:04:00"), "123", room="s"),
             beat(at("10:02:00"), "123", "g"), beat(at("11:30:00"), "9"),
             beat(at("12:05:00"), "9", "h")]
    viewers = vw.viewer_dwell(table(spark, "heartbeat", beats),
                              vw.windows(table(spark, "session", shows)))
    new = rows(vw.new_viewers(viewers).select("live_id", "uid", "device_id"))
    old = rows(vw.old_viewers(viewers).select("live_id", "uid", "device_id"))
    # 12 is new although 123 was seen; 9 was there before, but in no session.
    assert new == [(1, "123", "d"), (1, "123", "g"), (2, "12", "e"), (2, "9", "h"), (3, "123", "d")]
    assert old == [(2, "", "f"), (2, "123", "d")]
    assert viewers.count() == len(new) + len(old)
    known = spark.createDataFrame([("r", "12", at("08:00:00"))], "extra_id string, uid string, first_at timestamp")
    assert (2, "12", "e") in rows(
        vw.old_viewers(viewers, known).select("live_id", "uid", "device_id"))
    merged = vw.merge_first_seen(known, vw.first_seen(viewers))
    assert rows(merged.where("uid = '12'")) == [("r", "12", at("08:00:00"))]


def test_identity_set(spark):
    shows = [show(1, at("10:00:00"), at("11:00:00"))]
    beats = [beat(at("10:01:00"), u, "d") for u in ("", "7", "88")] + [
        beat(at("10:01:00"), "", "e"), beat(at("10:01:00"), "88", "f")]
    viewers = vw.viewer_dwell(table(spark, "heartbeat", beats),
                              vw.windows(table(spark, "session", shows)))
    ids = vw.identity_set(viewers)
    assert rows(ids.select("identity")) == [("88",), ("e",)]
    kept = vw.with_expiry(ids, F.lit("2024-01-01 12:00:00").cast("timestamp"))
    assert vw.unexpired(kept, F.lit("2024-01-03 11:59:59").cast("timestamp")).count() == 2
    assert vw.unexpired(kept, F.lit("2024-01-03 12:00:00").cast("timestamp")).count() == 0


def said(kind, uid=1, u_type=1, robot=0, reply=0):
    return {"u_type": u_type, "uid": uid, "discussion_type": kind, "is_robot": robot,
            "reply_id": reply, "c_time": at("10:30:00"), "relation_id": "r"}


def test_comment_counts(spark):
    shows = [show(1, at("10:00:00"), at("11:00:00"))]
    comments = [said(0), said(0), said(0, 2), said(0, 3, robot=1), said(8), said(14), said(2),
                said(12), said(13, robot=1), said(0, 9, u_type=2), said(0, 9, u_type=2, reply=5),
                said(None, None)]
    row = metrics(spark, shows, comments=comments)[1]
    got = {c: row[c] for c in sessions.COMMENT_METRICS}
    # A NULL kind and uid read as 0, but this row's NULL is a viewer's comment by uid 0.
    assert got == {
        "view_count_robot": 2, "new_follow_count": 1, "new_follow_count_robot": 0,
        "comment_count": 4, "comment_count_robot": 1, "comment_peoples": 3,
        "comment_peoples_robot": 1, "gift_count": 1, "gift_count_robot": 0, "share_count": 2,
        "share_count_robot": 1, "planner_comment_count": 1, "planner_reply_count": 1}
    both = metrics(spark, shows, comments=comments, viewer_only=False)[1]
    assert (both["comment_count"], both["comment_peoples"]) == (6, 4)


def test_income_uses_schedule_and_status(spark):
    shows = [show(1, at("10:00:00"), at("11:00:00"), live_status=1)]
    incomes = [{"p_uid": 1, "divide_money": m, "status": s, "c_time": t} for m, s, t in (
        (0.1, 0, at("10:00:00")), (0.2, 0, at("11:00:00")), (5.0, 1, at("10:30:00")),
        (7.0, 0, at("11:00:01")))]
    now = F.lit("2024-01-01 12:00:00").cast("timestamp")
    assert metrics(spark, shows, incomes=incomes, now=now)[1]["gift_income"] == 0.3


def test_refresh(spark):
    shows = [show(1, at("10:00:00"), at("11:00:00")),
             show(2, at("10:00:00"), at("23:00:00"), room="s", live_status=1),
             show(3, at("10:00:00"), at("11:00:00"), room="t")]
    beats = [beat(at("12:00:30"), "a", room="s"), beat(at("12:00:40"), "b", room="s"),
             beat(at("12:02:00"), "c", room="s"), beat(at("10:30:00"), "c", room="t")]
    previous = spark.createDataFrame([(1, 0, 50), (3, 1, 40)],
                                     "live_id bigint, live_status int, max_living_count bigint")
    out = sessions.refresh(
        table(spark, "session", shows), table(spark, "heartbeat", beats),
        table(spark, "comment", []), table(spark, "income", []), previous,
        F.lit("2024-01-01 12:01:00").cast("timestamp"))
    got = {r["live_id"]: r for r in out.collect()}
    assert sorted(got) == [2, 3]
    assert (got[2]["view_count"], got[2]["first_view_count"], got[2]["max_living_count"]) == (1, 2, 2)
    assert (got[3]["view_count"], got[3]["max_living_count"]) == (1, 40)


def test_rollup(spark):
    shows = [show(1, at("10:00:00"), at("11:00:00")), show(2, at("12:00:00"), at("13:00:00")),
             show(3, at("10:00:00"), at("11:00:00"), host=2),
             show(4, at("10:00:00"), at("11:00:00"), audit=0)]
    session = table(spark, "session", shows)
    stored = sessions.session_metrics(
        session.where("id <> 2"), table(spark, "heartbeat", [beat(at("10:00:01"))]),
        table(spark, "comment", []), table(spark, "income", []))
    got = {r["lcs_id"]: r for r in sessions.planner_rollup(session, stored).collect()}
    assert sorted(got) == [1, 2]
    assert (got[1]["notice_num"], got[1]["live_times"], got[1]["view_count"]) == (2, 3600, 1)


def test_upsert_twice(spark):
    cols = "notice_id bigint, v bigint, c_time string"
    old = spark.createDataFrame([(1, 1, "a"), (2, 2, "a")], cols)
    new = spark.createDataFrame([(2, None, "b"), (3, 3, "b")], cols)
    once = records.upsert(old, new, "notice_id", ("c_time",))
    want = [(1, 1, "a"), (2, None, "a"), (3, 3, "b")]
    assert rows(once, "notice_id") == want
    later = new.withColumn("c_time", F.lit("c"))
    assert rows(records.upsert(once, later, "notice_id", ("c_time",)), "notice_id") == want
    assert rows(records.insert_new(old, new, "notice_id")) == [(3, 3, "b")]


def _brute(facts, spans):
    return sorted((f[0], s[0]) for f in facts for s in spans
                  if f[1] == s[1] and s[2] <= f[2] <= s[3])


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("broadcast_rows", [500_000, 0])
def test_interval_join_forms(spark, no_broadcast, broadcast_rows):
    """Broadcast and salted joins equal brute force; one room holds most rows."""
    facts = [(i, "hot" if i % 3 else f"r{i % 5}",
              at(f"{i % 24:02d}:{i * 7 % 60:02d}:00", 1 + i % 4)) for i in range(400)]
    facts += [(1000 + i, "hot", at("10:00:00", 2)) for i in range(50)]
    spans = [(s, "hot" if s % 2 else f"r{s % 5}", at(f"{s % 20:02d}:00:00", 1 + s % 3),
              at(f"{s % 20 + 3:02d}:30:00", 1 + s % 3 + s % 2)) for s in range(30)]
    spans += [(90, "hot", at("20:00:00", 2), at("10:00:00", 2)), (91, "hot", None, None)]
    f = spark.createDataFrame(facts, "fid int, room string, t timestamp")
    s = spark.createDataFrame(spans, "sid int, key string, start_time timestamp, end_time timestamp")
    got = intervals.covered_by(f, s, key=("room", "key"), at="t",
                               broadcast_rows=broadcast_rows, rows_per_salt=20)
    assert got.columns == ["fid", "room", "t", "sid", "key", "start_time", "end_time"]
    assert rows(got.select("fid", "sid")) == _brute(facts, [x for x in spans if x[2]])


def test_interval_join_without_intervals(spark):
    f = spark.createDataFrame([(1, "a", at("10:00:00"))], "fid int, room string, t timestamp")
    s = spark.createDataFrame([], "sid int, key string, start_time timestamp, end_time timestamp")
    assert intervals.covered_by(f, s, key=("room", "key"), at="t").count() == 0


def test_heavy_days_are_few(spark):
    rows_in = [(i, "hot" if i % 3 == 0 else f"r{i}", 1) for i in range(300)]
    df = spark.createDataFrame(rows_in, "id int, room string, day int")
    assert rows(intervals.heavy_days(df, "room", "day", 30)) == [("hot", 1, 4)]


def test_metrics_same_on_salted_path(spark, no_broadcast, sf_dir):
    from roomtide.plans.queries import Given
    g = Given(spark, sf_dir)
    salted = sessions.session_metrics(g.eligible, g.heartbeat, g.comment, g.income,
                                      broadcast_rows=0, rows_per_salt=10)
    assert rows(salted, "live_id") == rows(g.metrics, "live_id")


def test_session_scan_bounds(spark):
    shows = [show(1, at("10:00:00"), at("00:00:00", 2)), show(2, at("10:00:00"), at("00:00:00", 3)),
             show(3, at("10:00:00"), at("12:00:00", 2), live_status=2),
             show(4, at("10:00:00"), at("12:00:00", 2), u_type=1)]
    got = scans.sessions(table(spark, "session", shows), "2024-01-02", "2024-01-03", ordered=True)
    assert [r["id"] for r in got.collect()] == [1]
