"""Runnable queries by name: each takes (spark, sf_dir) and returns a DataFrame.

They run the operators on the logical tables derived from the given parquet
files, whole. Times leave as text, which is what the stores keep.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, scalars
from ..functions.jsonx import field, json_map
from ..operators import records, reports, rooms, sessions, slots
from ..operators import viewers as vw
from ..session import keep_stream_state, materialise, work_path
from ..sources import buckets, fixtures, scans, sinks
from ..streaming import dwell, feeds, online, refresh
from . import jobs

Query = Callable[[SparkSession, str], DataFrame]

# Time bounds of the scans: wide enough to cover any of the given tables.
SINCE, UNTIL = "1970-01-01", "2100-01-01"
STORED_AT = "2024-02-01 00:00:00"
# How far the clock of a stream stays behind its newest row.
LATENESS_SECONDS = 5
EXPIRY_CHECK = "2024-01-16 00:00:00"


@dataclass(frozen=True)
class Given:
    """The logical tables of one run."""

    spark: SparkSession
    sf_dir: str

    @cached_property
    def heartbeat(self) -> DataFrame:
        return fixtures.heartbeat(self.spark, self.sf_dir)

    @cached_property
    def quick_heartbeat(self) -> DataFrame:
        return fixtures.heartbeat(self.spark, self.sf_dir, fixtures.TIME_SCALE)

    @cached_property
    def session(self) -> DataFrame:
        return fixtures.session(self.spark, self.sf_dir)

    @cached_property
    def eligible(self) -> DataFrame:
        return scans.eligible_sessions(self.session)

    @cached_property
    def comment(self) -> DataFrame:
        return fixtures.comment(self.spark, self.sf_dir)

    @cached_property
    def income(self) -> DataFrame:
        return fixtures.income(self.spark, self.sf_dir)

    @cached_property
    def api_log(self) -> DataFrame:
        return fixtures.api_log(self.spark, self.sf_dir)

    @cached_property
    def room_comment(self) -> DataFrame:
        return fixtures.room_comment(self.spark, self.sf_dir)

    @cached_property
    def spans(self) -> DataFrame:
        return vw.windows(self.eligible)

    @cached_property
    def viewers(self) -> DataFrame:
        return vw.viewer_table(self.heartbeat, self.spans)

    @cached_property
    def views(self) -> DataFrame:
        return sessions.view_metrics(self.viewers)

    @cached_property
    def metrics(self) -> DataFrame:
        return sessions.session_metrics(
            self.eligible, self.heartbeat, self.comment, self.income)

    @cached_property
    def previous(self) -> DataFrame:
        return fixtures.previous_snapshot(self.session)

    @cached_property
    def known(self) -> DataFrame:
        """First-seen table that the sessions stored as finished have left."""
        finished = self.session.join(
            self.previous.where(F.col("live_status") == fixed.ENDED)
            .select(F.col("live_id").alias("id")), "id", "left_semi")
        return vw.first_seen(vw.viewer_dwell(self.heartbeat, vw.windows(finished)))

    def now(self) -> Column:
        """The last second of the heartbeats, as the time of a refresh."""
        last = self.heartbeat.agg(F.max(F.unix_seconds("logtime"))).first()[0]
        return F.timestamp_seconds(F.lit(last))

    def events_of(self, stream: bool = False) -> DataFrame:
        rows = fixtures.event_stream(self.spark, self.sf_dir) if stream \
            else fixtures.events(self.spark, self.sf_dir)
        return fixtures.heartbeat_rows(rows, fixtures.TIME_SCALE)

    @cached_property
    def stored_metrics(self) -> DataFrame:
        """The metrics as a table, for what reads them more than once."""
        return materialise(self.metrics, "metrics")

    def bounds(self, rows: DataFrame, at: str) -> tuple[Column, Column]:
        """Times of two rows inside the data: the last of the 5th and of the 20th of a month."""
        ends = [F.max(F.when(F.day(at) == d, F.unix_micros(at))) for d in (5, 20)]
        first, last = rows.agg(*ends).first()
        return tuple(F.timestamp_micros(F.lit(t).cast("bigint")) for t in (first, last))

    def path(self, name: str) -> str:
        return work_path(self.spark, name)


def texts(df: DataFrame) -> DataFrame:
    """Timestamps and dates as text, all else as it is."""
    out = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind == "timestamp":
            column = scalars.second_text(column)
        elif kind == "date":
            column = column.cast("string")
        out.append(column.alias(name))
    return df.select(*out)


# --- scans ---------------------------------------------------------------

def heartbeat_scan(g: Given) -> DataFrame:
    rows = scans.heartbeats(g.heartbeat, *g.bounds(g.heartbeat, "logtime"), ordered=True)
    return rows.withColumn("logtime", scalars.micro_text(F.col("logtime")))


def api_log_scan(g: Given) -> DataFrame:
    actions = tuple(sorted({s.action for s in slots.SLOTS.values()}))
    return scans.api_logs(g.api_log, *g.bounds(g.api_log, "log_time"), actions)


def api_log_token_scan(g: Given) -> DataFrame:
    searches = ((fixed.PLANNER_PAGE_ACTION, "data", "p_uid"),
                (fixed.VIEW_DETAIL_ACTION, "params", "v_id"),
                (fixed.DYNAMIC_DETAIL_ACTION, "params", "dynamic_id"))
    return scans.api_logs_with_token(
        g.api_log, SINCE, UNTIL, searches, columns=("log_time", "deviceId", "action", "data", "params")
    ).select("log_time", "deviceId", "action", "token")


def comment_scan(g: Given) -> DataFrame:
    rows = scans.comments(g.comment, *g.bounds(g.comment, "c_time"))
    return rows.withColumn("c_time", scalars.micro_text(F.col("c_time")))


def income_scan(g: Given) -> DataFrame:
    rows = scans.incomes(g.income, *g.bounds(g.income, "c_time"))
    return rows.withColumn("c_time", scalars.micro_text(F.col("c_time")))


def snapshot_read(g: Given) -> DataFrame:
    """Both keyed stores written as JSON and read back whole."""
    live = records.json_snapshot(g.stored_metrics, "live_id", fixed.SESSION_METRICS)
    hosts = records.json_snapshot(
        sessions.planner_rollup(g.session, g.stored_metrics), "lcs_id", fixed.PLANNER_METRICS)
    path = g.path("snapshot")
    stores = live.select(F.lit("live").alias("hash"), F.col("live_id").alias("key"), "value") \
        .unionAll(hosts.select(F.lit("host"), "lcs_id", "value"))
    sinks.write_days(stores, path, "hash")
    return g.spark.read.schema("key string, value string, hash string").parquet(path)


def slice_coverage(g: Given, seconds: int) -> DataFrame:
    return rooms.slice_coverage(g.heartbeat, "logtime", seconds)


# --- sinks ---------------------------------------------------------------

def slot_event_write(g: Given) -> DataFrame:
    path = g.path("slot-event")
    sinks.write_days(
        records.route_by_event_date(slots.slot_events(g.api_log), "log_time"), path)
    return (g.spark.read.parquet(path).groupBy("dt", "type")
            .agg(F.count("*").alias("n")))


def partition_overwrite(g: Given) -> DataFrame:
    """Write all days, then replace every tenth of a month with its room-video rows."""
    path = g.path("heartbeat-days")
    rows = records.route_by_event_date(g.heartbeat, "logtime")
    sinks.write_days(rows, path)
    one_day = rows.where((F.day("logtime") == 10) & (F.col("type") == fixed.ROOM_VIDEO))
    sinks.write_days(one_day, path)
    return g.spark.read.parquet(path).groupBy("dt").agg(F.count("*").alias("n"))


def full_table_overwrite(g: Given) -> DataFrame:
    """A catalog table that is written, and then overwritten whole."""
    name = f"session_table_{uuid.uuid4().hex}"
    try:
        for rows in (g.session, g.eligible):
            sinks.write_table(rows, name)
        return materialise(g.spark.table(name), "session-table")
    finally:
        g.spark.sql(f"DROP TABLE IF EXISTS {name}")


def report_tsv(g: Given) -> DataFrame:
    path = g.path("planner-pages")
    sinks.write_tsv(reports.planner_pages(g.api_log, SINCE, UNTIL), path)
    return sinks.read_tsv(g.spark, "date string, puid string, uv bigint, pv bigint", path)


def session_heartbeats_days(g: Given) -> DataFrame:
    """The job run for the first half of the month and then for days around the 15th."""
    path = g.path("session-heartbeats-days")
    # Clocks of clients are up to a day off.
    days = [str(d) for d in g.heartbeat.agg(F.date_sub(F.min(F.to_date("logtime")), 1),
                                            F.date_add(F.max(F.to_date("logtime")), 1)).first()]
    for start, end in ((days[0], "2024-01-15"), ("2024-01-14", "2024-01-16"),
                       ("2024-01-16", days[1])):
        jobs.extract_session_heartbeats(g.heartbeat, g.session, start, end, path)
    return g.spark.read.parquet(path).select("live_id", "device_id", "uid", "c_time", "dt")


def heartbeat_repair_merge(g: Given) -> DataFrame:
    """Two neighbouring repairs of one day, one of them twice, and one of the rest."""
    path = g.path("heartbeat-repair")
    noon = "2024-01-10 12:00:00"
    for start, end in (("2024-01-01 00:00:00", "2024-01-10 11:59:59"),
                       (noon, "2024-01-10 23:59:59"), (noon, "2024-01-10 23:59:59"),
                       ("2024-01-11 00:00:00", "2024-01-31 23:59:59")):
        jobs.repair_heartbeats(g.api_log, start, end, path)
    rows = g.spark.read.parquet(path)
    return rows.select(*fixed.HEARTBEAT_COLUMNS, "is_insert", "dt")


def metrics_upsert(g: Given) -> DataFrame:
    stored_at = F.lit("2024-01-15 00:00:00").cast("timestamp")
    stored = records.live_info(g.previous, stored_at)
    new = records.live_info(g.metrics, F.lit(STORED_AT).cast("timestamp"))
    return records.upsert(stored, new, "notice_id", fixed.LIVE_INFO_INSERT_ONLY)


def metrics_insert_new(g: Given) -> DataFrame:
    return records.insert_new(g.previous, g.metrics, "live_id")


def metrics_json_snapshot(g: Given) -> DataFrame:
    return records.json_snapshot(g.metrics, "live_id", fixed.SESSION_METRICS)


def viewer_set_ttl(g: Given) -> DataFrame:
    ends = g.spans.select("live_id", "win_end")
    sets = vw.identity_set(g.viewers).join(ends, "live_id")
    kept = vw.unexpired(vw.with_expiry(sets, F.col("win_end")),
                        F.lit(EXPIRY_CHECK).cast("timestamp"))
    return kept.select("live_id", "identity", "expires_at")


# --- records ---------------------------------------------------------------

def json_flatten(g: Given) -> DataFrame:
    parsed = fixtures.heartbeat_json(g.spark, g.sf_dir).withColumn("m", json_map(F.col("body")))
    return parsed.select(
        "event_id", F.size("m").cast("bigint").alias("members"),
        *[field(F.col("m"), c).alias(c) for c in ("extra_id", "p_uid", "second", "ext")])


def heartbeat_flatten(g: Given) -> DataFrame:
    return records.heartbeat_flatten(fixtures.heartbeat_json(g.spark, g.sf_dir))


def snapshot_flatten(g: Given) -> DataFrame:
    return records.session_snapshot_flatten(metrics_json_snapshot(g))


def planner_snapshot_flatten(g: Given) -> DataFrame:
    hosts = sessions.planner_rollup(g.session, g.metrics)
    return records.planner_snapshot_flatten(
        records.json_snapshot(hosts, "lcs_id", fixed.PLANNER_METRICS))


def live_type_code(g: Given) -> DataFrame:
    rows = g.heartbeat.select("type", scalars.live_type_code(F.col("type")).alias("code"))
    return rows.groupBy("type", "code").agg(F.count("*").alias("n"))


def viewer_identity(g: Given) -> DataFrame:
    rows = g.heartbeat.select(
        scalars.identity(F.col("uid"), F.col("device_id")).alias("identity"),
        scalars.online_flag(F.col("is_online")).alias("is_online"))
    return rows.groupBy("identity", "is_online").agg(F.count("*").alias("n"))


def time_normalise(g: Given) -> DataFrame:
    at = fixtures.events(g.spark, g.sf_dir)
    micro = scalars.micro_text(F.col("ts"))
    cut = scalars.cut_to_second(micro)
    iso = scalars.iso_text(F.date_trunc("second", "ts"))
    return at.select("event_id", cut.alias("cut"), iso.alias("iso"),
                     scalars.iso_to_local(iso, "Asia/Shanghai").alias("local"))


def scalar_suite(g: Given) -> DataFrame:
    at = fixtures.events(g.spark, g.sf_dir)
    kind, day = F.col("event_type"), F.to_date("ts")
    whole = F.floor("value")
    return at.select(
        "event_id",
        kind.contains("i").alias("has_i"),
        F.substring(kind, 1, 3).alias("head"),
        F.replace(kind, F.lit("c"), F.lit("T")).alias("swapped"),
        F.length(kind).cast("bigint").alias("len"),
        F.reverse(F.col("user_id").cast("string")).alias("salted_key"),
        F.concat(kind, F.lit("-"), F.col("user_id").cast("string")).alias("joined"),
        F.format_string("%.2f", F.col("value")).alias("two_decimals"),
        F.regexp_extract(scalars.second_text(F.col("ts")), r"\d{4}-\d{2}-\d{2}", 0)
        .alias("first_date"),
        F.date_add(day, 1).cast("string").alias("next_day"),
        F.date_sub(day, 1).cast("string").alias("day_before"),
        scalars.span_seconds(F.date_trunc("day", "ts"), F.col("ts")).alias("of_day"),
        F.greatest("event_id", "user_id").alias("larger"),
        F.least("event_id", "user_id").alias("smaller"),
        F.ceil("value").alias("up"),
        F.expr("event_id div 7").alias("seventh"),
        F.coalesce(F.get_json_object("props", "$.k").try_cast("int"), F.lit(-1)).alias("k"),
        F.coalesce(kind.try_cast("int"), F.lit(30)).alias("default_int"),
        F.expr("size(array_distinct(array(event_id % 2, user_id % 2, 0)))")
        .cast("bigint").alias("distinct_bits"),
        F.array_max(F.array("event_id", "user_id")).alias("top_of_array"),
        F.element_at(F.from_json("props", "map<string,string>"), "k").alias("k_text"),
        F.to_json(F.struct(kind.alias("t"), whole.cast("string").alias("v"))).alias("made"),
        F.when(F.col("value") < 10, "low").when(F.col("value") < 100, "mid")
        .otherwise("high").alias("band"),
        scalars.blank_to(F.when(F.col("event_id") % 7 == 0, "").otherwise(kind),
                         F.lit("none")).alias("or_none"))


# --- sessions ---------------------------------------------------------------

def session_heartbeats(g: Given) -> DataFrame:
    return vw.session_heartbeats(g.heartbeat, g.session)


def route_by_event_date(g: Given) -> DataFrame:
    beats = vw.session_heartbeats(g.heartbeat, g.session, "logtime")
    return records.route_by_event_date(beats, said="c_time").select(
        "live_id", "device_id", "uid", "c_time", "dt")


def viewer_dwell(g: Given) -> DataFrame:
    return _viewer_rows(vw.viewer_dwell(g.heartbeat, g.spans))


def _viewer_rows(viewers: DataFrame) -> DataFrame:
    return viewers.select("live_id", "extra_id", "uid", "device_id", "dwell")


def peak_online_estimate(g: Given) -> DataFrame:
    stored = g.previous.select("live_id", F.col("max_living_count").alias("stored"))
    return (
        sessions.fill_views(g.eligible, g.views).join(stored, "live_id", "left")
        .select("live_id", F.greatest("max_living_count", F.coalesce("stored", F.lit(0)))
                .alias("max_living_count")))


def planner_rollup(g: Given) -> DataFrame:
    return sessions.planner_rollup(g.session, g.metrics)


def metrics_refresh(g: Given) -> DataFrame:
    return sessions.refresh(g.session, g.heartbeat, g.comment, g.income, g.previous, g.now(),
                            known=g.known)


# --- rooms ---------------------------------------------------------------

def points_by_viewer(g: Given, by_second: bool) -> DataFrame:
    return vw.points_by_viewer(g.heartbeat, SINCE, UNTIL, by_second=by_second)


def points_devices(g: Given, approximate: bool = False) -> DataFrame:
    return rooms.room_points_devices(g.heartbeat, SINCE, UNTIL, approximate=approximate)


def avg_dwell_by_room(g: Given) -> DataFrame:
    return rooms.average_dwell(points_devices(g))


def online_with_average(g: Given) -> DataFrame:
    return rooms.online_with_average(rooms.online_now(g.quick_heartbeat), avg_dwell_by_room(g))


def peak_online_running(g: Given) -> DataFrame:
    return rooms.peak_online_running(rooms.online_now(g.quick_heartbeat))


# --- streams ---------------------------------------------------------------

def online_now_stream(g: Given) -> DataFrame:
    return feeds.replay(online.online_now(g.events_of(stream=True)), "online-now")


def online_with_average_stream(g: Given) -> DataFrame:
    stream = online.online_now(g.events_of(stream=True))
    path = g.path("online-average")
    target = online.with_average(lambda _: avg_dwell_by_room(g), feeds.batch_writer(path))
    keep_stream_state(g.spark)
    (stream.writeStream.outputMode("append").foreachBatch(target)
     .option("checkpointLocation", g.path("online-average-checkpoint"))
     .trigger(availableNow=True).start().awaitTermination())
    return g.spark.read.parquet(path).drop("batch")


def dwell_state(g: Given) -> DataFrame:
    updates = feeds.replay(dwell.dwell_state(g.events_of(stream=True)), "dwell-state", updates=True)
    return dwell.latest(updates, F.lit(dwell.newest_second(updates) - LATENESS_SECONDS))


def dwell_stretches_stream(g: Given) -> DataFrame:
    return feeds.replay(dwell.dwell_stretches(g.events_of(stream=True)), "dwell-stretches")


def heartbeat_feed_stream(g: Given) -> DataFrame:
    return feeds.replay(feeds.heartbeat_feed(g.events_of(stream=True)), "heartbeat-feed")


def comment_feed_stream(g: Given) -> DataFrame:
    stream = fixtures.room_comment_stream(g.spark, g.sf_dir)
    return feeds.replay(records.comment_feed(stream), "comment-feed")


def metrics_refresh_stream(g: Given) -> DataFrame:
    """The refresh driven by a stream of events: the store after the last tick."""
    store = g.path("metric-store")
    buckets.put(g.previous.select(*fixed.SESSION_METRICS), f"{store}/metrics", 0, "live_id")
    buckets.put(g.known, f"{store}/first_seen", 0, "extra_id", "uid")
    tables = refresh.Tables(lambda: g.session, lambda: g.heartbeat,
                            lambda: g.comment, lambda: g.income)
    run = refresh.refresher(g.spark, tables, store, g.now)
    (fixtures.event_stream(g.spark, g.sf_dir).writeStream.foreachBatch(run)
     .option("checkpointLocation", g.path("metric-store-checkpoint"))
     .trigger(availableNow=True).start().awaitTermination())
    return buckets.read(g.spark, f"{store}/metrics")


_BUILDERS: dict[str, Callable[[Given], DataFrame]] = {
    "session_metrics": lambda g: g.metrics,
    "session_view_metrics": lambda g: sessions.fill_views(g.eligible, g.views),
    "session_comment_metrics": lambda g: sessions.fill_comments(
        g.eligible, sessions.comment_metrics(g.comment, g.spans)),
    "session_comment_metrics_all": lambda g: sessions.fill_comments(
        g.eligible, sessions.comment_metrics(g.comment, g.spans, viewer_only=False)),
    "session_gift_income": lambda g: sessions.fill_income(
        g.eligible, sessions.gift_income(g.income, g.eligible)),
    "session_dwell_metrics": lambda g: sessions.fill_dwell(g.eligible, g.views),
    "session_heartbeats": session_heartbeats,
    "viewer_dwell": viewer_dwell,
    "new_viewers": lambda g: _viewer_rows(vw.new_viewers(g.viewers)),
    "old_viewers": lambda g: _viewer_rows(vw.old_viewers(g.viewers)),
    "viewer_identity_set": lambda g: vw.identity_set(g.viewers),
    "viewer_set_ttl": viewer_set_ttl,
    "peak_online_estimate": peak_online_estimate,
    "planner_rollup": planner_rollup,
    "metrics_refresh": metrics_refresh,
    "metrics_upsert": metrics_upsert,
    "metrics_insert_new": metrics_insert_new,
    "metrics_json_snapshot": metrics_json_snapshot,
    "snapshot_read": snapshot_read,
    "snapshot_flatten": snapshot_flatten,
    "planner_snapshot_flatten": planner_snapshot_flatten,
    "heartbeat_scan": heartbeat_scan,
    "api_log_scan": api_log_scan,
    "api_log_token_scan": api_log_token_scan,
    "session_scan": lambda g: scans.sessions(g.session, *g.bounds(g.session, "end_time"),
                                             ordered=True),
    "comment_scan": comment_scan,
    "income_scan": income_scan,
    "planner_sessions": lambda g: scans.planner_sessions(g.session),
    "distinct_planners": lambda g: scans.distinct_planners(g.session),
    "date_spine": lambda g: scans.date_spine_of(g.heartbeat, "logtime"),
    "minute_coverage": partial(slice_coverage, seconds=60),
    "half_minute_coverage": partial(slice_coverage, seconds=30),
    "slot_event_write": slot_event_write,
    "partition_overwrite": partition_overwrite,
    "full_table_overwrite": full_table_overwrite,
    "report_tsv": report_tsv,
    "route_by_event_date": route_by_event_date,
    "session_heartbeats_days": session_heartbeats_days,
    "heartbeat_repair_merge": heartbeat_repair_merge,
    "open_sessions": lambda g: scans.open_sessions(g.session, F.date_trunc("day", g.now())),
    "room_comments": lambda g: scans.room_comments(
        g.room_comment, "2024-01-02 00:00:00", "2024-01-06 00:00:00"),
    "json_flatten": json_flatten,
    "heartbeat_flatten": heartbeat_flatten,
    "heartbeat_repair": lambda g: records.heartbeat_repair(g.api_log, SINCE, UNTIL),
    "live_type_code": live_type_code,
    "viewer_identity": viewer_identity,
    "time_normalise": time_normalise,
    "scalar_suite": scalar_suite,
    **{name: partial(lambda g, name: slots.slot_event(g.api_log, name), name=name)
       for name in slots.SLOTS},
    "slot_event_all": lambda g: slots.slot_events(g.api_log),
    "slot_event_counts": lambda g: slots.slot_counts(slots.slot_events(g.api_log)),
    "points_by_viewer": partial(points_by_viewer, by_second=False),
    "points_by_viewer_sec": partial(points_by_viewer, by_second=True),
    "room_points_devices": points_devices,
    "room_points_devices_approx": partial(points_devices, approximate=True),
    "avg_dwell_by_room": avg_dwell_by_room,
    "top_rooms": lambda g: rooms.top_rooms(g.heartbeat, 5),
    "online_now": lambda g: rooms.online_now(g.quick_heartbeat),
    "online_with_average": online_with_average,
    "peak_online_running": peak_online_running,
    "dwell_gap_batch": lambda g: rooms.dwell_gaps(g.quick_heartbeat),
    "avg_dwell_stateful": lambda g: rooms.average_of_dwell(rooms.dwell_gaps(g.quick_heartbeat)),
    "watch_sessions": lambda g: rooms.watch_sessions(g.quick_heartbeat),
    "heartbeat_feed": lambda g: feeds.heartbeat_feed(g.heartbeat),
    "comment_feed": lambda g: records.comment_feed(g.room_comment),
    "pv_uv_planner": lambda g: reports.planner_pages(g.api_log, SINCE, UNTIL),
    "pv_uv_view": lambda g: reports.view_details(g.api_log, SINCE, UNTIL),
    "dynamic_detail_counts": lambda g: reports.dynamic_details(g.api_log, SINCE, UNTIL),
    "online_now_stream": online_now_stream,
    "online_with_average_stream": online_with_average_stream,
    "dwell_state": dwell_state,
    "dwell_stretches_stream": dwell_stretches_stream,
    "heartbeat_feed_stream": heartbeat_feed_stream,
    "comment_feed_stream": comment_feed_stream,
    "metrics_refresh_stream": metrics_refresh_stream,
}


def _query(build: Callable[[Given], DataFrame]) -> Query:
    return lambda spark, sf_dir: texts(build(Given(spark, sf_dir)))


QUERIES: dict[str, Query] = {name: _query(build) for name, build in _BUILDERS.items()}
