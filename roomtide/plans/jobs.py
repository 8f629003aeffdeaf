"""The jobs: sources, operators and sinks put together.

Each takes DataFrames or readers, so the store behind them is the caller's
choice; dates are yyyy-MM-dd. `main` runs the batch jobs on parquet folders.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import args as checks
from ..functions import fixed
from ..operators import records, reports, sessions, slots
from ..operators import viewers as vw
from ..session import build_session, keep_stream_state, materialise, scratch
from ..sources import buckets, readers, scans, sinks
from ..streaming import dwell, feeds, late, online, refresh


def _day_after(day: str) -> str:
    return (date.fromisoformat(day) + timedelta(days=1)).isoformat()


def _day_before(day: str) -> str:
    return (date.fromisoformat(day) - timedelta(days=1)).isoformat()


def extract_slots(api_log: DataFrame, start: str, end: str, out: str, **options) -> None:
    """Slot events of the days start..end into their day partitions, in one pass."""
    first, after = (F.lit(d).cast("timestamp") for d in (start, _day_after(end)))
    days = scans.in_days(api_log, first, after).where(
        (F.col("log_time") >= first) & (F.col("log_time") < after))
    events = slots.slot_events(days, **options)
    sinks.replace_days(records.route_by_event_date(events, "log_time"), out, start, end)


def extract_heartbeats(heartbeat: DataFrame, start: str, end: str, out: str) -> None:
    """Heartbeats of the days start..end into their day partitions, "" where a text is missing."""
    rows = records.heartbeat_defaults(scans.heartbeats(heartbeat, start, _day_after(end)))
    sinks.replace_days(records.route_by_event_date(rows, "logtime"), out, start, end)


def extract_session_heartbeats(heartbeat: DataFrame, session: DataFrame, start: str,
                               end: str, out: str) -> None:
    """Heartbeats of ended sessions on the days start..end, whatever day a session began.

    Only these days are written, and whole. A row's day is that of its client's clock, which
    may be a day off its arrival, so a day more is read on either side: each row is written
    by the runs of its own day, whatever their order.
    """
    first, after = (F.lit(d).cast("timestamp") for d in (_day_before(start),
                                                         _day_after(_day_after(end))))
    overlapping = session.where((F.col("start_time") < after) & (F.col("end_time") >= first))
    beats = scans.in_days(heartbeat, first, after).where(
        (F.col("logtime") >= first) & (F.col("logtime") < after))
    rows = vw.session_heartbeats(beats, overlapping, "logtime")
    sinks.replace_days(records.route_by_event_date(rows, said="c_time").drop("logtime"), out,
                       start, end)


def compute_sessions(session: DataFrame, heartbeat: DataFrame, comment: DataFrame,
                     income: DataFrame, start: str, end: str, *, store: str, version: int,
                     now: Column, **options) -> None:
    """Batch session metrics and everything kept from them, as a version of the store.

    Writes under `store` the bucketed tables metrics (keyed records), live_info (the
    upserted table), viewers (identity sets with expiry), first_seen and planners; of each
    only the buckets of these sessions, their uids and their hosts.
    """
    spark = session.sparkSession
    wanted = scans.sessions(session, start, end)
    with scratch(spark):
        viewers = vw.viewer_table(heartbeat, vw.windows(wanted))
        previous = buckets.read(spark, f"{store}/metrics", version - 1,
                                buckets.touched(wanted, "id"))
        known = refresh.known_of(spark, store, version - 1, viewers)
        fresh = materialise(sessions.session_metrics(
            wanted, heartbeat, comment, income, previous=previous, known=known, viewers=viewers,
            **options), "fresh")
        buckets.put(fresh, f"{store}/metrics", version, "live_id", over=refresh.put_record)
        keep_totals(session, fresh, now, store, version, viewers)
        refresh.keep_seen(known, vw.first_seen(viewers), store, version)


def keep_totals(session: DataFrame, fresh: DataFrame, now: Column, store: str, version: int,
                viewers: DataFrame) -> None:
    """The keyed table with the fresh records put over it, the totals of the hosts of fresh
    records, and the identity sets: those of the sessions computed now and, in their
    buckets, the older ones not yet expired."""
    spark = session.sparkSession
    buckets.put(records.live_info(fresh, now), f"{store}/live_info", version, "notice_id",
                over=lambda old, new: records.upsert(old, new, "notice_id",
                                                     fixed.LIVE_INFO_INSERT_ONLY))

    # A host's total takes all its sessions, whose records may lie in any bucket.
    asked = scans.planner_sessions(session).join(
        fresh.select("lcs_id").distinct(), "lcs_id", "left_semi")
    stored = buckets.read(spark, f"{store}/metrics", version, buckets.touched(asked, "live_id"))
    if stored is not None:
        buckets.put(sessions.planner_totals(asked, stored), f"{store}/planners", version, "lcs_id",
                    over=lambda old, new: records.upsert(old, new, "lcs_id"))

    def put_sets(old: DataFrame, new: DataFrame) -> DataFrame:
        rest = vw.unexpired(old, now).join(fresh.select("live_id"), "live_id", "left_anti")
        return new.unionByName(rest.select(*new.columns))

    buckets.put(vw.with_expiry(vw.identity_set(viewers), now), f"{store}/viewers", version,
                "live_id", over=put_sets, also=buckets.touched(fresh, "live_id"))
    for name in ("live_info", "planners", "viewers"):
        buckets.prune(spark, f"{store}/{name}", version - refresh.KEEP_VERSIONS + 1)


def snapshot_to_days(metrics: DataFrame, planners: DataFrame, dt: str, out: str) -> None:
    """Both keyed stores as text columns into the partition `dt`."""
    live = records.json_snapshot(metrics, "live_id", fixed.SESSION_METRICS)
    hosts = records.json_snapshot(planners, "lcs_id", fixed.PLANNER_METRICS)
    sinks.write_day(records.session_snapshot_flatten(live), f"{out}/live_visit_count", dt)
    sinks.write_day(records.planner_snapshot_flatten(hosts),
                    f"{out}/live_visit_count_circle", dt)


def repair_heartbeats(api_log: DataFrame, start: str, end: str, out: str) -> None:
    """Rebuilt heartbeats of [start, end] into the day partitions of `out`, in the columns
    of the heartbeat table.

    The range may be minutes: repaired rows of other times stay, and a rerun puts its rows
    in place of those it wrote before.
    """
    rows = records.route_by_event_date(records.repaired_heartbeats(api_log, start, end),
                                       "logtime")
    first, last = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    again = (F.col("is_insert") == "1") & F.col("logtime").between(first, last)
    sinks.merge_days(rows, out, start[:10], end[:10], again)


def write_reports(api_log: DataFrame, start: str, end: str, out: str) -> None:
    """The PV/UV reports of the days start..end as tab-separated files."""
    until = _day_after(end)
    made = {
        "planner_pages": reports.planner_pages(api_log, start, until),
        "view_details": reports.view_details(api_log, start, until),
        "dynamic_details": reports.dynamic_details(api_log, start, until),
    }
    for name, report in made.items():
        sinks.write_tsv(report, f"{out}/{name}")


def refresh_target(spark: SparkSession, tables: refresh.Tables, store: str,
                   now: Callable[[], Column] = F.current_timestamp, *, base: int = 0, **options):
    """foreachBatch target that keeps metrics, first_seen, live_info, planners and viewers."""
    def also(fresh: DataFrame, version: int, viewers: DataFrame, at: Column) -> None:
        keep_totals(tables.session(), fresh, at, store, version, viewers)

    return refresh.refresher(spark, tables, store, now, base=base, also=also, **options)


def start_session_refresh(spark: SparkSession, tables: refresh.Tables, store: str,
                          checkpoint: str, **options):
    """Refresh the store of session records every minute."""
    run = refresh_target(spark, tables, store, **options)
    return refresh.start(refresh.clock(spark), run, checkpoint)


def start_online_counts(heartbeat: DataFrame, room_comment: DataFrame, out: str,
                        checkpoint: str, now: Column | None = None):
    """Heartbeat feed, comment feed, online figures with average dwell, and stretches of
    dwell, every 10 seconds; rows that come too late are told in `late`.

    The average of a day comes from sketches that are kept per room and minute, so a batch
    reads its new rows and the sketches of its rooms, not the day.
    """
    spark, every = heartbeat.sparkSession, "10 seconds"
    keep_stream_state(spark)
    midnight = F.date_trunc("day", now if now is not None else F.current_timestamp())
    target = online.with_average(
        online.average_of_day(spark, f"{out}/sketches", midnight),
        feeds.batch_writer(f"{out}/online", compact_every=feeds.COMPACT_EVERY))
    writers = {
        "heartbeats": feeds.files_writer(feeds.heartbeat_feed(heartbeat), f"{out}/heartbeats",
                                         f"{checkpoint}/heartbeats"),
        "comments": feeds.files_writer(records.comment_feed(room_comment), f"{out}/comments",
                                       f"{checkpoint}/comments"),
        "sketches": heartbeat.writeStream.foreachBatch(online.sketch_keeper(f"{out}/sketches"))
        .option("checkpointLocation", f"{checkpoint}/sketches"),
        "online": online.online_now(heartbeat).writeStream.outputMode("append")
        .foreachBatch(target).option("checkpointLocation", f"{checkpoint}/online"),
        "dwell": feeds.files_writer(dwell.dwell_stretches(heartbeat), f"{out}/dwell",
                                    f"{checkpoint}/dwell"),
    }
    spark.streams.addListener(late.LateRows(spark, f"{out}/late"))
    return [w.queryName(name).trigger(processingTime=every).start()
            for name, w in writers.items()]


def extract_comments(room_comment: DataFrame, start: str, end: str, out: str) -> None:
    """The comment feed of the days start..end into their day partitions."""
    rows = scans.room_comments(room_comment, start, _day_after(end)).withColumn(
        "dt", F.to_date(F.try_to_timestamp("c_time")))
    feed = records.comment_feed(rows, keep=("dt",))
    sinks.replace_days(feed, out, start, end)


BATCH = ("slots", "heartbeats", "session-heartbeats", "sessions", "comments", "repair",
         "reports", "snapshot")
STREAMS = ("refresh", "online")


def main(argv: list[str] | None = None) -> None:
    """Batch jobs take START and END; `snapshot` takes the version before END as of that
    day; `refresh` and `online` run until they are stopped and need --checkpoint."""
    parser = argparse.ArgumentParser(prog="roomtide")
    parser.add_argument("job", choices=[*BATCH, *STREAMS])
    parser.add_argument("start", nargs="?")
    parser.add_argument("end", nargs="?")
    parser.add_argument("--tables", required=True, help="folder of the logical tables")
    parser.add_argument("--out", required=True)
    parser.add_argument("--version", type=int, default=1)
    parser.add_argument("--zone", default="UTC", help="time zone of days and clock texts")
    parser.add_argument("--checkpoint", help="folder of the stream checkpoints")
    parser.add_argument("--once", action="store_true", help="streams: only what is there now")
    parser.add_argument("--max-files", type=int, help="streams: files of a batch at most")
    given = parser.parse_args(argv)
    if given.job in STREAMS:
        if not given.checkpoint:
            parser.error("--checkpoint is needed")
    elif not (given.start and given.end):
        parser.error("START and END are needed")
    spark = build_session(f"roomtide-{given.job}")
    # A session that was there before keeps its settings, so the zone is set on it.
    spark.conf.set("spark.sql.session.timeZone", given.zone)
    if given.job in STREAMS:
        _run_stream(spark, given)
    else:
        _run_batch(spark, given)


def _run_batch(spark: SparkSession, given: argparse.Namespace) -> None:
    if given.job == "repair":
        start, end = (checks.date_or_time_arg(t) for t in (given.start, given.end))
    else:
        start, end = checks.date_range_args([given.start, given.end])

    def table(name: str) -> DataFrame:
        return readers.read_files(spark, name, f"{given.tables}/{name}")

    if given.job == "slots":
        extract_slots(table("api_log"), start, end, given.out)
    elif given.job == "heartbeats":
        extract_heartbeats(table("heartbeat"), start, end, given.out)
    elif given.job == "session-heartbeats":
        extract_session_heartbeats(table("heartbeat"), table("session"), start, end, given.out)
    elif given.job == "comments":
        extract_comments(table("room_comment"), start, end, given.out)
    elif given.job == "repair":
        # A range of days is whole; a range with times is as it says.
        until = given.end if len(given.end) > 10 else f"{given.end} 23:59:59.999999"
        repair_heartbeats(table("api_log"), given.start, until, given.out)
    elif given.job == "reports":
        write_reports(table("api_log"), start, end, given.out)
    elif given.job == "snapshot":
        snapshot_to_days(*(buckets.read(spark, f"{given.tables}/{name}")
                           for name in ("metrics", "planners")), end, given.out)
    else:
        compute_sessions(table("session"), table("heartbeat"), table("comment"),
                         table("income"), start, end, store=given.out,
                         version=given.version, now=F.current_timestamp())


def _run_stream(spark: SparkSession, given: argparse.Namespace) -> None:
    def table(name: str) -> Callable[[], DataFrame]:
        return lambda: readers.read_files(spark, name, f"{given.tables}/{name}")

    if given.job == "refresh":
        tables = refresh.Tables(*(table(n) for n in ("session", "heartbeat", "comment", "income")))
        if given.once:
            base = buckets.newest(spark, f"{given.out}/metrics") or 0
            refresh_target(spark, tables, given.out, base=base)(None, 0)
            return
        # What the store held when the checkpoint was new is kept beside it for restarts.
        kept = f"{given.checkpoint}-base"
        if not sinks.versions(spark, kept):
            newest = buckets.newest(spark, f"{given.out}/metrics") or 0
            sinks.write_version(spark.range(1).select(F.lit(newest).alias("base")), kept, 0)
        base = sinks.read_version(spark, kept, 0).first()["base"]
        queries = [start_session_refresh(spark, tables, given.out, given.checkpoint, base=base)]
    else:
        def stream(name: str) -> DataFrame:
            return readers.stream_files(spark, readers.SCHEMAS[name], f"{given.tables}/{name}",
                                        max_files=given.max_files)

        queries = start_online_counts(stream("heartbeat"), stream("room_comment"), given.out,
                                      given.checkpoint)
    for q in queries:
        if given.once:
            q.processAllAvailable()
            q.stop()
        else:
            q.awaitTermination()


if __name__ == "__main__":
    main()
