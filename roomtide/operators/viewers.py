"""Viewers of a session: points, dwell, newness, identities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, scalars
from ..session import materialise
from ..sources import scans
from .intervals import covered_by

POINT_KEYS = ("extra_id", "type", "device_id", "uid")


def points_by_viewer(heartbeat: DataFrame, start, end, room: str | None = None, *,
                     by_second: bool = False) -> DataFrame:
    """Heartbeats per room, type, device and uid in [start, end].

    `by_second` adds the `second` value, "30" where it is missing. All groups
    are returned. Heartbeats without a device or uid member are in no group.
    """
    rows = scans.heartbeats(heartbeat, start, end, room=room, closed=True) \
        .where(F.col("device_id").isNotNull() & F.col("uid").isNotNull())
    keys = list(POINT_KEYS)
    if by_second:
        rows = rows.withColumn(
            "sec", F.coalesce("second", F.lit(str(fixed.DEFAULT_BEAT_SECONDS))))
        keys.append("sec")
    return rows.groupBy(*keys).agg(F.count("*").alias("points"))


def windows(sessions: DataFrame, now: Column | None = None, *keep: str) -> DataFrame:
    """(live_id, room, win_start, win_end): a running session reaches to `now` if given."""
    until = F.col("end_time")
    if now is not None:
        until = F.when(F.col("live_status") == fixed.RUNNING, now).otherwise(until)
    return sessions.select(F.col("id").alias("live_id"), F.col("circle_id").alias("room"),
                           F.date_trunc("second", "start_time").alias("win_start"),
                           F.date_trunc("second", until).alias("win_end"), *keep)


def session_heartbeats(heartbeat: DataFrame, sessions: DataFrame, *keep: str) -> DataFrame:
    """Room-video heartbeats of ended sessions, 12 columns and those to keep, bounds
    included."""
    ended = sessions.where(F.col("live_status") == fixed.ENDED).select(
        F.col("id").alias("live_id"), F.col("circle_id").alias("room"),
        "start_time", "end_time")
    beats = heartbeat.where(F.col("type") == fixed.ROOM_VIDEO).select(
        "extra_id", "device_id", "uid", "ext", "fr", "is_online", "p_uid", "c_time",
        "logtime", *scans.day_of(heartbeat))
    return covered_by(beats, ended, key=("extra_id", "room"), at="logtime").select(
        "live_id", "start_time", "end_time", "extra_id", "device_id", "uid", "ext",
        "fr", "is_online", "p_uid", "c_time", F.lit(fixed.ROOM_VIDEO).alias("type"), *keep)


def viewer_dwell(heartbeat: DataFrame, spans: DataFrame, **join) -> DataFrame:
    """One row per session, uid and device of the room's video viewers.

    dwell is the sum of the seconds its heartbeats stand for; first_at is its
    first heartbeat in the session.
    """
    beats = heartbeat.where(
        (F.col("type") == fixed.ROOM_VIDEO) & (F.col("device_id") != "")
        & F.col("uid").isNotNull()
    ).select("extra_id", "uid", "device_id", "logtime",
             scalars.beat_seconds(F.col("second")).alias("sec"), *scans.day_of(heartbeat))
    return (
        covered_by(beats, spans, key=("extra_id", "room"), at="logtime",
                   start="win_start", end="win_end", **join)
        .groupBy("live_id", "extra_id", "uid", "device_id")
        .agg(F.sum("sec").alias("dwell"), F.min("logtime").alias("first_at"),
             F.min("win_start").alias("win_start"), F.max("win_end").alias("win_end"))
    )


def viewer_table(heartbeat: DataFrame, spans: DataFrame, **join) -> DataFrame:
    """viewer_dwell written once to the shared folder.

    The metrics read viewers along two ways, per uid and per device; without the
    table each way would scan and join the heartbeats again.
    """
    return materialise(viewer_dwell(heartbeat, spans, **join), "viewers")


def first_seen(viewers: DataFrame) -> DataFrame:
    """When each uid was first seen in each room."""
    return (viewers.where(F.col("uid") != "").groupBy("extra_id", "uid")
            .agg(F.min("first_at").alias("first_at")))


def earliest(seen: DataFrame) -> DataFrame:
    """One row per room and uid of first-seen rows that may hold them again."""
    return seen.groupBy("extra_id", "uid").agg(F.min("first_at").alias("first_at"))


def merge_first_seen(known: DataFrame, seen: DataFrame) -> DataFrame:
    """Incremental form: the earlier time of the kept table and a new batch."""
    return earliest(known.unionByName(seen))


def uids_of_sessions(viewers: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per session and uid, with is_new and the figures of its devices.

    A uid is new in a session if it is not blank and was first seen in the room
    during it. Only viewers of sessions count as seen, so the viewer rows are
    the history; `known` adds the first-seen table of earlier runs.

    Devices collapse before the window, which leaves it at most one row per
    session of the room for any uid.
    """
    uids = viewers.groupBy("live_id", "extra_id", "uid").agg(
        F.count("*").alias("rows"), F.sum("dwell").alias("total"),
        F.max("dwell").alias("longest"), F.min("dwell").alias("shortest"),
        F.min("first_at").alias("first_at"), F.min("win_start").alias("win_start"),
        F.max("win_end").alias("win_end"))
    uids = uids.withColumn(
        "first", F.min("first_at").over(Window.partitionBy("extra_id", "uid")))
    if known is not None:
        # The table may hold a uid again; only uids of these sessions are looked at. They are
        # asked for plainly, filter over scan, so that Spark can send a Bloom filter of them
        # into the scan of a large table.
        asked = viewers.where(F.col("uid") != "").select("extra_id", "uid")
        earlier = (known.join(asked, ["extra_id", "uid"], "left_semi")
                   .groupBy("extra_id", "uid").agg(F.min("first_at").alias("known")))
        uids = uids.join(earlier, ["extra_id", "uid"], "left") \
            .withColumn("first", F.least("first", "known")).drop("known")
    in_session = (F.col("first") >= F.col("win_start")) & (F.col("first") <= F.col("win_end"))
    return uids.withColumn("is_new", (F.col("uid") != "") & in_session)


def _new_uids(viewers: DataFrame, known: DataFrame | None) -> DataFrame:
    return uids_of_sessions(viewers, known).where("is_new").select("live_id", "uid")


def new_viewers(viewers: DataFrame, known: DataFrame | None = None) -> DataFrame:
    return viewers.join(_new_uids(viewers, known), ["live_id", "uid"], "left_semi")


def old_viewers(viewers: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Blank uids are old by definition, so the devices without one, which may be most of
    a busy session, are not joined at all."""
    named = viewers.where((F.col("uid") != "") & F.col("uid").isNotNull())
    blank = viewers.where((F.col("uid") == "") | F.col("uid").isNull())
    return named.join(_new_uids(viewers, known), ["live_id", "uid"], "left_anti") \
        .select(*viewers.columns).unionByName(blank)


def identity_set(viewers: DataFrame) -> DataFrame:
    """Distinct identities per session: a device's longest uid, else the device."""
    longest = F.max_by("uid", F.struct(F.length("uid"), F.col("uid")))
    return (
        viewers.groupBy("live_id", "device_id").agg(longest.alias("uid"))
        .select("live_id", scalars.identity(F.col("uid"), F.col("device_id")).alias("identity"))
        .distinct()
    )


def with_expiry(identities: DataFrame, written_at: Column,
                days: int = fixed.VIEWER_SET_DAYS) -> DataFrame:
    return identities.withColumn("expires_at", written_at + F.make_dt_interval(F.lit(days)))


def unexpired(identities: DataFrame, now: Column) -> DataFrame:
    return identities.where(F.col("expires_at") > now)
