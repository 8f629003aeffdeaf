"""Per-session metrics and their roll-up per host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, scalars
from ..sources import scans
from . import viewers as vw
from .intervals import covered_by, measure


def _zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0)).alias(column)


def peak_estimate(viewer_rows: Column) -> Column:
    return F.ceil(viewer_rows * F.lit(fixed.PEAK_SHARE))


def view_metrics(viewers: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Views, new viewers, dwell and peak estimate per session with viewers.

    Dwell is uncapped here. Averages divide by (uid, device) rows, not by users.
    `viewers` is read twice and should be a table.
    """
    new = F.col("is_new")
    measures = []
    for name, keep in (("old", ~new), ("new", new)):
        def part(column: str, keep: Column = keep) -> Column:
            return F.when(keep, F.col(column))

        measures += [
            (F.sum(part("total")) / F.sum(part("rows"))).alias(f"{name}_user_staying_average"),
            F.max(part("longest")).alias(f"{name}_user_staying_max"),
            F.min(part("shortest")).alias(f"{name}_user_staying_min")]
    by_uid = vw.uids_of_sessions(viewers, known).groupBy("live_id").agg(
        F.count_if(new).alias("first_view_count"),
        peak_estimate(F.sum("rows")).alias("peak"), *measures)
    by_device = viewers.groupBy("live_id").agg(F.countDistinct("device_id").alias("view_count"))
    return by_uid.join(by_device, "live_id")


def comment_metrics(comment: DataFrame, spans: DataFrame, *, viewer_only: bool = True,
                    **join) -> DataFrame:
    """Comment, follow, gift and share counts per session with comments.

    Counted per commenter first and per session second, so the distinct
    commenters need no expansion and a busy session arrives pre-aggregated.
    `viewer_only=False` counts the hosts' own rows too.
    """
    rows = covered_by(scans.comment_numbers(comment), spans, key=("relation_id", "room"),
                      at="c_time", start="win_start", end="win_end", **join)
    human, robot = F.col("is_robot") == 0, F.col("is_robot") == 1
    kind = F.col("discussion_type")
    viewer = (F.col("u_type") == fixed.VIEWER) if viewer_only else F.lit(True)
    host = (F.col("u_type") == fixed.PLANNER) & (kind == fixed.COMMENT)
    wanted = {
        "new_follow_count": kind == fixed.FOLLOW,
        "comment_count": kind == fixed.COMMENT,
        "gift_count": kind == fixed.GIFT,
        "share_count": kind.isin(*fixed.SHARES),
    }
    counts = {"view_count_robot": robot,
              "planner_comment_count": host & (F.col("reply_id") == 0),
              "planner_reply_count": host & (F.col("reply_id") != 0)}
    for name, match in wanted.items():
        counts[name] = viewer & match & human
        counts[f"{name}_robot"] = viewer & match & robot
    per_uid = rows.groupBy("live_id", "uid").agg(
        *[F.count_if(match).alias(name) for name, match in counts.items()])
    return per_uid.groupBy("live_id").agg(
        *[F.sum(name).alias(name) for name in counts],
        F.count_if(F.col("comment_count") > 0).alias("comment_peoples"),
        F.count_if(F.col("comment_count_robot") > 0).alias("comment_peoples_robot"))


COMMENT_METRICS = (
    "view_count_robot", "new_follow_count", "new_follow_count_robot", "comment_count",
    "comment_count_robot", "comment_peoples", "comment_peoples_robot", "gift_count",
    "gift_count_robot", "share_count", "share_count_robot", "planner_comment_count",
    "planner_reply_count",
)
VIEW_METRICS = ("view_count", "first_view_count", "peak")
DWELL_METRICS = fixed.SESSION_RECORD[22:28]


def gift_income(income: DataFrame, sessions: DataFrame, **join) -> DataFrame:
    """Income of the host during the scheduled time, per session with income.

    Rounded to cents: a sum of doubles depends on the order it is taken in, and
    a rerun must give the same record.
    """
    spans = sessions.select(F.col("id").alias("live_id"), F.col("uid").alias("host"),
                            F.date_trunc("second", "start_time").alias("win_start"),
                            F.date_trunc("second", "end_time").alias("win_end"))
    paid = income.where(F.col("status") == 0).select("p_uid", "divide_money", "c_time",
                                                     *scans.day_of(income))
    return (
        covered_by(paid, spans, key=("p_uid", "host"), at="c_time",
                   start="win_start", end="win_end", **join)
        .groupBy("live_id").agg(F.round(F.sum("divide_money"), 2).alias("gift_income"))
    )


def fill_views(sessions: DataFrame, views: DataFrame) -> DataFrame:
    return sessions.select(F.col("id").alias("live_id")).join(views, "live_id", "left").select(
        "live_id", _zero("view_count"), _zero("first_view_count"),
        _zero("peak").alias("max_living_count"))


def fill_comments(sessions: DataFrame, counted: DataFrame) -> DataFrame:
    return sessions.select(F.col("id").alias("live_id")).join(counted, "live_id", "left") \
        .select("live_id", *[_zero(c) for c in COMMENT_METRICS])


def fill_income(sessions: DataFrame, earned: DataFrame) -> DataFrame:
    return sessions.select(F.col("id").alias("live_id")).join(earned, "live_id", "left") \
        .select("live_id", F.coalesce("gift_income", F.lit(0.0)).alias("gift_income"))


def fill_dwell(sessions: DataFrame, views: DataFrame, now: Column | None = None) -> DataFrame:
    spans = vw.windows(sessions, now)
    length = scalars.span_seconds(F.col("win_start"), F.col("win_end"))
    return spans.join(views, "live_id", "left").select(
        "live_id", *[_capped(c, length) for c in DWELL_METRICS])


def _capped(column: str, length: Column) -> Column:
    """0 without viewers, and never more than the session lasted."""
    return F.least(F.coalesce(F.col(column), F.lit(0)), length).alias(column)


def online_in_last_minute(heartbeat: DataFrame, now: Column,
                          seconds: int = 60) -> DataFrame:
    """Viewer points per room in the `seconds` up to `now`: (room, current)."""
    since = now - F.make_dt_interval(secs=F.lit(seconds))
    return (vw.points_by_viewer(heartbeat, since, now).groupBy(F.col("extra_id").alias("room"))
            .agg(F.count("*").alias("current")))


def session_metrics(session: DataFrame, heartbeat: DataFrame, comment: DataFrame,
                    income: DataFrame, *, previous: DataFrame | None = None,
                    known: DataFrame | None = None, now: Column | None = None,
                    viewers: DataFrame | None = None, viewer_only: bool = True,
                    **join) -> DataFrame:
    """The session record: one row per given session, typed, zeros where empty.

    previous  stored records; their max_living_count is a floor for ours
    known     first-seen table of viewers before these heartbeats
    viewers   the viewer table of these sessions, if the caller has it
    now       time of a refresh: running sessions reach to it and the peak is
              what is online in the minute before it instead of an estimate
    """
    spans = vw.windows(session, now)
    length = scalars.span_seconds(F.col("win_start"), F.col("win_end"))
    reach = measure(spans, "win_start", "win_end")
    if viewers is None:
        viewers = vw.viewer_table(heartbeat, spans, reach=reach, **join)
    views = view_metrics(viewers, known)
    counted = comment_metrics(comment, spans, viewer_only=viewer_only, reach=reach, **join)
    # Income is counted by the schedule, which is what was measured unless `now` is given.
    earned = gift_income(income, session, reach=reach if now is None else None, **join)
    out = (
        vw.windows(session, now, "circle_id", "uid", "title", "start_time", "end_time",
                   "live_status")
        .join(views, "live_id", "left").join(counted, "live_id", "left")
        .join(earned, "live_id", "left")
    )
    peak = F.coalesce("peak", F.lit(0))
    if now is not None:
        out = out.join(online_in_last_minute(heartbeat, now), "room", "left")
        peak = F.coalesce("current", F.lit(0))
    if previous is not None:
        stored = previous.select("live_id", F.col("max_living_count").alias("stored_peak"))
        out = out.join(stored, "live_id", "left")
        peak = F.greatest(peak, F.coalesce("stored_peak", F.lit(0)))
    return out.select(
        "live_id", "circle_id", F.col("uid").alias("lcs_id"),
        F.lit(fixed.HOST_NAME).alias("lcs_name"), "start_time", "end_time",
        F.col("title").alias("live_title"), "live_status",
        _zero("view_count"), _zero("view_count_robot"), _zero("first_view_count"),
        peak.cast("bigint").alias("max_living_count"),
        *[_zero(c) for c in fixed.SESSION_RECORD[12:22]],
        *[_capped(c, length) for c in DWELL_METRICS],
        F.coalesce("gift_income", F.lit(0.0)).alias("gift_income"),
        _zero("planner_comment_count"), _zero("planner_reply_count"),
    )


def still_open(session: DataFrame, previous: DataFrame | None, now: Column) -> DataFrame:
    """Sessions that end today or later and are not yet stored as ended; those are final."""
    polled = scans.open_sessions(session, F.date_trunc("day", now))
    if previous is None:
        return polled
    final = previous.where(F.col("live_status") == fixed.ENDED).select(
        F.col("live_id").alias("id"))
    return polled.join(final, "id", "left_anti")


def refresh(session: DataFrame, heartbeat: DataFrame, comment: DataFrame,
            income: DataFrame, previous: DataFrame | None, now: Column, **options) -> DataFrame:
    """One refresh: drop finished sessions before any heavy join, recompute the rest.

    The finished sessions' viewers still count as seen: pass their first-seen
    table as `known`.
    """
    return session_metrics(still_open(session, previous, now), heartbeat, comment, income,
                           previous=previous, now=now, **options)


def planner_rollup(session: DataFrame, stored: DataFrame) -> DataFrame:
    """Totals per host over all eligible sessions; a session not stored adds zeros."""
    return planner_totals(scans.planner_sessions(session), stored)


def planner_totals(eligible: DataFrame, stored: DataFrame) -> DataFrame:
    """The totals of the hosts of eligible sessions (lcs_id, live_id)."""
    summed = ("view_count", "view_count_robot", "comment_count", "comment_count_robot",
              "comment_peoples", "comment_peoples_robot")
    kept = stored.select(
        "live_id", "start_time", "end_time", "max_living_count", "gift_income", *summed)
    return (
        eligible.join(kept, "live_id", "left").groupBy("lcs_id").agg(
            F.count("*").alias("notice_num"),
            F.sum(F.coalesce(scalars.span_seconds(F.col("start_time"), F.col("end_time")),
                             F.lit(0))).alias("live_times"),
            *[F.sum(_zero(c)).alias(c) for c in summed[:2]],
            F.max(_zero("max_living_count")).alias("max_living_count"),
            *[F.sum(_zero(c)).alias(c) for c in summed[2:]],
            F.round(F.sum(F.coalesce("gift_income", F.lit(0.0))), 2).alias("gift_income"))
    )
