"""Scans: filters and projections that reach the file or JDBC reader."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed

LIVE_ROOM_TYPES = (fixed.ROOM_VIDEO, fixed.ROOM_TEXT)
# The day partition of tables that are kept by day; it is that of the time they are asked by.
DAY = "dt"


def day_of(rows: DataFrame) -> list[str]:
    """The day partition, if the table has one, for projections that are to keep it."""
    return [DAY] if DAY in rows.columns else []


def in_days(rows: DataFrame, first: Column, last: Column) -> DataFrame:
    """The rows of the days from first to last: whole partitions outside are not read. A
    table that does not lie in days is left as it is."""
    return rows.where(F.col(DAY).between(F.to_date(first), F.to_date(last))) \
        if DAY in rows.columns else rows


def _time(value: str | Column) -> Column:
    return F.lit(value).cast("timestamp") if isinstance(value, str) else value


def heartbeats(heartbeat: DataFrame, start, end, *, room: str | None = None,
               types: tuple[str, ...] | None = LIVE_ROOM_TYPES,
               closed: bool = False, ordered: bool = False) -> DataFrame:
    """Heartbeats with logtime in [start, end), or [start, end] when `closed`.

    `types=None` drops the type filter, as the stream poll does. `ordered` sorts
    by logtime; device and uid break ties so that equal times can be split.
    """
    ts = F.col("logtime")
    upper = ts <= _time(end) if closed else ts < _time(end)
    out = in_days(heartbeat, _time(start), _time(end)).where((ts >= _time(start)) & upper)
    if types is not None:
        out = out.where(F.col("type").isin(*types))
    if room:
        out = out.where(F.col("extra_id") == room)
    return out.orderBy("logtime", "device_id", "uid") if ordered else out


def api_logs(api_log: DataFrame, start, end, actions: tuple[str, ...], *,
             columns: tuple[str, ...] = ("log_time", "deviceId", "action", "data"),
             closed: bool = False) -> DataFrame:
    """All wanted actions in one pass: log_time in [start, end), or closed."""
    ts = F.col("log_time")
    upper = ts <= _time(end) if closed else ts < _time(end)
    return (in_days(api_log, _time(start), _time(end))
            .where((ts >= _time(start)) & upper & F.col("action").isin(*actions))
            .select(*columns))


def api_logs_with_token(api_log: DataFrame, start, end, searches: tuple[tuple[str, str, str], ...],
                        *, columns: tuple[str, ...] = ("log_time", "deviceId", "action", "data"),
                        out: str = "token", closed: bool = False) -> DataFrame:
    """Logs whose payload mentions the token of their action, in one pass.

    `searches` are (action, column, token); column `out` names the token found.
    """
    read = dict.fromkeys((*columns, "action", *(column for _, column, _ in searches)))
    rows = api_logs(api_log, start, end, tuple(s[0] for s in searches), columns=tuple(read),
                    closed=closed)
    found = F.lit(None).cast("string")
    for action, column, token in reversed(searches):
        found = F.when((F.col("action") == action) & F.col(column).contains(token),
                       F.lit(token)).otherwise(found)
    return rows.withColumn(out, found).where(F.col(out).isNotNull()).select(*columns, out)


def eligible_sessions(session: DataFrame) -> DataFrame:
    out = session.where(F.col("live_status").isin(fixed.ENDED, fixed.RUNNING))
    for column, value in fixed.ELIGIBLE_SESSION.items():
        out = out.where(F.col(column) == value)
    return out


SESSION_COLUMNS = ("id", "circle_id", "u_type", "uid", "title", "start_time",
                   "end_time", "live_status")


def sessions(session: DataFrame, start, end, *, ordered: bool = False) -> DataFrame:
    """Eligible sessions ending in [start, end): the bound is explicit and half-open."""
    ts = F.col("end_time")
    out = (eligible_sessions(session).where((ts >= _time(start)) & (ts < _time(end)))
           .select(*SESSION_COLUMNS))
    return out.orderBy("id") if ordered else out


def open_sessions(session: DataFrame, today) -> DataFrame:
    """What each refresh polls: not yet over before `today`, any kind of room."""
    return (session.where((F.col("end_time") > _time(today))
                          & F.col("live_status").isin(fixed.ENDED, fixed.RUNNING))
            .select(*SESSION_COLUMNS))


def comments(comment: DataFrame, start, end, room: str | None = None) -> DataFrame:
    """Comments with c_time in [start, end]; a NULL number reads as 0."""
    ts = F.col("c_time")
    out = in_days(comment, _time(start), _time(end)).where(
        (ts >= _time(start)) & (ts <= _time(end)))
    if room:
        out = out.where(F.col("relation_id") == room)
    return comment_numbers(out)


def comment_numbers(comment: DataFrame) -> DataFrame:
    numbers = ("u_type", "uid", "discussion_type", "is_robot", "reply_id")
    return comment.select(
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in numbers],
        "c_time", "relation_id", *day_of(comment))


def incomes(income: DataFrame, start, end, planner: int | None = None) -> DataFrame:
    ts = F.col("c_time")
    out = in_days(income, _time(start), _time(end)).where(
        (F.col("status") == 0) & (ts >= _time(start)) & (ts <= _time(end)))
    return out.where(F.col("p_uid") == planner) if planner is not None else out


def planner_sessions(session: DataFrame, planner: int | None = None) -> DataFrame:
    out = eligible_sessions(session).select(F.col("uid").alias("lcs_id"),
                                            F.col("id").alias("live_id"))
    return out.where(F.col("lcs_id") == planner) if planner is not None else out


def distinct_planners(session: DataFrame) -> DataFrame:
    return session.select(F.col("uid").alias("lcs_id")).distinct()


def room_comments(room_comment: DataFrame, start: str, end: str) -> DataFrame:
    """Comment feed with the ISO text c_time in [start, end)."""
    ts = F.try_to_timestamp(F.col("c_time"))
    return room_comment.where((ts >= _time(start)) & (ts < _time(end)))


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every date from start to end, both included; empty when end is before start."""
    return (
        spark.range(1)
        .select(F.explode(F.when(
            F.to_date(F.lit(start)) <= F.to_date(F.lit(end)),
            F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end))))).alias("dt")))


def date_spine_of(df: DataFrame, ts: str) -> DataFrame:
    """Every date between the first and the last of a timestamp column."""
    day = F.to_date(F.col(ts))
    return (df.agg(F.min(day).alias("a"), F.max(day).alias("b"))
            .select(F.explode(F.sequence("a", "b")).alias("dt")))
