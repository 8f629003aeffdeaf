"""JSON records to typed rows and back: heartbeats, snapshots, repair, upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed, scalars
from ..functions.jsonx import field, json_map
from ..sources import scans

# Seconds that a client's clock may be off its arrival.
CLOCK_OFF = 86400


def flatten(df: DataFrame, text: str, columns: tuple[str, ...]) -> DataFrame:
    """Each row's JSON object as string columns, "" where a member is missing."""
    parsed = df.withColumn("_m", json_map(F.col(text)))
    kept = [c for c in df.columns if c != text and c not in columns]
    return parsed.select(*kept, *[field(F.col("_m"), c).alias(c) for c in columns])


def heartbeat_flatten(records: DataFrame, text: str = "body") -> DataFrame:
    return flatten(records, text, fixed.HEARTBEAT_COLUMNS)


def heartbeat_defaults(heartbeat: DataFrame) -> DataFrame:
    """The 16 heartbeat columns, "" where a text is missing."""
    return heartbeat.select(*[
        F.col(c) if c == "logtime" else F.coalesce(F.col(c), F.lit("")).alias(c)
        for c in fixed.HEARTBEAT_COLUMNS])


def session_snapshot_flatten(snapshot: DataFrame) -> DataFrame:
    """29 string columns of a (live_id, value) snapshot."""
    return flatten(snapshot.select("value"), "value", fixed.SESSION_SNAPSHOT)


def planner_snapshot_flatten(snapshot: DataFrame) -> DataFrame:
    """The host id and its 10 figures of a (lcs_id, value) snapshot."""
    return flatten(snapshot, "value", fixed.PLANNER_METRICS)


def wire(df: DataFrame, *columns: str) -> DataFrame:
    """Every column as the text the stores keep: seconds for times, digits for numbers."""
    def text(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return scalars.second_text(F.col(field.name))
        return F.col(field.name).cast("string")

    return df.select(*[text(df.schema[c]).alias(c) for c in columns or df.columns])


def json_snapshot(df: DataFrame, key: str, columns: tuple[str, ...]) -> DataFrame:
    """(key, value): the record as one JSON object of strings."""
    texts = wire(df, *dict.fromkeys((key, *columns)))
    return texts.select(key, F.to_json(F.struct(*columns)).alias("value"))


def live_info(metrics: DataFrame, now: Column) -> DataFrame:
    """Session metrics in the names of the keyed table, stamped with `now`."""
    names = {"notice_id": "live_id", "p_uid": "lcs_id"}
    return metrics.select(
        *[F.col(names.get(c, c)).alias(c) for c in fixed.LIVE_INFO],
        *[now.alias(c) for c in fixed.LIVE_INFO_INSERT_ONLY])


def upsert(stored: DataFrame, new: DataFrame, key: str,
           insert_only: tuple[str, ...] = ()) -> DataFrame:
    """`stored` with the rows of `new` put over it by `key`.

    A key in both takes the new values, NULLs included, except `insert_only`
    columns, which keep what was written when the key first came.
    """
    old, put = stored.alias("o"), new.alias("n")
    is_new = F.col(f"n.{key}").isNotNull()
    was_there = F.col(f"o.{key}").isNotNull()

    def value(c: str) -> Column:
        if c == key:
            return F.coalesce(f"n.{c}", f"o.{c}")
        take_new = ~was_there if c in insert_only else is_new
        return F.when(take_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))

    joined = old.join(put, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    return joined.select(*[value(c).alias(c) for c in stored.columns])


def insert_new(stored: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of `new` whose key is not stored yet."""
    return new.join(stored.select(key), key, "left_anti").select(*new.columns)


def repaired_heartbeats(api_log: DataFrame, start, end) -> DataFrame:
    """Heartbeats rebuilt from the API logs of the heartbeat call of [start, end]: the
    columns of the heartbeat table, and is_insert."""
    logs = scans.api_logs(api_log, start, end, (fixed.HEARTBEAT_ACTION,), closed=True,
                          columns=("log_time", "deviceId", "params", "uid", "client_ip"))
    logs = (logs.withColumn("_p", json_map(F.coalesce("params", F.lit("{}"))))
            .withColumn("_get", json_map(field(F.col("_p"), "get")))
            .withColumn("_header", json_map(field(F.col("_p"), "header"))))

    def get(key: str) -> Column:
        return field(F.col("_get"), key)

    made = {
        "c_time": scalars.second_text(F.col("log_time")), "logtime": F.col("log_time"),
        "device_id": F.coalesce("deviceId", F.lit("")), "uid": F.coalesce("uid", F.lit("")),
        "ip": F.coalesce("client_ip", F.lit("")), "refer": field(F.col("_header"), "referer"),
        "u_type": F.lit(str(fixed.VIEWER)), "record_type": F.lit(""), "second": F.lit(""),
        "ext": F.concat(F.lit('{"is_small_window":"'), get("is_small_window"), F.lit('"}')),
        **{m: get(m) for m in ("type", "extra_id", "is_online", "fr", "p_uid", "source")}}
    return logs.select(*[made[c].alias(c) for c in fixed.HEARTBEAT_COLUMNS],
                       F.lit("1").alias("is_insert"))


def heartbeat_repair(api_log: DataFrame, start, end) -> DataFrame:
    """The rebuilt heartbeats as the store takes them: the instant as ISO text."""
    rows = repaired_heartbeats(api_log, start, end)
    return rows.withColumn("u_type", F.col("u_type").cast("int")) \
        .withColumn("logtime", scalars.iso_text(F.col("logtime"))).drop("record_type", "second")


def event_date(said: Column, arrived: Column) -> Column:
    """The day of a row by the clock text of its client. By its arrival where the text is
    blank or no time, or more than a day from it, as that clock is wrong."""
    own = F.try_to_timestamp(said)
    near = F.abs(F.unix_seconds(own) - F.unix_seconds(arrived)) <= CLOCK_OFF
    return F.to_date(F.when(near, own).otherwise(arrived))


def route_by_event_date(rows: DataFrame, ts: str = "logtime",
                        said: str | None = None) -> DataFrame:
    """Add dt, the date of the row's own time, for one partitioned write: of the timestamp
    `ts`, or, if one is named, of the clock text `said` that came at it."""
    day = F.to_date(F.col(ts)) if said is None else event_date(F.col(said), F.col(ts))
    return rows.withColumn("dt", day)


def comment_feed(room_comment: DataFrame, zone: str = "Asia/Shanghai",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """Comments with content and time, the ISO time as wall clock of `zone`, and the columns
    to keep."""
    return room_comment.where((F.col("content") != "") & (F.col("c_time") != "")).select(
        "uid", "name", "relation_id", "content",
        scalars.iso_to_local(F.col("c_time"), zone).alias("c_time"), "title", *keep)

