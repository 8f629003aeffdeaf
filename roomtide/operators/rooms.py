"""Counts per room: points, devices, average dwell, who is online now."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, scalars
from ..sources import scans


def room_points_devices(heartbeat: DataFrame, since, until, *,
                        approximate: bool = False, rsd: float = 0.05) -> DataFrame:
    """Online points and distinct devices per room and type in [since, until)."""
    rows = scans.heartbeats(heartbeat, since, until).where(F.col("is_online") == "1")
    devices = F.approx_count_distinct("device_id", rsd) if approximate \
        else F.countDistinct("device_id")
    return rows.groupBy("extra_id", "type").agg(
        F.count("*").alias("points"), devices.alias("device_id_count"))


# Registers of a device sketch, as a power of two: the relative standard error of a count is
# 1.04 / sqrt(2**12) = 1.6 %.
SKETCH_BITS = 12


def device_sketches(heartbeat: DataFrame) -> DataFrame:
    """Online points and a sketch of the devices per minute, room and type."""
    rows = heartbeat.where((F.col("is_online") == "1")
                           & F.col("type").isin(*scans.LIVE_ROOM_TYPES))
    # As a code, since sketches pass over empty texts.
    device = F.when(F.col("device_id").isNotNull(), F.xxhash64("device_id"))
    return rows.groupBy(F.date_trunc("minute", "logtime").alias("minute"), "extra_id", "type").agg(
        F.count("*").alias("points"),
        F.hll_sketch_agg(device, F.lit(SKETCH_BITS)).alias("devices"))


def merge_sketches(sketches: DataFrame, days: int = 2) -> DataFrame:
    """One row per minute, room and type, without those that are `days` older than the
    newest of their room."""
    newest = F.max("minute").over(Window.partitionBy("extra_id", "type"))
    return (sketches.groupBy("minute", "extra_id", "type")
            .agg(F.sum("points").alias("points"), F.hll_union_agg("devices").alias("devices"))
            .withColumn("_newest", newest)
            .where(F.col("minute") >= F.col("_newest") - F.make_dt_interval(F.lit(days)))
            .drop("_newest"))


def points_of_sketches(sketches: DataFrame) -> DataFrame:
    """Points and devices per room and type, as `room_points_devices` counts them."""
    return sketches.groupBy("extra_id", "type").agg(
        F.sum("points").alias("points"),
        F.hll_sketch_estimate(F.hll_union_agg("devices")).alias("device_id_count"))


def average_dwell(points: DataFrame) -> DataFrame:
    """Whole seconds per device and room: every point stands for 30 seconds."""
    labels = list(fixed.LIVE_TYPE_CODES)
    usable = (F.col("extra_id") != "") & (F.col("extra_id") != "null") \
        & F.col("type").isin(*labels) & (F.col("device_id_count") > 0)
    average = F.expr(f"points * {fixed.DEFAULT_BEAT_SECONDS} div device_id_count")
    return points.where(usable).select("extra_id", "type", average.alias("average"))


def top_rooms(heartbeat: DataFrame, n: int = 10) -> DataFrame:
    """The n rooms with the most heartbeats, most first; the name breaks ties."""
    return (heartbeat.groupBy("extra_id").agg(F.count("*").alias("points"))
            .orderBy(F.desc("points"), "extra_id").limit(n))


def presence(heartbeat: DataFrame, *keep: str) -> DataFrame:
    """Heartbeats that count as online: (extra_id, type, viewer, logtime)."""
    viewer = scalars.identity(F.col("uid"), F.col("device_id"))
    room = F.col("extra_id")
    return (
        heartbeat.where(
            (room != "") & (room != "null") & (viewer != "")
            & (scalars.online_flag(F.col("is_online")) == "1")
            & F.col("type").isin(*fixed.LIVE_TYPE_CODES))
        .select("extra_id", "type", viewer.alias("viewer"), "logtime", *keep)
    )


def online_now(heartbeat: DataFrame, window: int = fixed.ONLINE_WINDOW,
               slide: int = fixed.ONLINE_SLIDE) -> DataFrame:
    """Distinct viewers per room and type in the `window` seconds before each tick.

    Sliding windows would copy every heartbeat into each window that holds it
    and then remove duplicates. Here a viewer's ticks are made distinct first,
    and each covers only the windows up to the viewer's next tick, so that a
    window counts a viewer once and is summed up before it is shuffled.
    """
    if window % slide:
        raise ValueError("the window must be a multiple of the slide")
    reach, per_day = window // slide, 86400 // slide
    viewer = ["extra_id", "type", "viewer"]
    tick = F.floor(F.unix_micros("logtime") / (slide * 1000000))
    day = F.floor(F.col("tick") / per_day)
    ticks = presence(heartbeat).select(*viewer, tick.alias("tick")).distinct()
    # A window holds one viewer's day. The first ticks of a day also stand, as no tick of
    # their own, in the day before, whose last ticks need them.
    early = F.col("tick") - day * per_day < reach
    ticks = ticks.withColumn("day", F.explode(
        F.when(early, F.array(day, day - 1)).otherwise(F.array(day))))
    following = F.lead("tick").over(Window.partitionBy(*viewer, "day").orderBy("tick"))
    until = F.least(F.col("tick") + reach, F.coalesce(following, F.col("tick") + reach))
    return (
        ticks.withColumn("until", until).where(F.col("day") == day)
        .select("extra_id", "type", F.explode(F.sequence(F.col("tick") + 1, "until")).alias("end"))
        .groupBy("end", "extra_id", "type").agg(F.count("*").alias("online"))
        .select(F.timestamp_seconds(F.col("end") * slide).alias("window_end"),
                "extra_id", "type", "online")
    )


def online_with_average(online: DataFrame, average: DataFrame) -> DataFrame:
    """Rooms with both figures, with the type as its code."""
    return online.join(average, ["extra_id", "type"]).select(
        "window_end", "extra_id", scalars.live_type_code(F.col("type")).alias("type"),
        "online", "average")


def peak_online_running(online: DataFrame) -> DataFrame:
    """Highest online figure so far per room and type.

    In two levels: the highest of each day, running over the days, and the running
    highest within a day. So a task sees a room's days or a day's ticks, never all ticks.
    """
    room = ["extra_id", "type"]
    dated = online.withColumn("_day", F.floor(F.unix_seconds("window_end") / 86400))
    before = Window.partitionBy(*room).orderBy("_day").rowsBetween(
        Window.unboundedPreceding, -1)
    days = (dated.groupBy(*room, "_day").agg(F.max("online").alias("_top"))
            .select(*room, "_day", F.max("_top").over(before).alias("_before")))
    today = Window.partitionBy(*room, "_day").orderBy("window_end").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (dated.withColumn("_peak", F.max("online").over(today))
            .join(days, [*room, "_day"])
            .select(*online.columns, F.greatest("_peak", "_before").alias("peak")))


def _gap_seconds(gap: Column) -> Column:
    return F.when(gap <= fixed.FULL_GAP, gap).otherwise(fixed.BROKEN_GAP)


def seconds_in_gaps(seconds: Column) -> Column:
    """What the gaps of an ascending array of seconds are worth in total."""
    earlier = F.slice(seconds, F.lit(1), F.size(seconds) - 1)
    later = F.slice(seconds, F.lit(2), F.size(seconds))
    gaps = F.zip_with(later, earlier, lambda b, a: b - a)
    total = F.aggregate(gaps, F.lit(0).cast("bigint"), lambda t, g: t + _gap_seconds(g))
    return F.when(F.size(seconds) > 1, total).otherwise(0)


def dwell_gaps(heartbeat: DataFrame) -> DataFrame:
    """Dwell per day, room, type and viewer from the gaps between heartbeats.

    A gap of at most 31 s counts in full, a longer one 15 s, and so does the
    silence after the last heartbeat. Several heartbeats in one second count
    once. A day starts afresh.

    A busy viewer is not sorted as a whole: seconds are first gathered per hour,
    where they number at most 3600, and the gaps between hours are added after.
    """
    key = ["day", "extra_id", "type", "viewer"]
    sec = F.unix_seconds("logtime")
    hourly = (
        presence(heartbeat)
        .select(F.to_date("logtime").alias("day"), "extra_id", "type", "viewer",
                F.floor(sec / 3600).alias("_hour"), sec.alias("_sec"))
        .groupBy(*key, "_hour").agg(F.sort_array(F.collect_set("_sec")).alias("s"))
    )
    spans = hourly.select(
        *key, "_hour", F.element_at("s", 1).alias("_first"),
        F.element_at("s", -1).alias("_last"),
        seconds_in_gaps(F.col("s")).alias("_inner"))
    to_previous = F.col("_first") - F.lag("_last").over(
        Window.partitionBy(*key).orderBy("_hour"))
    return (
        spans.withColumn("_gap", to_previous)
        .withColumn("_between", F.when(F.col("_gap").isNull(), 0)
                    .otherwise(_gap_seconds(F.col("_gap"))))
        .groupBy(*key)
        .agg((F.sum(F.col("_inner") + F.col("_between")) + fixed.BROKEN_GAP).alias("seconds"))
    )


def average_of_dwell(dwell: DataFrame) -> DataFrame:
    """Whole seconds per viewer, room and type."""
    return dwell.groupBy("extra_id", "type").agg(
        F.expr("sum(seconds) div count(*)").alias("average"))


def watch_segments(heartbeat: DataFrame, gap: int = fixed.SILENCE) -> DataFrame:
    """Stretches of watching within a day: (extra_id, type, viewer, day, started, last, beats).

    Heartbeats collapse to one row per viewer and second before the session window sorts
    a viewer's day. Segments of days can be kept and stitched later.
    """
    viewer = ["extra_id", "type", "viewer"]
    beats = (
        presence(heartbeat)
        .groupBy(*viewer, F.date_trunc("second", "logtime").alias("at"))
        .agg(F.count("*").alias("n"))
    )
    return (
        beats.groupBy(*viewer, F.to_date("at").alias("day"),
                      F.session_window("at", f"{gap} seconds").alias("w"))
        # Times of the beats, not of the window: a filter on the window, which is a key, would
        # be pushed below the merging of windows and part them.
        .agg(F.min("at").alias("started"), F.max("at").alias("last"), F.sum("n").alias("beats"))
        .select(*viewer, "day", "started", "last", "beats")
    )


def stitch(segments: DataFrame, gap: int = fixed.SILENCE) -> DataFrame:
    """Segments of days put together where no silence parts them at midnight.

    Only segments near a midnight can go on in the day before or after, at most two of a
    viewer and day; these alone are put in order.
    """
    viewer = ["extra_id", "type", "viewer"]
    pause = F.make_dt_interval(secs=F.lit(gap))
    midnight = F.col("day").cast("timestamp")
    at_edge = (F.col("started") - pause <= midnight) | (
        F.col("last") + pause >= F.date_add("day", 1).cast("timestamp"))
    in_order = Window.partitionBy(*viewer).orderBy("started")
    begins = F.coalesce(F.col("started") > F.lag("last").over(in_order) + pause, F.lit(True))
    joined = (
        segments.where(at_edge).withColumn("_begins", begins.cast("int"))
        .withColumn("_run", F.sum("_begins").over(
            in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy(*viewer, "_run").agg(F.min("started").alias("started"),
                                      F.max("last").alias("last"), F.sum("beats").alias("beats"))
    )
    columns = [*viewer, "started", "last", "beats"]
    return joined.select(*columns).unionByName(segments.where(~at_edge).select(*columns))


def watch_sessions(heartbeat: DataFrame, gap: int = fixed.SILENCE) -> DataFrame:
    """Stretches of watching without a silence of `gap` seconds, over any number of days."""
    return stitch(watch_segments(heartbeat, gap), gap).select(
        "extra_id", "type", "viewer", "started",
        (F.col("last") + F.make_dt_interval(secs=F.lit(gap))).alias("ended"), "beats")


def slice_coverage(df: DataFrame, ts: str, seconds: int = 60) -> DataFrame:
    """Rows per slice of each day, empty slices included: [from, to) of the day."""
    per_day = 86400 // seconds
    spine = scans.date_spine_of(df, ts).withColumn(
        "slice", F.explode(F.sequence(F.lit(0), F.lit(per_day - 1))))
    at = F.col(ts)
    of_day = F.unix_seconds(at) - F.unix_seconds(F.date_trunc("day", at))
    counted = df.groupBy(
        F.to_date(at).alias("dt"), F.floor(of_day / seconds).cast("int").alias("slice")
    ).agg(F.count("*").alias("n"))

    def clock(number: Column) -> Column:
        return F.format_string("%02d:%02d:%02d", F.floor(number / 3600),
                               F.floor(number / 60) % 60, number % 60)

    return spine.join(counted, ["dt", "slice"], "left").select(
        "dt", clock(F.col("slice") * seconds).alias("slice_from"),
        clock((F.col("slice") + 1) * seconds).alias("slice_to"),
        F.coalesce("n", F.lit(0)).alias("n"))
