"""Who is online now, as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..operators import rooms
from ..session import materialise, scratch
from ..sources import buckets

LATENESS = "5 seconds"
# Batches whose version of the sketches can still be read.
KEPT_BATCHES = 3


def online_now(heartbeat: DataFrame, *, window: int = fixed.ONLINE_WINDOW,
               slide: int = fixed.ONLINE_SLIDE, lateness: str = LATENESS) -> DataFrame:
    """Distinct viewers per window, room and type, emitted when a window closes.

    A stream cannot count distinct values, and a set per room would gather a
    busy room in one state entry. So viewers are grouped first, one small entry
    each, and the groups of a closed window are counted. Before a heartbeat is copied
    into every window that holds it, one of each viewer and slide is kept.
    """
    keys = ["w", "extra_id", "type"]
    once = (
        ticks(heartbeat, window, slide, lateness)
        .groupBy(F.window("logtime", f"{window} seconds", f"{slide} seconds").alias("w"),
                 "extra_id", "type", "viewer")
        .agg(F.count("*").alias("beats"))
    )
    return once.groupBy(*keys).agg(F.count("*").alias("online")).select(
        F.col("w.end").alias("window_end"), "extra_id", "type", "online")


def ticks(heartbeat: DataFrame, window: int, slide: int, lateness: str) -> DataFrame:
    """One heartbeat of each viewer, room and slide, as far as the watermark lets them be
    compared. Windows are whole slides, so any of them stands for the others."""
    if window % slide:
        raise ValueError("the window must be a multiple of the slide")
    return (rooms.presence(heartbeat).withWatermark("logtime", lateness)
            .withColumn("tick", F.floor(F.unix_micros("logtime") / (slide * 1000000)))
            .dropDuplicatesWithinWatermark(["extra_id", "type", "viewer", "tick"]).drop("tick"))


def online_now_approximate(heartbeat: DataFrame, *, window: int = fixed.ONLINE_WINDOW,
                           slide: int = fixed.ONLINE_SLIDE, lateness: str = LATENESS,
                           rsd: float = 0.02) -> DataFrame:
    """The same with a fixed-size sketch per window and room instead of exact counts."""
    return (
        ticks(heartbeat, window, slide, lateness)
        .groupBy(F.window("logtime", f"{window} seconds", f"{slide} seconds").alias("w"),
                 "extra_id", "type")
        .agg(F.approx_count_distinct("viewer", rsd).alias("online"))
        .select(F.col("w.end").alias("window_end"), "extra_id", "type", "online")
    )


def with_average(average: Callable[[DataFrame], DataFrame | None],
                 write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """foreachBatch target: join each batch of online figures with the average dwell that
    `average` gives for its rooms, and write the rooms that have both."""
    def run(batch: DataFrame, number: int) -> None:
        with scratch(batch.sparkSession):
            # Read for its rooms and for its figures.
            batch = materialise(batch, "online")
            known = average(batch)
            if known is not None:
                write(rooms.online_with_average(batch, known), number)
    return run


def sketch_keeper(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch target: the device sketches of new heartbeats into a bucketed table,
    which a room's day is summed up from. A repeated batch replaces what it wrote."""
    def run(batch: DataFrame, number: int) -> None:
        buckets.add(rooms.device_sketches(batch), path, number, "extra_id", "type",
                    merge=rooms.merge_sketches)
        buckets.prune(batch.sparkSession, path, number - KEPT_BATCHES)
    return run


def average_of_day(spark: SparkSession, path: str, since: Column) -> Callable[
        [DataFrame], DataFrame | None]:
    """For `with_average`: the average dwell since a time, from the kept sketches of the
    rooms asked for; no heartbeat is read again."""
    def average(asked: DataFrame) -> DataFrame | None:
        room = ["extra_id", "type"]
        kept = buckets.read(spark, path, only=buckets.touched(asked, *room))
        if kept is None:
            return None
        of_day = kept.where(F.col("minute") >= since).join(asked.select(*room), room, "left_semi")
        return rooms.average_dwell(rooms.points_of_sketches(of_day))
    return average
