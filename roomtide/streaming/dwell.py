"""Dwell per viewer as streams: running seconds of a day, and finished stretches.

A heartbeat adds its distance from the last one, or 15 s when that is above 31 s;
35 s without one add 15 s.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import fixed
from ..operators.rooms import presence, seconds_in_gaps
from ..session import keep_stream_state

BROKEN_GAP, SILENCE, FULL_GAP = fixed.BROKEN_GAP, fixed.SILENCE, fixed.FULL_GAP

KEYS = ["day", "extra_id", "type", "viewer"]
DAY = 86400
_Running = Row("day_number", *KEYS[1:], "seconds", "last")


def _add(total: int, last: int | None, seconds: list[int]) -> tuple[int, int | None]:
    """A total and its last second with ascending later seconds added."""
    for s in seconds:
        if last is not None:
            total += s - last if s - last <= FULL_GAP else BROKEN_GAP
        last = s
    return total, last


class RunningDwell(StatefulProcessor):
    """State of a viewer's day: the sum up to the watermark, the second it goes to, and the
    seconds after it, which rows that are not yet late may still come between. These span
    the lateness and one batch at most, so a state does not grow with the day.

    One timer is set at a time: 35 s after the last second it reports the silence, and at
    the end of the day, when rows of it would be late, it drops the state.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState(
            "dwell", "total bigint, last bigint, recent array<bigint>, timer bigint")

    def _settled(self, total: int, last: int | None, recent: list[int], timers) -> tuple:
        until = timers.getCurrentWatermarkInMs() // 1000
        total, last = _add(total, last, [s for s in recent if s < until])
        return total, last, [s for s in recent if s >= until]

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        total, last, recent, timer = self.state.get() or (0, None, [], None)
        # A second that is settled, or before it, comes too late or again.
        after = -1 if last is None else last
        recent = sorted({*recent, *(r["sec"] for r in rows if r["sec"] > after)})
        total, last, recent = self._settled(total, last, recent, timerValues)
        seconds, newest = _add(total, last, recent)
        if timer is None:
            timer = (newest + SILENCE) * 1000 + 1
            self.handle.registerTimer(timer)
        self.state.update((total, last, recent, timer))
        yield _Running(*key, seconds, newest)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        total, last, recent, _ = self.state.get()
        total, last, recent = self._settled(total, last, recent, timerValues)
        seconds, newest = _add(total, last, recent)
        now, end = timerValues.getCurrentWatermarkInMs(), (key[0] + 1) * DAY * 1000
        silent = (newest + SILENCE) * 1000 + 1
        if now >= end:
            self.state.clear()
        else:
            timer = silent if silent > now else end
            self.handle.registerTimer(timer)
            self.state.update((total, last, recent, timer))
        if silent <= now:
            yield _Running(*key, seconds + BROKEN_GAP, None)

    def close(self) -> None:
        pass


def dwell_state(heartbeat: DataFrame, lateness: str = "1 minute") -> DataFrame:
    """Running seconds per day, room, type and viewer, and the last one; update mode.

    A silence is reported once the watermark is past it, with its worth in the seconds and
    no last one; before that, `latest` adds it by the clock. Needs a state store that keeps
    single values, so the session is set to one.
    """
    keep_stream_state(heartbeat.sparkSession)
    beats = presence(heartbeat).withWatermark("logtime", lateness).select(
        F.floor(F.unix_seconds("logtime") / DAY).cast("int").alias("day_number"), *KEYS[1:],
        "logtime", F.unix_seconds("logtime").alias("sec"))
    states = beats.groupBy("day_number", *KEYS[1:]).transformWithState(
        RunningDwell(), "day_number int, extra_id string, type string, viewer string, "
        "seconds bigint, last bigint", "Update", "EventTime")
    return states.select(F.date_from_unix_date("day_number").alias("day"), *KEYS[1:], "seconds",
                         "last")


def dwell_stretches(heartbeat: DataFrame, lateness: str = "5 seconds") -> DataFrame:
    """Finished stretches of watching and their seconds; append mode, no Python.

    A stretch ends with a silence of more than 35 s, and the seconds of a key's
    stretches add up to its dwell. The state of a stretch is its set of distinct
    seconds, at most 86400 of one day. This is the form for a busy stream; the
    form above reports a viewer while still watching.
    """
    beats = presence(heartbeat).select(
        F.to_date("logtime").alias("day"), "extra_id", "type", "viewer",
        F.date_trunc("second", "logtime").alias("at"))
    seconds = F.sort_array(F.collect_set(F.unix_seconds("at")))
    return (
        beats.withWatermark("at", lateness)
        .groupBy(*KEYS, F.session_window("at", f"{SILENCE} seconds").alias("w"))
        .agg(seconds.alias("s"))
        .select(*KEYS, F.col("w.start").alias("started"), F.col("w.end").alias("ended"),
                (seconds_in_gaps(F.col("s")) + BROKEN_GAP).alias("seconds"))
    )


def latest(updates: DataFrame, as_of: Column) -> DataFrame:
    """Last written seconds of each key, from rows that carry their batch number.

    A viewer who has been silent at `as_of` (in seconds) gets what a silence is worth.
    """
    # A silence that is told in the batch of a later beat comes before it.
    newest = F.max_by(F.struct("seconds", "last"),
                      F.struct("batch", F.col("last").isNotNull(), "seconds")).alias("n")
    silent = F.col("n.last") + SILENCE < as_of
    return updates.groupBy(*KEYS).agg(newest).select(
        *KEYS, (F.col("n.seconds") + F.when(silent, BROKEN_GAP).otherwise(0)).alias("seconds"))


def newest_second(updates: DataFrame) -> int:
    """The last second that any viewer was seen in."""
    return updates.agg(F.max("last")).first()[0] or 0
