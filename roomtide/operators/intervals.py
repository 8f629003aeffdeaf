"""Join of facts to the intervals that cover them, per key.

Rooms are few and some are very busy, so a plain equi join on the room would
send a busy room to one task and compare each of its rows with every session
the room ever had. Both forms below add the day to the equi key. When the
schedule is measured to be small it is broadcast and the facts do not move at
all. Otherwise both sides shuffle on (key, day, salt): the days of a key that
hold too many facts are counted first and cut into as many salts as they need.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from ..sources.scans import day_of, in_days

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
ROWS_PER_SALT = 2_000_000


@dataclass(frozen=True)
class Reach:
    """Size of an interval table and the span of time it covers, in microseconds."""

    rows: int
    bytes: int
    first: int | None
    last: int | None


def measure(intervals: DataFrame, start: str, end: str) -> Reach:
    """One aggregate over the interval side: a single row comes back.

    `rows` and `bytes` count an interval once per day it touches, as the join does.
    """
    width = sum((F.coalesce(F.octet_length(name), F.lit(0)) if kind == "string" else F.lit(0)) + 8
                for name, kind in intervals.dtypes)
    days = F.datediff(end, start) + 1
    row = (
        intervals.where(F.col(start) <= F.col(end))
        .agg(F.sum(days).alias("rows"), F.sum(days * width).alias("bytes"),
             F.min(F.unix_micros(start)).alias("first"),
             F.max(F.unix_micros(end)).alias("last"))
        .first()
    )
    return Reach(row["rows"] or 0, row["bytes"] or 0, row["first"], row["last"])


def covered_by(facts: DataFrame, intervals: DataFrame, *, key: tuple[str, str], at: str,
               start: str = "start_time", end: str = "end_time",
               broadcast_rows: int = BROADCAST_ROWS, rows_per_salt: int = ROWS_PER_SALT,
               reach: Reach | None = None, placed: bool = False) -> DataFrame:
    """Inner join: each fact with every interval of its key and start <= at <= end.

    `key` is (fact column, interval column); `intervals` should carry only the
    columns the caller needs, none named like a fact column. Of facts that lie in days
    only the partitions of the measured span are read; the day is not in the result.
    `reach` passes on a measurement the caller already has. `placed` says that the facts
    lie in buckets of their key (`sinks.write_placed`): a large schedule is then brought to
    them, and they are neither shuffled nor salted. That takes the setting
    spark.sql.requireAllClusterKeysForCoPartition=false, and keys without a bucket that is
    too large for a task.
    """
    fact_key, interval_key = key
    reach = reach or measure(intervals, start, end)
    if reach.rows:
        first = F.timestamp_micros(F.lit(reach.first))
        last = F.timestamp_micros(F.lit(reach.last))
        facts = facts.where((F.col(at) >= first) & (F.col(at) <= last))
        facts = in_days(facts, first, last)
    facts = facts.drop(*day_of(facts))

    by_day = (
        intervals.where(F.col(start) <= F.col(end))
        .withColumn("_day", F.explode(F.sequence(F.to_date(start), F.to_date(end))))
    )
    columns = [*facts.columns, *intervals.columns]
    facts = facts.withColumn("_fact_day", F.to_date(at))
    on = ((F.col(fact_key) == F.col(interval_key)) & (F.col("_fact_day") == F.col("_day"))
          & (F.col(at) >= F.col(start)) & (F.col(at) <= F.col(end)))
    if reach.rows <= broadcast_rows and reach.bytes <= BROADCAST_BYTES:
        by_day = F.broadcast(by_day)
    elif placed:
        by_day = by_day.hint("merge")
    else:
        heavy = heavy_days(facts, fact_key, "_fact_day", rows_per_salt)
        spread = F.pmod(F.xxhash64(*facts.columns), F.col("_salts"))
        facts = _with_salts(facts, heavy, fact_key, "_fact_day") \
            .withColumn("_fact_salt", spread)
        by_day = _with_salts(by_day, heavy, interval_key, "_day").withColumn(
            "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_salts") - 1))
        ).drop("_salts")
        on = on & (F.col("_fact_salt") == F.col("_salt"))
    return facts.join(by_day, on).select(*columns)


def heavy_days(facts: DataFrame, key: str, day: str, rows_per_salt: int) -> DataFrame:
    """Keys and days with more than `rows_per_salt` facts and the salts they need.

    There are fewer of them than facts divided by `rows_per_salt`, which is what
    allows them to be broadcast.
    """
    counted = facts.groupBy(F.col(key).alias("_key"), F.col(day).alias("_heavy_day")) \
        .agg(F.count("*").alias("_rows")).where(F.col("_rows") > rows_per_salt)
    return materialise(counted.select(
        "_key", "_heavy_day",
        F.ceil(F.col("_rows") / rows_per_salt).cast("bigint").alias("_salts")), "heavy-days")


def _with_salts(df: DataFrame, heavy: DataFrame, key: str, day: str) -> DataFrame:
    on = (F.col(key) == F.col("_key")) & (F.col(day) == F.col("_heavy_day"))
    # A written table, so counting it is cheap.
    small = F.broadcast(heavy) if heavy.count() <= BROADCAST_ROWS else heavy
    return (df.join(small, on, "left").drop("_key", "_heavy_day")
            .withColumn("_salts", F.coalesce("_salts", F.lit(1).cast("bigint"))))
