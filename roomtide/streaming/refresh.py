"""Per-minute refresh of the session records."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import records, sessions
from ..operators import viewers as vw
from ..session import scratch
from ..sources import buckets, scans, sinks

# Versions that can still be read.
KEEP_VERSIONS = 3


@dataclass(frozen=True)
class Tables:
    """Readers of the tables a refresh looks at; each call reads the current state."""

    session: Callable[[], DataFrame]
    heartbeat: Callable[[], DataFrame]
    comment: Callable[[], DataFrame]
    income: Callable[[], DataFrame]


def clock(spark: SparkSession) -> DataFrame:
    """A stream that ticks, to drive a refresh that has no input of its own."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).load()


def time_of(spark: SparkSession, store: str, version: int, now: Callable[[], Column]) -> Column:
    """The time of a version: asked once and kept, so that a repeated batch has it too."""
    path = f"{store}/clock"
    if version not in sinks.versions(spark, path):
        sinks.write_version(spark.range(1).select(now().alias("at")), path, version)
    micros = sinks.read_version(spark, path, version).select(F.unix_micros("at")).first()[0]
    return F.timestamp_micros(F.lit(micros))


def refresher(spark: SparkSession, tables: Tables, store: str, now: Callable[[], Column], *,
              base: int = 0, also: Callable[..., None] | None = None,
              **options) -> Callable[[DataFrame, int], None]:
    """foreachBatch target: recompute open sessions and write the next store version.

    The store is two bucketed tables below `store`: metrics, the records by session, and
    first_seen, when each uid first came to a room. Either may be missing at the start.
    Batch n reads version base + n and writes the one after, so a repeated batch reads and
    writes the same versions; a few old ones are kept for that. Read and written are only
    the buckets of the sessions that are polled and of the uids that were in them, however
    large the store is. `base` is the version both tables had when the stream's checkpoint
    was new. `also(fresh, version, viewers, at)` writes what else is kept of a refresh.
    """
    def run(_: DataFrame, number: int) -> None:
        version = base + number + 1
        at = time_of(spark, store, version, now)
        session, heartbeat = tables.session(), tables.heartbeat()
        with scratch(spark):
            polled = scans.open_sessions(session, F.date_trunc("day", at))
            previous = buckets.read(spark, f"{store}/metrics", version - 1,
                                    buckets.touched(polled, "id"))
            wanted = sessions.still_open(session, previous, at)
            viewers = vw.viewer_table(heartbeat, vw.windows(wanted, at))
            known = known_of(spark, store, version - 1, viewers)
            fresh = sessions.refresh(session, heartbeat, tables.comment(), tables.income(),
                                     previous, at, known=known, viewers=viewers, **options)
            buckets.put(fresh, f"{store}/metrics", version, "live_id", over=put_record)
            keep_seen(known, vw.first_seen(viewers), store, version)
            if also:
                stored = buckets.read(spark, f"{store}/metrics", version,
                                      buckets.touched(wanted, "id"))
                if stored is not None:
                    asked = wanted.select(F.col("id").alias("live_id"))
                    also(stored.join(asked, "live_id", "left_semi"), version, viewers, at)
        for name in ("metrics", "first_seen"):
            buckets.prune(spark, f"{store}/{name}", version - KEEP_VERSIONS + 1)
        sinks.drop_versions(spark, f"{store}/clock", version - KEEP_VERSIONS + 1)
    return run


def put_record(stored: DataFrame, new: DataFrame) -> DataFrame:
    return records.upsert(stored, new, "live_id")


def known_of(spark: SparkSession, store: str, version: int, viewers: DataFrame) -> DataFrame | None:
    """What the first-seen table holds in the buckets of these viewers."""
    asked = viewers.where(F.col("uid") != "").select("extra_id", "uid")
    return buckets.read(spark, f"{store}/first_seen", version,
                        buckets.touched(asked, "extra_id", "uid"))


def keep_seen(known: DataFrame | None, seen: DataFrame, store: str, version: int) -> None:
    """Add to the first-seen table what is earlier than it knows."""
    new = seen
    if known is not None:
        # Only rooms and uids of this batch are compared.
        earlier = vw.earliest(known.join(seen, ["extra_id", "uid"], "left_semi")) \
            .withColumnRenamed("first_at", "_known")
        new = seen.join(earlier, ["extra_id", "uid"], "left").where(
            F.col("_known").isNull() | (F.col("first_at") < F.col("_known"))).drop("_known")
    buckets.add(new, f"{store}/first_seen", version, "extra_id", "uid", merge=vw.earliest)


def start(ticks: DataFrame, run: Callable[[DataFrame, int], None], checkpoint: str,
          every: str = "60 seconds"):
    return (ticks.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
            .trigger(processingTime=every).start())
