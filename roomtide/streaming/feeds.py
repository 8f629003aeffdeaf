"""Stateless feeds and the plumbing of the streaming writes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions import scalars
from ..operators.rooms import presence
from ..session import children, keep_stream_state, materialise, remove, scratch, work_path


def heartbeat_feed(heartbeat: DataFrame) -> DataFrame:
    """Online heartbeats as (extra_id, type code, uid, c_time); batch or stream."""
    return presence(heartbeat, "c_time").select(
        "extra_id", scalars.live_type_code(F.col("type")).alias("type"),
        F.col("viewer").alias("uid"), "c_time")


# Batches after which the folders of a feed are gathered, and the newest that are left alone.
COMPACT_EVERY, LEFT_ALONE = 360, 3


def batch_writer(path: str, compact_every: int | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch target: one partition per batch, so a repeated batch replaces itself.

    With `compact_every`, partitions of older batches are gathered now and then.
    """
    def write(batch: DataFrame, number: int) -> None:
        (batch.withColumn("batch", F.lit(number)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path))
        if compact_every and number and number % compact_every == 0:
            compact(batch.sparkSession, path, number - LEFT_ALONE)
    return write


def compact(spark: SparkSession, path: str, upto: int) -> None:
    """Gather the batches up to `upto` into that one's partition.

    To be run between batches, for ones that will not be repeated. The gathered rows
    keep their batch number in `from_batch`, by which one that ended halfway is made up for:
    what has been gathered already is not gathered again.
    """
    old = [int(c.removeprefix("batch=")) for c in children(spark, path) if c.startswith("batch=")]
    old = [n for n in old if n <= upto]
    if len(old) < 2:
        return
    rows = spark.read.option("mergeSchema", True).parquet(path).where(F.col("batch") <= upto)
    if "from_batch" in rows.columns:
        gathered = rows.where("from_batch IS NOT NULL")
        done = gathered.select(F.col("from_batch").alias("batch")).distinct()
        rows = gathered.unionByName(rows.where("from_batch IS NULL")
                                    .join(done, "batch", "left_anti").select(*rows.columns))
    else:
        rows = rows.withColumn("from_batch", F.lit(None).cast("int"))
    with scratch(spark):
        rows = materialise(rows.withColumn("from_batch", F.coalesce("from_batch", "batch"))
                           .withColumn("batch", F.lit(upto)), "compact")
        (rows.hint("rebalance").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path))
    for n in old:
        if n != upto:
            remove(spark, f"{path}/batch={n}")


def files_writer(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append to parquet; the file sink records what each batch wrote."""
    return (stream.writeStream.outputMode("append").format("parquet")
            .option("path", path).option("checkpointLocation", checkpoint))


def replay(stream: DataFrame, name: str, *, updates: bool = False) -> DataFrame:
    """Run a stream over everything its source has now and return what it wrote.

    With `updates` the rows are versions of their keys and carry a batch column.
    """
    spark = stream.sparkSession
    keep_stream_state(spark)
    path, checkpoint = work_path(spark, name), work_path(spark, f"{name}-checkpoint")
    if updates:
        writer = (stream.writeStream.outputMode("update").foreachBatch(batch_writer(path))
                  .option("checkpointLocation", checkpoint))
        schema = stream.schema.add("batch", "integer")
    else:
        writer, schema = files_writer(stream, path, checkpoint), stream.schema
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(schema).parquet(path)
