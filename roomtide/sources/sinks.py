"""Writers. All of them leave the same table when a job runs twice."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import children, exists, materialise, remove, scratch


def write_days(df: DataFrame, path: str, day: str = "dt") -> None:
    """Replace exactly the day partitions that `df` has rows for.

    The rebalance hint gathers each day into few files and lets AQE cut a day
    that is too large for one task.
    """
    (df.hint("rebalance", day).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path))


def _days(start: str, end: str) -> list[str]:
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    return [(first + timedelta(n)).isoformat() for n in range((last - first).days + 1)]


def replace_days(df: DataFrame, path: str, start: str, end: str) -> None:
    """Replace the day partitions start..end: with the rows of `df` that fall on them, or
    with nothing where it has none. Other days are not touched, nor written."""
    spark = df.sparkSession
    rows = df.where(F.col("dt").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    with scratch(spark):
        # Read twice: for its days and for the write.
        rows = materialise(rows, "days")
        full = {str(r[0]) for r in rows.select("dt").distinct().collect()}
        write_days(rows, path)
    there = set(children(spark, path))
    for day in _days(start, end):
        if day not in full and f"dt={day}" in there:
            remove(spark, f"{path}/dt={day}")


def merge_days(df: DataFrame, path: str, start: str, end: str, replaced: Column) -> None:
    """Put `df` into the day partitions start..end in place of the stored rows that
    `replaced` holds for; what else the days hold stays."""
    spark = df.sparkSession
    with scratch(spark):
        rows = df
        if exists(spark, path):
            stored = spark.read.schema(df.schema).parquet(path).where(
                F.col("dt").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
            rows = stored.where(~F.coalesce(replaced, F.lit(False))).select(*df.columns) \
                .unionByName(df)
        # Apart from the days first, as they are read and written.
        replace_days(materialise(rows, "merged"), path, start, end)


def write_day(df: DataFrame, path: str, dt: str) -> None:
    """Replace the whole partition `dt`, also when `df` is empty."""
    df.write.mode("overwrite").parquet(f"{path}/dt={dt}")


def write_placed(df: DataFrame, name: str, key: str, buckets: int, day: str = "dt") -> None:
    """Overwrite a catalog table that lies in days and, within them, in buckets of a key, for
    joins on the key that need not move it."""
    (df.repartition(buckets, F.col(key)).write.mode("overwrite").format("parquet")
     .partitionBy(day).bucketBy(buckets, key).sortBy(key).saveAsTable(name))


def write_table(df: DataFrame, name: str) -> None:
    """Overwrite a whole catalog table."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated report with a header, in as many files as there are partitions.

    A blank is written as "" and a NULL as nothing; `read_tsv` tells them apart.
    """
    df.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def read_tsv(spark: SparkSession, schema: str, path: str) -> DataFrame:
    return (spark.read.schema(schema).option("sep", "\t").option("header", True)
            .option("nullValue", "\\N").csv(path))


def write_version(df: DataFrame, path: str, version: int) -> None:
    """A new version of a keyed table next to the older ones, in a folder of its own.

    The version being read is never the one being written. A rerun of the same
    version replaces it; an empty one is there, too.
    """
    df.write.mode("overwrite").parquet(f"{path}/version={version}")


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The given version, or the newest; only that version's files are read."""
    if version is None:
        version = max(versions(spark, path))
    return spark.read.parquet(f"{path}/version={version}")


def versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(c.removeprefix("version=")) for c in children(spark, path)
                  if c.startswith("version="))


def drop_versions(spark: SparkSession, path: str, before: int) -> None:
    """Remove the versions older than `before`."""
    for v in versions(spark, path):
        if v < before:
            remove(spark, f"{path}/version={v}")
