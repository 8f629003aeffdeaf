"""Keyed tables in hash partitions, of which an update writes only those it touches.

A row lies in the bucket of its key's hash. A bucket has parts, named by the version
that wrote them: a `whole` part holds all of the bucket, an `added` part what that
version put beside the parts before. Reading a version takes, of every bucket, the
newest whole part up to it and what was added since, so a repeated batch finds what it
found before and replaces what it wrote, and no file that is being read is overwritten.
Folders are the only record: `buckets=N/bucket=B/part=whole-V`.

How much an update reads and writes follows from the buckets of its keys. The driver sees
names of folders and numbers of buckets, at most a few for each bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import matching, materialise, remove, scratch

BUCKETS = 64
# Added parts of a bucket after which the next update writes it whole.
MOST_ADDED = 16

_Part = tuple[str, int]


def bucket_of(*keys: str, buckets: int = BUCKETS) -> Column:
    """The bucket of a key, which is hashed as text: the same for integers of any size."""
    texts = [F.col(k).cast("string") for k in keys]
    return F.pmod(F.xxhash64(*texts), F.lit(buckets)).cast("int")


def touched(rows: DataFrame, *keys: str, buckets: int = BUCKETS) -> list[int]:
    """The buckets in which the keys of some rows lie."""
    found = rows.select(bucket_of(*keys, buckets=buckets).alias("b")).distinct().collect()
    return sorted(r["b"] for r in found)


def _root(path: str, buckets: int) -> str:
    return f"{path}/buckets={buckets}"


def _parts(spark: SparkSession, path: str, buckets: int, only: Iterable[int] | None,
           upto: int | None) -> dict[int, list[_Part]]:
    """Of every bucket the parts that make it up at a version, oldest first."""
    which = "*" if only is None else "{%s}" % ",".join(map(str, only))
    found: dict[int, list[_Part]] = {}
    for folder in matching(spark, f"{_root(path, buckets)}/bucket={which}/part=*"):
        at, part = folder.rsplit("/", 2)[1:]
        kind, version = part.removeprefix("part=").split("-")
        if upto is None or int(version) <= upto:
            found.setdefault(int(at.removeprefix("bucket=")), []).append((kind, int(version)))
    return {b: _since_whole(parts) for b, parts in found.items()}


def _since_whole(parts: list[_Part]) -> list[_Part]:
    whole = max((v for kind, v in parts if kind == "whole"), default=-1)
    return sorted((p for p in parts if p == ("whole", whole) or p[0] == "added" and p[1] > whole),
                  key=lambda p: p[1])


def newest(spark: SparkSession, path: str, buckets: int = BUCKETS) -> int | None:
    """The newest version that wrote any bucket; None if there is nothing yet."""
    return max((v for parts in _parts(spark, path, buckets, None, None).values()
                for _, v in parts), default=None)


def read(spark: SparkSession, path: str, upto: int | None = None,
         only: Iterable[int] | None = None, buckets: int = BUCKETS) -> DataFrame | None:
    """The table at a version, or the newest of each bucket; of some buckets, if only they are
    asked for. None where there is nothing. Added parts may hold a key again."""
    if only is not None and not (only := list(only)):
        return None
    root = _root(path, buckets)
    places = [f"{root}/bucket={b}/part={kind}-{v}"
              for b, parts in sorted(_parts(spark, path, buckets, only, upto).items())
              for kind, v in parts]
    if not places:
        return None
    return spark.read.option("basePath", root).parquet(*places).drop("bucket", "part")


def put(rows: DataFrame, path: str, version: int, *keys: str, buckets: int = BUCKETS,
        over: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
        also: Iterable[int] = ()) -> None:
    """Write the buckets of `rows`, and the buckets `also`, whole.

    What the buckets held before the version is put together with the rows by
    `over(stored, rows)`; without it the rows alone stay. Buckets that nothing is left of
    are written empty.
    """
    spark = rows.sparkSession
    with scratch(spark):
        # Read for its buckets and for its rows.
        rows = materialise(rows, "put")
        at = sorted({*touched(rows, *keys, buckets=buckets), *also})
        stored = read(spark, path, version - 1, at, buckets) if over else None
        whole = rows if stored is None else over(stored.select(*rows.columns), rows)
        _write(whole, path, keys, buckets, F.lit(f"whole-{version}"))
        empty = set(at) - {b for b, parts in _parts(spark, path, buckets, at, version).items()
                           if ("whole", version) in parts}
        for b in sorted(empty):
            whole.where("false").write.mode("overwrite").parquet(
                f"{_root(path, buckets)}/bucket={b}/part=whole-{version}")


def add(rows: DataFrame, path: str, version: int, *keys: str, buckets: int = BUCKETS,
        merge: Callable[[DataFrame], DataFrame] = DataFrame.distinct) -> None:
    """Put rows beside what their buckets hold. A bucket that has gathered MOST_ADDED parts
    is written whole, as `merge` makes it of all its rows."""
    spark = rows.sparkSession
    with scratch(spark):
        rows = materialise(rows, "add")
        at = touched(rows, *keys, buckets=buckets)
        full = [b for b, parts in _parts(spark, path, buckets, at, version - 1).items()
                if len(parts) > MOST_ADDED]
        of_full = bucket_of(*keys, buckets=buckets).isin(full)
        _write(rows.where(~of_full), path, keys, buckets, F.lit(f"added-{version}"))
        if full:
            whole = read(spark, path, version - 1, full, buckets).select(*rows.columns)
            _write(merge(whole.unionByName(rows.where(of_full))), path, keys, buckets,
                   F.lit(f"whole-{version}"))


def _write(rows: DataFrame, path: str, keys: tuple[str, ...], buckets: int, part: Column) -> None:
    (rows.withColumns({"bucket": bucket_of(*keys, buckets=buckets), "part": part})
     .hint("rebalance", "bucket").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "part")
     .parquet(_root(path, buckets)))


def prune(spark: SparkSession, path: str, upto: int, buckets: int = BUCKETS) -> None:
    """Remove the parts that no version from `upto` on is read from."""
    root = _root(path, buckets)
    needed = _parts(spark, path, buckets, None, upto)
    for folder in matching(spark, f"{root}/bucket=*/part=*"):
        at, name = folder.rsplit("/", 2)[1:]
        kind, version = name.removeprefix("part=").split("-")
        if int(version) <= upto and (kind, int(version)) not in needed[
                int(at.removeprefix("bucket="))]:
            remove(spark, folder)
