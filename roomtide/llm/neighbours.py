"""Nearest neighbours by a block matrix join with quantised tiles.

Vectors are packed into blocks with int8 copies. A tile is one block of queries
against one block of candidates. Its int8 products, with the norms of what
quantising left out, bound every inner product from both sides; only pairs whose
upper bound reaches the k-th largest lower bound of the query, or the k-th best
found before, are computed again from the original numbers. A task takes a group of
query blocks and a group of candidate blocks, of bounded size, keeps a heap per query
over their tiles, and the heaps are merged per query. The larger the groups, the fewer
copies of a block are shuffled.

The bounds hold at every magnitude, so the result is exact: vectors are measured after
division by a power of two, and the bounds allow for what the score itself loses when it
is very small. Where a score may overflow, its pair is always computed. A pair is left
out only if its bound is known to be too small.

Defined results: vectors that are null, empty, zero or hold a null or non-finite
component, and rows without an id, take no part; vectors of different length are
not compared; a query id given twice is searched once, with its smallest vector;
candidates given twice count twice; candidates with the query's id never count; a score
that overflows is infinite or, where infinities cancel, not a number, which counts as
the largest; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 4096
# Bytes of vectors that a group of blocks has, about, and tiles of a task at most.
GROUP_BYTES = 64 << 20
TASK_TILES = 1024
# Tasks that there are at least, where there are as many tiles.
TASKS = 64
_KINDS = {"ids": np.int64, "rows": np.float64, "codes": np.int8, "scales": np.float64,
          "lost": np.float64, "norms": np.float64, "powers": np.int32}
_PACKED = "dim int, block long, " + ", ".join(f"{c} binary" for c in _KINDS)


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def _pack(block: int):
    """Blocks of up to `block` vectors of one length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            size = vectors.value_lengths().to_numpy(zero_copy_only=False)
            begins = np.concatenate(([0], np.cumsum(size)))
            out = []
            for dim in np.unique(size):
                own = np.flatnonzero(size == dim)
                for at in range(0, len(own), block):
                    which = own[at:at + block]
                    rows = flat[begins[which][:, None] + np.arange(dim)]
                    out.append((int(dim), int(ids[which[0]]), *(
                        x.tobytes() for x in (ids[which].astype(np.int64), rows,
                                              *quantised(rows)))))
            kinds = [pa.int32(), pa.int64()] + [pa.binary()] * len(_KINDS)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)],
                names=["dim", "block", *_KINDS])

    return run


def quantised(rows: np.ndarray) -> tuple[np.ndarray, ...]:
    """Codes, and of every row divided by 2**power: the scale of its codes, the norm of what
    they leave out and its own norm; and the power."""
    powers = np.frexp(np.abs(rows).max(axis=1))[1].astype(np.int32)
    even = np.ldexp(rows, -powers[:, None])
    scales = np.abs(even).max(axis=1) / 127
    codes = np.rint(even / scales[:, None]).astype(np.int8)
    lost = np.sqrt(((even - codes * scales[:, None]) ** 2).sum(axis=1))
    return codes, scales, lost, np.sqrt((even ** 2).sum(axis=1)), powers


def _blocks_of(group: pa.Table) -> list[dict]:
    out = []
    for row in group.to_batches():
        for i in range(row.num_rows):
            got = {c: np.frombuffer(row.column(c)[i].as_py(), k) for c, k in _KINDS.items()}
            dim = row.column("dim")[i].as_py()
            got["rows"], got["codes"] = (got[c].reshape(-1, dim) for c in ("rows", "codes"))
            out.append(got)
    return out


def inner(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, added component by component."""
    total = np.zeros(len(x))
    for d in range(x.shape[1]):
        total += x[:, d] * y[:, d]
    return total


def survivors(q: dict, c: dict, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a tile that may be among the k nearest, or reach the query's floor."""
    dim = q["codes"].shape[1]
    # In units of 2**(power of the query + largest power of the candidates).
    top = int(c["powers"].max())
    scales, lost, norms = (np.ldexp(c[n], c["powers"] - top) for n in ("scales", "lost", "norms"))
    unit = q["powers"].astype(np.int64) + top
    # Products of int8 codes are whole numbers that float32 holds exactly up to 2**24.
    kind = np.float32 if dim * 127 * 127 < 1 << 24 else np.float64
    about = (q["codes"].astype(kind) @ c["codes"].T.astype(kind)).astype(np.float64)
    about *= q["scales"][:, None]
    about *= scales[None, :]
    # |<x,y> - <x',y'>| <= |x-x'| |y| + |x'| |y-y'|, and a little for rounding.
    slack = (q["lost"][:, None] * norms[None, :]
             + (q["norms"] + q["lost"])[:, None] * lost[None, :])
    slack += 1e-9 * q["norms"][:, None] * norms[None, :]
    with np.errstate(over="ignore"):
        # Numbers near the smallest have rounding of their own, here and in the score.
        slack += 1e-300 + np.ldexp(float(dim), np.clip(-1070 - unit, -1000, 2000))[:, None]
        floor = np.ldexp(np.where(np.isnan(floor), np.inf, floor),
                         np.clip(-unit, -2200, 2200).astype(np.int32)) - 1e-300
    # Scores that may overflow are not bounded at all.
    wide = unit + np.log2(dim) + 2 > 1020
    mine = q["ids"][:, None] == c["ids"][None, :]
    low = np.where(mine | wide[:, None], -np.inf, about - slack)
    floor = np.where(wide, -np.inf, floor)
    if low.shape[1] > k:
        floor = np.maximum(floor, np.partition(low, low.shape[1] - k, axis=1)[:, -k])
    return np.nonzero(~(about + slack < floor[:, None]) & ~mine)


def _search(k: int):
    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, list]] = []
        against = _blocks_of(candidates)
        for q in _blocks_of(queries) if against else []:
            # Entries are ordered as the result is, numbers that are none first.
            heaps: list[list[tuple[bool, float, int]]] = [[] for _ in q["ids"]]
            for c in against:
                floor = np.array([(np.inf if h[0][0] else h[0][1]) if len(h) == k else -np.inf
                                  for h in heaps])
                i, j = survivors(q, c, k, floor)
                for at in range(0, len(i), 1 << 16):
                    part = slice(at, at + (1 << 16))
                    with np.errstate(over="ignore", invalid="ignore"):
                        score = inner(q["rows"][i[part]], c["rows"][j[part]])
                    for a, s, name in zip(i[part].tolist(), score.tolist(),
                                          c["ids"][j[part]].tolist()):
                        heap, entry = heaps[a], (s != s, 0.0 if s != s else s, -name)
                        if len(heap) < k:
                            heapq.heappush(heap, entry)
                        elif entry > heap[0]:
                            heapq.heapreplace(heap, entry)
            found.append((np.repeat(q["ids"], [len(h) for h in heaps]),
                          [e for h in heaps for e in h]))
        best = [e for _, own in found for e in own]
        return pa.table({
            "query_id": pa.array(np.concatenate([i for i, _ in found])
                                 if found else np.zeros(0, np.int64), pa.int64()),
            "vec_id": pa.array([-n for _, _, n in best], pa.int64()),
            "score": pa.array([float("nan") if odd else s for odd, s, _ in best], pa.float64())})

    return run


def group_sizes(query_blocks: int, candidate_blocks: int, dim: int) -> tuple[int, int]:
    """Blocks of a group of queries and of one of candidates.

    Every query block is sent to all groups of candidates and the other way round; with so
    many tiles a task, what is sent is least if query groups have four times the blocks.
    """
    tiles = min(TASK_TILES, max(1, query_blocks * candidate_blocks // TASKS))
    return (max(1, min(round(2 * tiles ** 0.5), GROUP_BYTES // (QUERY_BLOCK * dim * 9))),
            max(1, min(round(tiles ** 0.5 / 2), GROUP_BYTES // (CANDIDATE_BLOCK * dim * 9))))


def nearest(queries: DataFrame, candidates: DataFrame, k: int = 20, key: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k candidates of largest inner product."""
    def clean(df: DataFrame) -> DataFrame:
        return df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector")) \
            .where(F.col("id").isNotNull() & usable(F.col("vector")))

    asked = clean(queries).groupBy("id").agg(F.min("vector").alias("vector"))
    n = [-(-df.count() // size) for df, size in ((queries, QUERY_BLOCK),
                                                 (candidates, CANDIDATE_BLOCK))]
    dim = candidates.agg(F.max(F.size(vector))).first()[0] or 1
    across, down = (max(1, -(-blocks // size))
                    for blocks, size in zip(n, group_sizes(*n, max(1, dim))))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    groups = ["dim", "x", "y"]
    blocks = asked.mapInArrow(_pack(QUERY_BLOCK), _PACKED).select(
        "*", F.pmod(F.xxhash64("block"), F.lit(across)).cast("int").alias("x"),
        every(down).alias("y"))
    against = clean(candidates).mapInArrow(_pack(CANDIDATE_BLOCK), _PACKED).select(
        "*", F.pmod(F.xxhash64("ids"), F.lit(down)).cast("int").alias("y"),
        every(across).alias("x"))
    found = blocks.groupBy(*groups).cogroup(against.groupBy(*groups)).applyInArrow(
        _search(k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
