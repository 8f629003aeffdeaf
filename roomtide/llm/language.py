"""Language identification by nearest centroids of character n-grams.

A text is a vector of hashed n-grams of its lower-case letters, weighted by TF-IDF
and normalised. The frequencies count all training texts. Each language gets
several centroids, clustered from a bounded sample of its texts. The nearest
centroid by cosine names the language; a text farther from it than nearly all
training texts of that language are from theirs is marked rejected, with the
nearest language still given.

Defined results: a null text or one without a letter is `und` with score 0, and so
is every text if no row could be learned from; texts with equal cosines go to the
first language by name; rows without an id are not learned from; a row given twice is
learned from twice and gets its answer twice; very long texts are read whole; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import text as tx

DIMENSIONS = 4096
# Bound on the sample that centroids are clustered from, shared out over the languages.
SAMPLE = 2400
LEAST_SAMPLE = 8
CENTROIDS = 4
# Share of the sample that would be rejected, and how much farther still is accepted.
REJECT_SHARE = 0.005
REJECT_SLACK = 0.8
_TEXTS = 512


def vectors(block: tx.Block) -> np.ndarray:
    """Counts of the hashed 1-, 2- and 3-grams of each text of a block."""
    chars = tx.characters(block)
    low = tx.letters(chars.points)
    text = np.repeat(np.arange(block.n), np.diff(chars.limits))
    # One gap stands for everything between two words.
    keep = low > 0
    gap = np.zeros(len(low), dtype=bool)
    gap[1:] = (low[1:] == 0) & (low[:-1] > 0)
    keep |= gap
    low, text = low[keep].astype(np.uint32), text[keep].astype(np.int64)
    total = np.zeros(block.n * DIMENSIONS, dtype=np.int64)
    code = low * np.uint32(0x9E3779B1)
    for n in (1, 2, 3):
        if n > 1:
            code = (code[:-1] ^ (code[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) \
                + low[n - 1:] * np.uint32(0xC2B2AE3D)
        same = text[:len(code)] == text[n - 1:]
        if n == 1:
            same &= low > 0
        if n == 3:
            # A gap in the middle joins two words and says little.
            same &= low[1:-1] > 0
        mixed = code ^ (code >> np.uint32(16))
        place = text[:len(code)][same] * DIMENSIONS + (
            (mixed[same] * np.uint32(0x27D4EB2F)) >> np.uint32(20))
        total += np.bincount(place, minlength=len(total))
    return total.reshape(block.n, DIMENSIONS)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, n = np.zeros(DIMENSIONS, dtype=np.int64), 0
    for batch in batches:
        for block in tx.blocks(batch, "text", most=_TEXTS):
            seen += (vectors(block) > 0).sum(axis=0)
            n += block.n
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(-1, DIMENSIONS, dtype=np.int32)),
         pa.array(np.concatenate(([n], seen)))], names=["feature", "n"])


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in tx.blocks(batch, "text", most=_TEXTS):
            rows = vectors(block)
            places = [np.flatnonzero(r).astype(np.int16) for r in rows]
            yield pa.RecordBatch.from_arrays([
                batch.column("lang").slice(block.first, block.n),
                pa.array([p.tobytes() for p in places], pa.binary()),
                pa.array([np.minimum(r[p], 1 << 30).astype(np.int32).tobytes()
                          for r, p in zip(rows, places)], pa.binary())],
                names=["lang", "places", "counts"])


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    rows = np.log1p(counts.astype(np.float32)) * idf
    norm = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(norm > 0, norm, 1)


def cluster(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Up to k centroids of unit rows by cosine, started from rows far apart."""
    chosen = [int(np.argmax(rows @ rows.mean(axis=0)))]
    while len(chosen) < min(k, len(rows)):
        near = (rows @ rows[chosen].T).max(axis=1)
        if near.min() > 0.999:
            break
        chosen.append(int(np.argmin(near)))
    centres = rows[chosen].copy()
    for _ in range(rounds):
        own = (rows @ centres.T).argmax(axis=1)
        for c in range(len(centres)):
            if (own == c).any():
                mean = rows[own == c].mean(axis=0)
                centres[c] = mean / max(np.linalg.norm(mean), 1e-12)
    return centres


class Model:
    """Languages, their centroids, the weights of n-grams and the reach of a language."""

    def __init__(self, names, centres, of, idf, reach):
        self.names, self.centres, self.of, self.idf, self.reach = names, centres, of, idf, reach


def train(rows: DataFrame, lang: str = "lang", text: str = "text", key: str = "doc_id") -> Model:
    """A model of all rows given; every text counts, a bounded sample is clustered."""
    rows = rows.select(F.col(key).alias("key"), F.col(lang).cast("string").alias("lang"),
                       F.col(text).alias("text")).where("lang is not null and key is not null")
    counts = {r["feature"]: r["n"] for r in rows.select("text").mapInArrow(
        _count, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()}
    total = counts.pop(-1, 0)
    df = np.array([counts.get(i, 0) for i in range(DIMENSIONS)], dtype=np.float64)
    idf = (np.log((1 + total) / (1 + df)) + 0.1).astype(np.float32)

    # The rows of smallest code are the sample. Codes are spread evenly, so a share of them,
    # known from the counts, leaves each language a few times its sample to sort.
    coded = rows.withColumn("code", F.xxhash64("key"))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    each = max(LEAST_SAMPLE, SAMPLE // max(1, sizes.count()))
    share = sizes.select("lang", F.least(F.lit(1.0), F.lit(4.0 * each) / F.col("n")).alias("share"))
    first = Window.partitionBy("lang").orderBy("code")
    limits = (coded.select("lang", "code").join(share, "lang")
              .where(F.pmod("code", F.lit(1 << 20)) < F.col("share") * (1 << 20))
              .withColumn("r", F.row_number().over(first)).where(F.col("r") <= each)
              .groupBy("lang").agg(F.max("code").alias("limit"), F.first("share").alias("share")))
    sample = (coded.join(F.broadcast(limits), "lang").where("code <= limit")
              .where(F.pmod("code", F.lit(1 << 20)) < F.col("share") * (1 << 20))
              .select("lang", "text").mapInArrow(_sparse, "lang string, places binary, counts binary")
              .collect())
    by: dict[str, list[np.ndarray]] = {}
    for r in sorted(sample, key=lambda r: (r["lang"], bytes(r["places"]), bytes(r["counts"]))):
        row = np.zeros(DIMENSIONS, dtype=np.int32)
        row[np.frombuffer(r["places"], np.int16)] = np.frombuffer(r["counts"], np.int32)
        if row.any():
            by.setdefault(r["lang"], []).append(row)
    names, centres, of, reach = sorted(by), [], [], []
    for i, name in enumerate(names):
        unit = weighted(np.stack(by[name]), idf)
        own = cluster(unit, CENTROIDS)
        near = (unit @ own.T).max(axis=1)
        centres.append(own)
        of += [i] * len(own)
        reach.append(REJECT_SLACK * float(np.quantile(near, REJECT_SHARE)))
    return Model(names, np.concatenate(centres) if centres else np.zeros((0, DIMENSIONS)),
                 np.array(of, dtype=np.int64), idf, np.array(reach))


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tx.blocks(batch, "text", most=_TEXTS):
                counts = vectors(block)
                some = counts.any(axis=1) & bool(model.names)
                names = np.full(block.n, "und", dtype=object)
                score, rejected = np.zeros(block.n), np.zeros(block.n, dtype=bool)
                if some.any():
                    near = weighted(counts[some], model.idf) @ model.centres.T
                    best = near.argmax(axis=1)
                    lang = model.of[best]
                    names[some] = np.array(model.names, dtype=object)[lang]
                    score[some] = np.clip(near[np.arange(len(best)), best], 0, 1)
                    rejected[some] = score[some] < model.reach[lang]
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).slice(block.first, block.n)
                      for c in batch.schema.names if c != "text"),
                    pa.array(names, pa.string()), pa.array(score), pa.array(rejected)],
                    names=[c for c in batch.schema.names if c != "text"]
                    + ["lang_pred", "score", "rejected"])

    return run


def predict(docs: DataFrame, model: Model, held_out: Column, key: str = "doc_id",
            text: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every row."""
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("doc_id"), held_out.alias("held_out"),
                       F.col(text).alias("text")).mapInArrow(
        _predict(model), f"doc_id {kind}, held_out boolean, lang_pred string, score double, "
                         "rejected boolean")
