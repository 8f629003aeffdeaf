"""Quality classification by a factorisation machine.

Features of a text are its hashed words, statistics of its structure and the given
metadata, the last two as one of a few ranges each. The machine adds a weight per
feature and the inner product of the factors of every pair of features. With
s = sum of x v over the features, the pairs sum to (s^2 - sum of x^2 v^2) / 2, so a
text is scored in time linear in its features.

The machine is trained from a bounded sample of labelled rows; scoring reads every
whole text.

Defined results: a null text is an empty one and is scored like any other;
metadata columns that are missing or null are a range of their own; labels that
are null are not learned from, and repeated labels of a document are averaged;
without labels of both kinds every score is the share of good labels, or 0.5; very
long texts are read whole; an empty table gives no rows; rows that are equal have equal
scores; a kept column that has the name of the score is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx

BUCKETS = 1 << 14
FACTORS = 8
RANGES = 8
# Bound on the labelled rows that the machine is trained from.
SAMPLE = 4000
STATISTICS = ("characters", "word_length", "upper", "digits", "punctuation", "symbols",
              "distinct", "repeated", "line_words", "same_lines", "ending")
_TEXTS = 4096


def _kinds() -> dict[str, np.ndarray]:
    byte = np.arange(256)
    char = np.array([chr(b) for b in byte])
    is_in = lambda s: np.isin(char, list(s))
    return {"upper": (byte >= 65) & (byte <= 90), "digits": (byte >= 48) & (byte <= 57),
            "punctuation": is_in(".,;:!?'\"()"), "symbols": is_in("#$%&*+/<=>@[\\]^_`{|}~")}


KINDS = _kinds()


def _per_text(flags: np.ndarray, limits: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags)))
    return (total[limits[1:]] - total[limits[:-1]]).astype(np.float64)


def features(block: tx.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, bucket) pairs with their counts, and the statistics of each text."""
    found = tx.words(block)
    text = found.text_of()
    bucket = (found.code >> tx.U64(40)).astype(np.int64) % BUCKETS
    pair, count = np.unique(text * BUCKETS + bucket, return_counts=True)
    data, limits = block.data, block.limits
    size = np.maximum(np.diff(limits), 1)
    words = np.maximum(np.diff(found.limits), 1)
    share = lambda flags: _per_text(flags, limits) / size
    again = np.zeros(len(found.code), dtype=bool)
    again[1:] = (found.code[1:] == found.code[:-1]) & (text[1:] == text[:-1])
    # Lines are told apart by the codes of their bytes.
    line_end = np.flatnonzero(data == 10)
    owner = np.searchsorted(limits, line_end, side="right") - 1
    starts = np.concatenate((limits[:-1], line_end + 1))
    of = np.concatenate((np.arange(block.n), owner))
    order = np.lexsort((starts, of))
    starts, of = starts[order], of[order]
    ends = np.empty(len(starts), dtype=np.int64)
    last = np.ones(len(starts), dtype=bool)
    last[:-1] = of[1:] != of[:-1]
    ends[:-1] = starts[1:] - 1
    ends[last] = limits[of[last] + 1]
    line = tx.Rolling(tx.BYTE_CODE[data]).of(starts, ends)
    distinct_lines = np.bincount(
        np.unique(np.stack((of.astype(np.uint64), line)), axis=1)[0].astype(np.int64),
        minlength=block.n)
    lines = np.bincount(of, minlength=block.n)
    end = np.zeros(block.n)
    full = found.limits[1:] > found.limits[:-1]
    end[full] = data[found.end[found.limits[1:][full] - 1] - 1]
    stats = np.stack([
        np.log1p(np.diff(limits)), (found_bytes := _per_text(
            ~tx.IS_SEPARATOR[data], limits)) / words,
        *(share(KINDS[k][data]) for k in ("upper", "digits", "punctuation", "symbols")),
        np.bincount(pair // BUCKETS, minlength=block.n) / words,
        np.bincount(text[again], minlength=block.n) / words,
        np.log1p(np.diff(found.limits) / lines), 1 - distinct_lines / lines,
        np.where(found_bytes > 0, end / 256, 0)], axis=1)
    return pair // BUCKETS, pair % BUCKETS, count, stats


def _metadata(batch: pa.RecordBatch, names: list[str], first: int, n: int) -> np.ndarray:
    """Sizes of numbers as powers of two, -1 for null."""
    out = np.full((n, len(names)), -1.0)
    for j, name in enumerate(names):
        column = pc.cast(batch.column(name).slice(first, n), pa.float64())
        value = column.to_numpy(zero_copy_only=False)
        ok = np.isfinite(value)
        out[ok, j] = np.log1p(np.abs(value[ok]))
    return out


class Machine:
    """Weights, factors and the ranges that statistics and metadata fall into."""

    def __init__(self, edges: np.ndarray, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.edges, self.bias, self.weights, self.factors = edges, bias, weights, factors

    def rows(self, text, bucket, count, dense):
        """Features of all texts, text by text: text, feature, value."""
        n, k = dense.shape
        value = np.log1p(count.astype(np.float64))
        norm = np.sqrt(np.bincount(text, weights=value * value, minlength=n))
        value = value / norm[text]
        place = np.stack([np.searchsorted(self.edges[j], dense[:, j], side="right")
                          for j in range(k)], axis=1) + np.arange(k) * RANGES + BUCKETS
        return (np.concatenate((text, np.repeat(np.arange(n), k))),
                np.concatenate((bucket, place.ravel())),
                np.concatenate((value, np.full(n * k, 1 / np.sqrt(k)))))

    def score(self, text, bucket, count, dense) -> np.ndarray:
        n = len(dense)
        of, feature, x = self.rows(text, bucket, count, dense)
        raw = self.bias + np.bincount(of, weights=self.weights[feature] * x, minlength=n)
        for f in range(self.factors.shape[1]):
            part = self.factors[feature, f] * x
            total = np.bincount(of, weights=part, minlength=n)
            raw += 0.5 * (total * total - np.bincount(of, weights=part * part, minlength=n))
        return 1 / (1 + np.exp(-np.clip(raw, -40, 40)))


def fit(text, bucket, count, dense, label, rounds: int = 12, batch: int = 100,
        rate: float = 0.03, decay: float = 1e-5, seed: int = 7) -> Machine:
    """Logistic loss by Adam over small batches; the same sample gives the same machine."""
    n, k = dense.shape
    quantile = np.arange(1, RANGES) / RANGES
    edges = np.stack([np.quantile(dense[:, j], quantile) for j in range(k)]) if n else \
        np.zeros((k, RANGES - 1))
    good = float(np.clip(label.mean() if n else 0.5, 0.01, 0.99))
    size = BUCKETS + k * RANGES
    rng = np.random.default_rng(seed)
    machine = Machine(edges, float(np.log(good / (1 - good))), np.zeros(size),
                      np.zeros((size, FACTORS)))
    if n == 0 or label.min() == label.max():
        return machine
    machine.factors = rng.normal(0, 0.05, (size, FACTORS))
    of, feature, x = machine.rows(text, bucket, count, dense)
    order = np.argsort(of, kind="stable")
    of, feature, x = of[order], feature[order], x[order]
    limits = np.searchsorted(of, np.arange(n + 1))
    table = np.concatenate((machine.weights[:, None], machine.factors), axis=1)
    one, two, step = np.zeros_like(table), np.zeros_like(table), 0
    for _ in range(rounds):
        for chosen in np.array_split(rng.permutation(n), max(1, n // batch)):
            spans = [np.arange(limits[i], limits[i + 1]) for i in chosen]
            at = np.concatenate(spans)
            row = np.repeat(np.arange(len(chosen)), [len(s) for s in spans])
            f, v = feature[at], x[at][:, None]
            part = table[f, 1:] * v
            total = np.zeros((len(chosen), FACTORS))
            np.add.at(total, row, part)
            pairs = 0.5 * ((total ** 2).sum(1) - np.bincount(
                row, weights=(part ** 2).sum(1), minlength=len(chosen)))
            raw = machine.bias + np.bincount(row, weights=table[f, 0] * v[:, 0],
                                             minlength=len(chosen)) + pairs
            error = (1 / (1 + np.exp(-np.clip(raw, -40, 40))) - label[chosen]) / len(chosen)
            slope = np.concatenate((v, v * (total[row] - part)), axis=1) * error[row][:, None]
            used, back = np.unique(f, return_inverse=True)
            grad = np.zeros((len(used), 1 + FACTORS))
            np.add.at(grad, back, slope)
            grad += decay * table[used]
            step += 1
            one[used] = 0.9 * one[used] + 0.1 * grad
            two[used] = 0.99 * two[used] + 0.01 * grad ** 2
            fix = np.sqrt(1 - 0.99 ** step) / (1 - 0.9 ** step)
            table[used] -= rate * fix * one[used] / (np.sqrt(two[used]) + 1e-8)
            machine.bias -= rate * float(error.sum())
    machine.weights, machine.factors = table[:, 0].copy(), table[:, 1:].copy()
    return machine


def _extract(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tx.blocks(batch, "text", most=_TEXTS):
                text, bucket, count, stats = features(block)
                dense = np.concatenate(
                    (stats, _metadata(batch, names, block.first, block.n)), axis=1)
                limits = np.searchsorted(text, np.arange(block.n + 1))
                cut = lambda v, kind: pa.array(
                    [v[a:b].astype(kind).tobytes() for a, b in zip(limits[:-1], limits[1:])],
                    pa.binary())
                yield pa.RecordBatch.from_arrays([
                    batch.column("label").slice(block.first, block.n),
                    cut(bucket, np.int16), cut(count, np.int32),
                    pa.array([d.tobytes() for d in dense], pa.binary())],
                    names=["label", "bucket", "count", "dense"])

    return run


def _metadata_of(docs: DataFrame, metadata: tuple[str, ...]) -> list:
    """The metadata columns that are there, null for the others."""
    return [F.col(f"`{c}`").cast("double") if c in docs.columns
            else F.lit(None).cast("double") for c in metadata]


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          label: str = "quality", metadata: tuple[str, ...] = ("n_chars",),
          sample: int = SAMPLE) -> Machine:
    """A machine from the `sample` labelled documents whose keys have the smallest codes."""
    chosen = (labels.select(F.col(key).alias("key"), F.col(label).cast("double").alias("label"))
              .where("key is not null and label is not null")
              .groupBy("key").agg(F.avg("label").alias("label"))
              .orderBy(F.xxhash64("key"), "key").limit(sample))
    names = [f"meta{i}" for i in range(len(metadata))]
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), *(
        c.alias(n) for n, c in zip(names, _metadata_of(docs, metadata))))
    # Bounded by `sample` rows, so it can be sent to every task.
    got = (rows.join(F.broadcast(chosen), "key").select("label", "text", *names)
           .mapInArrow(_extract(names), "label double, bucket binary, count binary, dense binary")
           .collect())
    got.sort(key=lambda r: (r["label"], bytes(r["dense"]), bytes(r["bucket"])))
    bucket = [np.frombuffer(r["bucket"], np.int16).astype(np.int64) for r in got]
    k = len(STATISTICS) + len(metadata)
    dense = np.array([np.frombuffer(r["dense"]) for r in got]).reshape(len(got), k)
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return fit(np.repeat(np.arange(len(got)), [len(b) for b in bucket]), join(bucket),
               join([np.frombuffer(r["count"], np.int32) for r in got]), dense,
               np.array([float(r["label"] >= 0.5) for r in got]))


def _score(machine: Machine, names: list[str], kept: list[str], text: str, out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tx.blocks(batch, text, most=_TEXTS):
                owner, bucket, count, stats = features(block)
                dense = np.concatenate(
                    (stats, _metadata(batch, names, block.first, block.n)), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(block.first, block.n) for c in kept),
                     pa.array(machine.score(owner, bucket, count, dense))], names=[*kept, out])

    return run


def score(docs: DataFrame, machine: Machine, keep: list[str], text: str = "text",
          metadata: tuple[str, ...] = ("n_chars",), out: str = "score") -> DataFrame:
    """The columns `keep` of every row and its score in column `out`."""
    if out in keep:
        raise ValueError(f"the rows already have a column {out}; name another")
    # Longer than any kept name.
    longer = "_" * max(map(len, keep), default=0)
    names = [f"{longer}meta{i}" for i in range(len(metadata))]
    name, columns = tx.text_column(keep, text)
    rows = docs.select(*columns, *(c.alias(n) for n, c in zip(names, _metadata_of(docs, metadata))))
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(_score(machine, names, keep, name, out), f"{kinds}, `{out}` double")
