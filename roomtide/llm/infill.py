"""Fill-in-the-middle: cut texts into prefix, middle and suffix and put the middle last.

A text is cut before one of its tokens or at its end; a token is a word with the white
space before it, or white space at the end. Where the cuts lie is drawn from a hash of
the row's key, as a rank among the token boundaries. A learned rank index turns ranks
into offsets: segments of a line are fitted to all boundary offsets of a text, split
until no boundary is further than BOUND characters from its line, and the distance of
each is stored in one byte. A cut is predicted by its segment and corrected by its
residual, which is exact. The index of a text takes a byte a token and 24 bytes a
segment, instead of 8 bytes a token.

Forms: `psm` is <P>prefix<S>suffix<M>middle, `spm` is <S>suffix<P>prefix<M>middle,
`plain` the text as it is. A text that is empty or holds one of the marks stays plain,
so a mark in an output of another form is always one that was set here, and `restore`
gets the text back exactly.

Rows are worked on one by one in blocks of arrays; nothing is shuffled.

Defined results: a null text is an empty one; a null key is the empty string in the hash;
rows with equal key and text come out alike; very long texts are cut like others, in one
block each; an empty table gives no rows; other columns are kept, and one that has the
name of a result is an error unless a prefix is given.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as tx

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
SEED = 42
# Of 100 texts, how many are cut; of 100 of these, how many are written suffix first.
RATE = 50
SUFFIX_FIRST = 80
# How far a boundary may lie from its line; residuals are bytes.
BOUND = 127


@dataclass
class RankIndex:
    """Boundary offsets of texts as lines with residuals. Ranks count through all texts."""

    first: np.ndarray
    origin: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    def offsets(self, rank: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.first, rank, side="right") - 1
        return _line(self.origin[at], self.slope[at], rank - self.first[at]) + self.residual[rank]


def _line(origin: np.ndarray, slope: np.ndarray, steps: np.ndarray) -> np.ndarray:
    return origin + np.rint(slope * steps).astype(np.int64)


def fit(offsets: np.ndarray, limits: np.ndarray, bound: int = BOUND) -> RankIndex:
    """An index of the offsets limits[i]..limits[i+1] of every text i, each at least one.

    A segment is the line from its first to its last boundary. Those with a boundary
    further off than the bound are halved; two boundaries are always on their line.
    """
    residual = np.zeros(len(offsets), dtype=np.int8)
    first, last = limits[:-1].astype(np.int64), limits[1:].astype(np.int64) - 1
    done = []
    while len(first):
        size = last - first + 1
        slope = (offsets[last] - offsets[first]) / np.maximum(last - first, 1)
        begin = np.concatenate(([0], np.cumsum(size)[:-1]))
        steps = np.arange(size.sum()) - np.repeat(begin, size)
        rank = steps + np.repeat(first, size)
        off = offsets[rank] - _line(np.repeat(offsets[first], size), np.repeat(slope, size), steps)
        good = np.maximum.reduceat(np.abs(off), begin) <= bound
        fits = np.repeat(good, size)
        residual[rank[fits]] = off[fits]
        done.append((first[good], offsets[first[good]], slope[good]))
        low, high = first[~good], last[~good]
        half = (low + high) // 2
        first, last = np.concatenate((low, half + 1)), np.concatenate((half, high))
    starts, origin, slope = (np.concatenate(c) for c in zip(*done)) if done else \
        (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    order = np.argsort(starts, kind="stable")
    return RankIndex(starts[order], origin[order], slope[order], residual)


def boundaries(block: tx.Block) -> tuple[np.ndarray, np.ndarray]:
    """Offsets in code points at which the tokens of each text begin, and its end; and the
    limits of each text's offsets. An empty text has its end only."""
    data, limits = block.data, block.limits
    apart = tx.IS_SEPARATOR[data]
    begins = np.zeros(data.size + 1, dtype=bool)
    begins[1:-1] = apart[1:] & ~apart[:-1]
    begins[limits] = False
    begins[limits[:-1][np.diff(limits) > 0]] = True
    at = np.flatnonzero(begins[:-1])
    count = np.diff(np.searchsorted(at, limits)) + 1
    ends = np.cumsum(count)
    flat = np.empty(ends[-1], dtype=np.int64)
    is_end = np.zeros(ends[-1], dtype=bool)
    is_end[ends - 1] = True
    flat[~is_end], flat[is_end] = at, limits[1:]
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    own = np.concatenate(([0], ends))
    return points[flat] - np.repeat(points[limits[:-1]], count), own


def draws(key: str, seed: int = SEED) -> tuple[int, int, int, int]:
    code = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return tuple(int(code[i:i + 8], 16) for i in (0, 8, 16, 24))


def _arrange(form: str, text: str, a: int, b: int) -> str:
    if form == "psm":
        return f"{PREFIX}{text[:a]}{SUFFIX}{text[b:]}{MIDDLE}{text[a:b]}"
    if form == "spm":
        return f"{SUFFIX}{text[b:]}{PREFIX}{text[:a]}{MIDDLE}{text[a:b]}"
    return text


def _cut(kept: list[str], key: str, text: str, seed: int, rate: int, suffix_first: int,
         prefix: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tx.blocks(batch, text):
                part = batch.slice(block.first, block.n)
                texts = [t or "" for t in part.column(text).to_pylist()]
                drawn = [draws("" if k is None else str(k), seed)
                         for k in part.column(key).to_pylist()]
                offsets, own = boundaries(block)
                index = fit(offsets, own)
                n = np.diff(own) - 1
                ranks = np.array([[d[0], d[1]] for d in drawn], dtype=np.int64) % (n + 1)[:, None]
                cuts = index.offsets(np.sort(ranks, axis=1) + own[:-1, None]).tolist()
                forms = ["plain" if not t or d[2] % 100 >= rate or any(m in t for m in MARKS)
                         else "spm" if d[3] % 100 < suffix_first else "psm"
                         for t, d in zip(texts, drawn)]
                chars = [[None if f == "plain" else size for f, size in zip(forms, sizes)]
                         for sizes in ([a for a, _ in cuts], [b - a for a, b in cuts])]
                yield pa.RecordBatch.from_arrays([
                    *(part.column(c) for c in kept), pa.array(n, pa.int64()),
                    pa.array(forms, pa.string()), *(pa.array(c, pa.int64()) for c in chars),
                    pa.array([_arrange(f, t, a, b) for f, t, (a, b) in zip(forms, texts, cuts)],
                             pa.string())], names=[*kept, *(prefix + c for c in MADE)])

    return run


MADE = ("n", "form", "prefix_chars", "middle_chars", "output")


def transform(docs: DataFrame, keep: list[str], key: str = "doc_id", text: str = "text",
              seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST,
              prefix: str = "") -> DataFrame:
    """The columns `keep` with the tokens `n`, the `form`, the code points of prefix and
    middle (null where plain) and the `output`; `prefix` goes before these names."""
    if {prefix + c for c in MADE} & set(keep):
        raise ValueError("the rows already have columns of these names; give a prefix")
    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    kinds += [f"`{prefix}{c}` {'string' if c in ('form', 'output') else 'long'}" for c in MADE]
    # Key and text travel beside the kept columns, under names longer than any of theirs.
    longer = "_" * max(map(len, keep), default=0)
    columns = [*(F.col(f"`{c}`") for c in keep), F.col(f"`{key}`").alias(longer + "key"),
               F.col(f"`{text}`").alias(longer + "text")]
    run = _cut(keep, longer + "key", longer + "text", seed, rate, suffix_first, prefix)
    return docs.select(*columns).mapInArrow(run, ", ".join(kinds))


def restore(output: Column, form: Column) -> Column:
    """The exact text of an output."""
    parts = F.split(output, "<[PSM]>")
    a, b, c = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return (F.when(form == "psm", F.concat(a, c, b)).when(form == "spm", F.concat(b, c, a))
            .otherwise(output))
