"""Substring deduplication by seed and extend.

Seeds are winnowed: of the runs of ANCHOR words inside a window, the one with the
smallest code is the window's anchor. Equal windows have equal anchors at equal
places, so a window can only repeat where its anchor does. Each anchor owns the
windows it was chosen for, one after the other; together with the words around
them they are its extension to the left and to the right.

Occurrences of a repeated anchor are never paired. Those whose whole extensions
are equal are counted as one class; only the classes that share an anchor with
another class are compared window by window, each class once. Windows, like
extensions, are told apart by codes of 64 bits beside their anchor and its place.

Defined results: a null or empty text has no words and nothing removed; a text
shorter than a window is kept; the same row given twice repeats all its windows;
rows with a null doc_id are treated like others; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise, scratch
from . import text as tx

WINDOW = 35
ANCHOR = 12

_RUN = "row_key long, anchor long, first int, lead int, extent long, windows array<long>"


def _leftmost_minimum(codes: np.ndarray, width: int) -> np.ndarray:
    """For every start, the place of the leftmost smallest code among the next `width`."""
    at = np.arange(len(codes))
    have = 1
    while have < width:
        step = min(have, width - have)
        left, right = at[:-step], at[step:]
        at = np.where(codes[right] < codes[left], right, left)
        have += step
    return at


def _runs(block: tx.Block, window: int, anchor: int):
    """Text, anchor code, first window, windows before the anchor, count of windows
    and code of all words of every run of windows that share an anchor; window codes."""
    found = tx.words(block)
    size = np.diff(found.limits)
    if not (size >= window).any():
        return None
    codes, _ = tx.grams(found, anchor, 0)
    # One code per word position; positions too near the end of a text never start a window.
    whole = tx.Rolling(found.code, 1)
    per_word = np.zeros(len(found.code), dtype=tx.U64)
    count = np.maximum(size - anchor + 1, 0)
    places = np.arange(count.sum()) + np.repeat(
        found.limits[:-1] - np.concatenate(([0], np.cumsum(count)))[:-1], count)
    per_word[places] = codes
    chosen = _leftmost_minimum(per_word, window - anchor + 1)
    n_windows = np.maximum(size - window + 1, 0)
    at = np.arange(n_windows.sum()) + np.repeat(
        found.limits[:-1] - np.concatenate(([0], np.cumsum(n_windows)))[:-1], n_windows)
    text = np.repeat(np.arange(len(size)), n_windows)
    seed = chosen[at]
    begins = np.flatnonzero(np.concatenate(([True], (seed[1:] != seed[:-1])
                                            | (text[1:] != text[:-1]))))
    length = np.diff(np.concatenate((begins, [len(seed)])))
    first = at[begins]
    return {
        "text": text[begins], "anchor": per_word[seed[begins]],
        "first": first - found.limits[:-1][text[begins]],
        "lead": seed[begins] - first, "length": length,
        "extent": whole.of(first, first + length + window - 1),
        "windows": whole.of(at, at + window).view(np.int64),
    }


def _find_runs(window: int, anchor: int, full: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("row_key").to_numpy(zero_copy_only=False)
            for block in tx.blocks(batch, "text"):
                got = _runs(block, window, anchor)
                if got is None:
                    continue
                codes = got["anchor"].view(np.int64)
                if not full:
                    # Counting needs each anchor of a block once, with its count.
                    seen, n = np.unique(codes, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(n)],
                                                     names=["anchor", "n"])
                    continue
                ends = np.concatenate(([0], np.cumsum(got["length"]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys[block.first + got["text"]]), pa.array(codes),
                    pa.array(got["first"].astype(np.int32)),
                    pa.array(got["lead"].astype(np.int32)),
                    pa.array(got["extent"].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(got["windows"])),
                ], names=["row_key", "anchor", "first", "lead", "extent", "windows"])

    return run


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows with equal key and text share a row_key, and rightly: their spans are equal."""
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"),
                       F.xxhash64(F.col(key), F.col(text)).alias("row_key"))


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text",
                   window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """row_key and spans: word ranges [start, end) covered by windows that start twice."""
    with scratch(docs.sparkSession):
        return materialise(_spans(_keyed(docs, key, text).select("row_key", "text"), window,
                                  anchor), "spans", outlive=True)


def _spans(keyed: DataFrame, window: int, anchor: int) -> DataFrame:
    # Written, so that the join reads both sides from an exchange: only then can Spark
    # split the occurrences of a frequent anchor.
    repeated = materialise(
        keyed.mapInArrow(_find_runs(window, anchor, False), "anchor long, n long")
        .groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor"), "repeated")
    # Written once: three later steps read it, and a lost executor need not repeat the scan.
    runs = materialise(keyed.mapInArrow(_find_runs(window, anchor, True), _RUN)
                       .join(repeated, "anchor", "left_semi"), "runs")
    # The extension of an occurrence is known by its anchor, the place of it and the code.
    same = ["anchor", "lead", "extent"]
    classes = materialise(runs.groupBy(same).agg(
        F.count("*").alias("n"), F.first("windows").alias("windows"),
        F.min(F.struct("row_key", "first")).alias("one")), "classes")
    shared = runs.select(*same, "row_key", "first", F.size("windows").alias("size")).join(
        classes.where("n > 1").select(*same), same, "left_semi")
    whole = shared.select("row_key", F.col("first").alias("start"),
                          (F.col("first") + F.col("size") + (window - 1)).alias("end"))

    contested = materialise(classes.groupBy("anchor").agg(F.count("*").alias("kinds"))
                            .where("kinds > 1").select("anchor"), "contested")
    each = (classes.join(contested, "anchor", "left_semi")
            .select("anchor", "lead", "n", "one", F.posexplode("windows").alias("j", "code"))
            .select("anchor", (F.col("lead") - F.col("j")).alias("place"), "code", "n",
                    (F.col("one.first") + F.col("j")).alias("start"),
                    F.col("one.row_key").alias("row_key")))
    window_of = ["anchor", "place", "code"]
    twice = each.groupBy(window_of).agg(F.sum("n").alias("n")).where("n > 1").select(*window_of)
    single = each.where("n = 1").join(twice, window_of, "left_semi").select(
        "row_key", "start", (F.col("start") + window).alias("end"))
    return (whole.unionByName(single).groupBy("row_key")
            .agg(F.collect_set(F.struct("start", "end")).alias("spans")))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        for text, spans in zip(batch.column("text"), batch.column("spans")):
            found = (text.as_py() or "").encode("utf-8", "replace").split()
            gone = 0
            if spans.is_valid:
                step = np.zeros(len(found) + 1, dtype=np.int64)
                at = spans.values
                np.add.at(step, at.field("start").to_numpy(), 1)
                np.add.at(step, at.field("end").to_numpy(), -1)
                covered = np.cumsum(step[:-1]) > 0
                gone = int(covered.sum())
                rest = [found[i] for i in np.flatnonzero(~covered)]
            else:
                rest = found
            n_words.append(len(found))
            n_removed.append(gone)
            kept.append(b" ".join(rest).decode("utf-8"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_words, pa.int64()),
             pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text",
                   window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words of every row, joined by one space."""
    spans = repeated_spans(docs, key, text, window, anchor)
    kind = docs.schema[key].dataType.simpleString()
    return (_keyed(docs, key, text).join(spans, "row_key", "left")
            .select("doc_id", "text", "spans")
            .mapInArrow(_cut, f"doc_id {kind}, n_words long, n_removed long, kept string"))
