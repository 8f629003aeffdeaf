"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts and benchmark items are compared as the lower-case letters and digits they
hold, so spacing, case and punctuation do not hide a copy. An item of m characters
found in a text with at most k edits shares at least m - q + 1 - k q of its q-grams
with it, all on diagonals at most k apart. For every text and item the shared
q-grams are counted in overlapping bands of diagonals, each 2 k + 1 wide and more,
and a band that reaches the bound is aligned within the band. A hit is an item
whose edit distance to a stretch of the text is within its budget.

A benchmark of up to ITEM_CHARS characters, which are counted first, is sent to every
task. A larger one is never gathered: its q-grams are a table, and so are those of the
texts that a bitmap of bounded size lets through; both are joined by their codes through
a shuffle, counted per text, item and band, and only bands that reach the bound meet
the texts and the items again, to be aligned. Both ways give the same rows.

Defined results: null or empty texts have no hits; items without any letter or
digit are never found; an item given twice is one; of an item that stands in a text more than once every stretch is a
hit, of overlapping ones the one of fewest edits; items shorter than q are compared by grams of their own
length and without edits, also inside words, so chance may find them: a caller who
drops texts asks for items of `least` characters; items with equal texts are all
reported; an item without an id is reported as -1; a row given twice has its hits twice; very long
texts are searched whole; an empty table gives no rows, an empty benchmark no hits; other
columns are kept, and one that has the name of the result is an error.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise, scratch
from . import text as tx

Q = 12
# Edits allowed for each character of an item.
EDITS = 0.06
# Characters of items that are sent to tasks at most.
ITEM_CHARS = 2_000_000
# Bits that tell which q-grams a larger benchmark may have: 32 MB.
FILTER_BITS = 1 << 28

_digit_or_letter: dict[str, np.ndarray] = {}


def folded(points: np.ndarray) -> np.ndarray:
    """Lower-case letters and ASCII digits, 0 for everything else."""
    low = tx.letters(points)
    return np.where((points >= 48) & (points <= 57), points, low)


def budget(m: int, q: int = Q, rate: float = EDITS) -> int:
    """Edits allowed for an item of m characters; the lemma then asks for a q-gram at least."""
    return max(0, min(int(rate * m), (m - q) // q)) if m >= q else 0


class Items:
    """The items of one part with an index of their grams."""

    def __init__(self, ids: list, texts: list[str], q: int, rate: float, least: int = 1):
        self.ids, self.points, self.edits, self.need, self.q = [], [], [], [], []
        for name, text in zip(ids, texts):
            points = np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)
            points = folded(points)
            points = points[points > 0]
            if len(points) < max(least, 1):
                continue
            m = len(points)
            own = min(q, m)
            k = budget(m, q, rate)
            self.ids.append(name)
            self.points.append(points)
            self.edits.append(k)
            self.need.append(m - own + 1 - k * own)
            self.q.append(own)
        self.index = {}
        for own in sorted(set(self.q)):
            which = [i for i, s in enumerate(self.q) if s == own]
            codes = [_grams(self.points[i], own) for i in which]
            item = np.repeat(which, [len(c) for c in codes])
            place = np.concatenate([np.arange(len(c)) for c in codes])
            code = np.concatenate(codes)
            order = np.argsort(code, kind="stable")
            code, item, place = code[order], item[order], place[order]
            known, first, count = np.unique(code, return_index=True, return_counts=True)
            # A small table of gram bits settles most positions with one look.
            bits = np.zeros(1 << 20, dtype=bool)
            bits[(known >> tx.U64(44)).astype(np.int64)] = True
            self.index[own] = (known, first, count, item, place, bits)


def _grams(points: np.ndarray, q: int) -> np.ndarray:
    if len(points) < q:
        return np.zeros(0, dtype=tx.U64)
    at = np.arange(len(points) - q + 1)
    return tx.Rolling(tx.mix(points.astype(tx.U64))).of(at, at + q)


def banded(item: np.ndarray, text: np.ndarray, low: int, high: int, k: int):
    """Least edits of the item against any stretch of the text that the diagonals
    low..high cover, and that stretch, or None beyond k edits."""
    m, width = len(item), high - low + 1
    far = k + 1
    diagonal = np.arange(low, high + 1)
    # Cell (i, j) of the alignment is kept at j - i; a row starts anywhere for free.
    cost = np.where((diagonal >= 0) & (diagonal <= len(text)), 0, far)
    start = diagonal.copy()
    for i in range(1, m + 1):
        j = diagonal + i
        ok = (j >= 1) & (j <= len(text))
        same = np.zeros(width, dtype=bool)
        same[ok] = text[j[ok] - 1] == item[i - 1]
        swap = np.where(ok, cost + ~same, far)
        drop, came = np.full(width, far), np.zeros(width, dtype=np.int64)
        drop[:-1], came[:-1] = cost[1:] + 1, start[1:]
        best = np.minimum(swap, drop)
        begin = np.where(swap <= drop, start, came)
        best = np.where((j < 0) | (j > len(text)), far, best)
        # Characters of the text left over: running minimum along the row.
        lifted = best - np.arange(width)
        least = np.minimum.accumulate(lifted)
        better = least < lifted
        if better.any():
            held = np.maximum.accumulate(np.where(~better, np.arange(width), 0))
            best, begin = least + np.arange(width), begin[held]
        cost, start = np.minimum(best, far), begin
        if cost.min() > k:
            return None
    at = int(cost.argmin())
    return int(cost[at]), int(start[at]), int(diagonal[at] + m)


def hits(items: Items, points: np.ndarray, limits: np.ndarray):
    """(text, item, start, end, edits) of the best match of each item found in each text."""
    low = folded(points)
    keep = np.flatnonzero(low)
    owner = np.searchsorted(limits, keep, side="right") - 1
    seq = low[keep]
    begin = np.searchsorted(owner, np.arange(len(limits)))
    found = []
    for q, (known, first, count, item, place, bits) in items.index.items():
        if len(seq) < q:
            continue
        code = _grams(seq, q)
        maybe = np.flatnonzero(bits[(code >> tx.U64(44)).astype(np.int64)]
                               & (owner[:len(code)] == owner[q - 1:]))
        spot = np.searchsorted(known, code[maybe])
        real = (spot < len(known))
        real[real] = known[spot[real]] == code[maybe[real]]
        at, spot = maybe[real], spot[real]
        if not len(at):
            continue
        n = count[spot]
        rows = np.repeat(first[spot] - np.concatenate(([0], np.cumsum(n)))[:-1], n) \
            + np.arange(n.sum())
        who, where = item[rows], np.repeat(at, n)
        text = owner[where]
        diagonal = where - begin[text] - place[rows]
        found.append(np.stack((text, who, diagonal)))
    if not found:
        return []
    text, who, diagonal = np.concatenate(found, axis=1)
    k = np.array(items.edits)[who]
    need = np.array(items.need)[who]
    # Bands of 4 k + 2 diagonals that overlap by half: every run of 2 k + 1 is in one.
    band = np.floor_divide(diagonal, 2 * k + 1)
    out: dict[tuple[int, int], list] = {}
    cells = np.concatenate((np.stack((text, who, band)), np.stack((text, who, band - 1))), axis=1)
    cells, n = np.unique(cells, axis=1, return_counts=True)
    for t, w, b in cells[:, n >= np.array(items.need)[cells[1]]].T.tolist():
        piece = seq[begin[t]:begin[t + 1]]
        got = in_band(items.points[w], piece, b, items.edits[w])
        if got:
            edits, s, e = got
            a = int(keep[begin[t] + s] - limits[t])
            z = int(keep[begin[t] + e - 1] - limits[t]) + 1 if e > s else a
            out.setdefault((t, w), []).append((edits, a, z))
    return [(t, items.ids[w], a, z, edits) for (t, w), every in sorted(out.items())
            for edits, a, z in apart(every)]


def in_band(item: np.ndarray, piece: np.ndarray, band: int, k: int):
    """The best match within a band of 4 k + 2 diagonals; it may begin and end up to k
    diagonals away from its grams."""
    return banded(item, piece, band * (2 * k + 1) - k, (band + 2) * (2 * k + 1) - 1 + k, k)


def apart(every: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of (edits, start, end) that overlap those of fewest edits, by place."""
    taken: list[tuple[int, int]] = []
    kept = []
    for edits, a, z in sorted(set(every)):
        at = bisect.bisect_left(taken, (a, z))
        if (at and taken[at - 1][1] > a) or (at < len(taken) and taken[at][0] < z):
            continue
        taken.insert(at, (a, z))
        kept.append((edits, a, z))
    return sorted(kept, key=lambda h: h[1])


def _search(part: tuple[list, list], kept: list[str], text: str, out: str, q: int, rate: float,
            least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(*part, q, rate, least)
        for batch in batches:
            for block in tx.blocks(batch, text):
                chars = tx.characters(block)
                lists = [[] for _ in range(block.n)]
                for t, name, a, z, edits in hits(items, chars.points, chars.limits):
                    lists[t].append({"item_id": name, "start": a, "end": z, "edits": edits})
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(block.first, block.n) for c in kept),
                     pa.array(lists, pa.list_(pa.struct([
                         ("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
                         ("edits", pa.int64())])))], names=[*kept, out])

    return run


def _part(items: DataFrame) -> tuple[list, list]:
    got = sorted((r["item_id"], r["item_text"]) for r in items.collect())
    return [g[0] for g in got], [g[1] for g in got]


# --- large benchmarks --------------------------------------------------------------------
_GRAM = "item long, q int, code long, place int, k int, need int"


def _item_grams(q: int, rate: float, least: int):
    """The q-grams of every item, with its edits and the bound on shared ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(batch.column("item").to_pylist(),
                                  batch.column("item_text").to_pylist()):
                items = Items([name], [text], q, rate, least)
                for points, k, need, own in zip(items.points, items.edits, items.need, items.q):
                    codes = _grams(points, own)
                    n = len(codes)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(n, name)), pa.array(np.full(n, own, np.int32)),
                        pa.array(codes.view(np.int64)), pa.array(np.arange(n, dtype=np.int32)),
                        pa.array(np.full(n, k, np.int32)), pa.array(np.full(n, need, np.int32))],
                        names=["item", "q", "code", "place", "k", "need"])

    return run


def _bit(code: Column, bits: int) -> Column:
    """The bit of a code in the filter: its upper bits, so that numpy finds it alike."""
    return F.shiftrightunsigned(code, 64 - bits.bit_length() + 1)


def _filter(grams: DataFrame, bits: int) -> np.ndarray:
    """Which bits the codes of the q-grams set; at most `bits` of them, whatever their number."""
    size = 32768
    at = _bit(F.col("code"), bits)
    rows = grams.select(at.alias("at")).groupBy(F.floor(F.col("at") / size).alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("at") % size).alias("bits")).collect()
    out = np.zeros(max(bits, size) // 8, dtype=np.uint8)
    for r in rows:
        at = int(r["bucket"]) * size // 8
        out[at:at + size // 8] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def _text_grams(sizes: list[int], known, bits: int):
    """The q-grams of every text that the filter lets through."""
    shift = tx.U64(64 - bits.bit_length() + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = known.value
        for batch in batches:
            names = batch.column("name").to_numpy(zero_copy_only=False)
            for block in tx.blocks(batch, "text"):
                chars = tx.characters(block)
                low = folded(chars.points)
                keep = np.flatnonzero(low)
                owner = np.searchsorted(chars.limits, keep, side="right") - 1
                begin = np.searchsorted(owner, np.arange(block.n + 1))
                for q in sizes:
                    codes = _grams(low[keep], q)
                    at = (codes >> shift).astype(np.int64)
                    ok = (sets[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
                    ok &= owner[:len(codes)] == owner[q - 1:] if len(codes) else ok
                    where = np.flatnonzero(ok)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(names[block.first + owner[where]], pa.string()),
                        pa.array(np.full(len(where), q, np.int32)),
                        pa.array(codes[where].view(np.int64)),
                        pa.array((where - begin[owner[where]]).astype(np.int64))],
                        names=["name", "q", "code", "at"])

    return run


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hits of every text, from its candidate bands and their items."""
    for batch in batches:
        out = []
        for block in tx.blocks(batch, "text"):
            chars = tx.characters(block)
            for i in range(block.n):
                points = folded(chars.points[chars.limits[i]:chars.limits[i + 1]])
                keep = np.flatnonzero(points)
                piece, by = points[keep], {}
                for c in batch.column("bands")[block.first + i].as_py():
                    item = folded(np.frombuffer(c["item_text"].encode("utf-32-le", "replace"),
                                                np.uint32))
                    got = in_band(item[item > 0], piece, c["band"], c["k"])
                    if got:
                        edits, s, e = got
                        a = int(keep[s]) if s < len(keep) else len(points)
                        by.setdefault((c["item_id"], c["item"]), []).append(
                            (edits, a, int(keep[e - 1]) + 1 if e > s else a))
                out.append([{"item_id": name, "start": a, "end": z, "edits": edits}
                            for (name, _), every in sorted(by.items())
                            for edits, a, z in apart(every)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("name"), pa.array(out, pa.list_(pa.struct([
                ("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
                ("edits", pa.int64())])))], names=["name", "found"])


def _found_by_shuffle(texts: DataFrame, items: DataFrame, q: int, rate: float, least: int,
                      bits: int = FILTER_BITS) -> DataFrame:
    """name and found of the texts (name, text) in which items (item, item_id, item_text) are."""
    spark = texts.sparkSession
    with scratch(spark):
        grams = materialise(items.select("item", "item_text").mapInArrow(
            _item_grams(q, rate, least), _GRAM), "item_grams")
        # Sizes of grams: q, and those of the items that are shorter.
        sizes = sorted(r["q"] for r in grams.select("q").distinct().collect())
        known = spark.sparkContext.broadcast(_filter(grams, bits))
        shared = texts.mapInArrow(_text_grams(sizes, known, bits),
                                  "name string, q int, code long, at long").join(
            grams.hint("merge"), ["q", "code"])
        band = F.floor((F.col("at") - F.col("place")) / (2 * F.col("k") + 1))
        bands = materialise(
            shared.select("name", "item", "k", "need", F.explode(F.array(band, band - 1)).alias("band"))
            .groupBy("name", "item", "k", "need", "band").agg(F.count("*").alias("n"))
            .where("n >= need").select("name", "item", "k", "band"), "bands")
        # Only texts with candidates, each once, and only items that are candidates.
        with_items = bands.join(items, "item").groupBy("name").agg(F.collect_list(F.struct(
            "item", "item_id", "item_text", "k", "band")).alias("bands"))
        once = texts.join(bands.select("name").distinct(), "name", "left_semi") \
            .dropDuplicates(["name"])
        return materialise(once.join(with_items, "name").mapInArrow(
            _align, f"name string, found {_HITS}"), "found", outlive=True)


_HITS = "array<struct<item_id: long, start: long, end: long, edits: long>>"


def find(docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text", *,
         item: str = "item_id", item_text: str = "text", q: int = Q, rate: float = EDITS,
         item_chars: int = ITEM_CHARS, out: str = "hits", least: int = 1) -> DataFrame:
    """The columns `keep` of every row and, in column `out`, its items of at least `least`
    letters and digits, with span and edits."""
    if out in keep:
        raise ValueError(f"the rows already have a column {out}")
    items = benchmark.select(F.coalesce(F.col(item).cast("long"), F.lit(-1)).alias("item_id"),
                             F.col(item_text).alias("item_text")) \
        .where("item_text is not null").distinct()
    total = items.agg(F.sum(F.length("item_text"))).first()[0] or 0
    name, columns = tx.text_column(keep, text)
    rows = docs.select(*columns)
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    if total <= item_chars:
        return rows.mapInArrow(_search(_part(items), keep, name, out, q, rate, least),
                               f"{kinds}, `{out}` {_HITS}")
    # Equal texts have equal hits, so a text goes by its digest.
    digest = F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256)
    found = _found_by_shuffle(
        docs.where(F.col(f"`{text}`").isNotNull()).select(digest.alias("name"),
                                                          F.col(f"`{text}`").alias("text")),
        items.withColumn("item", F.xxhash64("item_id", "item_text")),
        q, rate, least)
    longer = "_" * max(map(len, [*keep, out]), default=0)
    named = found.select(F.col("name").alias(f"{longer}name"), F.col("found").alias(f"{longer}found"))
    return docs.withColumn(f"{longer}name", digest).join(named, f"{longer}name", "left").select(
        *(F.col(f"`{c}`") for c in keep),
        F.coalesce(f"{longer}found", F.array().cast(_HITS)).alias(out))
