"""Text in blocks of arrays: words, characters and rolling hashes for many documents at once.

Python sees Arrow batches. Each batch is cut into blocks of about BLOCK_BYTES,
so the working memory of a task is bounded by that or by its longest document.
Hashes are polynomials modulo 2**64 over random byte or word codes, mixed at the
end; equal inputs have equal hashes in every task. Such polynomials have known
collisions between long inputs, from 1024 codes on, so a word of LONG bytes or more is
named by a digest of its bytes, and runs of words are shorter than that. Different
inputs then share a 64-bit code as rarely as random numbers would.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 20
# Word separators of the data contract: space and tab to carriage return.
SEPARATORS = (9, 10, 11, 12, 13, 32)
# Words of so many bytes have a digest for a code, as have runs of so many words.
LONG = 256

U64 = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64)."""
    with np.errstate(over="ignore"):
        x = x + U64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_CODE = mix(np.arange(256, dtype=U64))
FOLDED = np.arange(256, dtype=np.uint8)
FOLDED[65:91] += 32
FOLDED_CODE = BYTE_CODE[FOLDED]
IS_SEPARATOR = np.isin(np.arange(256), SEPARATORS)


def powers(n: int, base: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base and of its inverse modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        b = _BASES[base]
        made = []
        for value in (b, pow(b, -1, 1 << 64)):
            row = np.full(size, value, dtype=U64)
            row[0] = 1
            with np.errstate(over="ignore"):
                made.append(np.multiply.accumulate(row))
        _powers[base] = have = (made[0], made[1])
    return have[0][:n], have[1][:n]


class Rolling:
    """Hashes of any run of a sequence of codes, from one pass over it."""

    def __init__(self, codes: np.ndarray, base: int = 0):
        up, self.down = powers(len(codes) + 1, base)
        self.sums = np.zeros(len(codes) + 1, dtype=U64)
        with np.errstate(over="ignore"):
            np.cumsum(codes * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[end] - self.sums[start]) * self.down[start]
                       + (end - start).astype(U64))


def digest(said: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(said, digest_size=8).digest(), "little")


@dataclass
class Block:
    """Rows first..first+n of a batch, their UTF-8 bytes and the limits of each text."""

    first: int
    n: int
    data: np.ndarray
    limits: np.ndarray
    null: np.ndarray


def blocks(batch: pa.RecordBatch, column: str, size: int = BLOCK_BYTES,
           most: int = 1 << 20) -> Iterator[Block]:
    """The texts of a batch, in blocks of about `size` bytes and up to `most` texts.

    A null text is empty and marked null."""
    texts = batch.column(column)
    null = np.asarray(pc.is_null(texts).to_numpy(zero_copy_only=False))
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if n == 0:
        return
    _, at, data = texts.buffers()
    limits = np.frombuffer(at, dtype=np.int64)[texts.offset:texts.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(limits, limits[first] + size, side="right")) - 1
        last = min(max(last, first + 1), first + most, n)
        yield Block(first, last - first, raw[limits[first]:limits[last]],
                    limits[first:last + 1] - limits[first], null[first:last])
        first = last


@dataclass
class Words:
    """The words of a block: byte limits, 64-bit codes and the first word of each text."""

    start: np.ndarray
    end: np.ndarray
    code: np.ndarray
    limits: np.ndarray

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.limits) - 1), np.diff(self.limits))


def words(block: Block, fold: bool = False, apart: np.ndarray = IS_SEPARATOR) -> Words:
    """Words are runs of bytes that `apart` does not name; it names ASCII bytes only, so a
    word never splits a character."""
    data, limits = block.data, block.limits
    if data.size == 0:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(0, U64), np.zeros(len(limits), np.int64))
    inside = ~apart[data]
    # The first byte of a text starts a word whatever stands before it.
    edge = np.zeros(data.size + 1, dtype=bool)
    edge[limits] = True
    before = np.empty(data.size, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(data.size, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    code = Rolling((FOLDED_CODE if fold else BYTE_CODE)[data]).of(start, end)
    for i in np.flatnonzero(end - start >= LONG):
        said = data[start[i]:end[i]]
        code[i] = digest((FOLDED[said] if fold else said).tobytes())
    return Words(start, end, code, np.searchsorted(start, limits))


def grams(found: Words, n: int, base: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all runs of n words within a text, and the limits of each text's runs."""
    count = np.maximum(np.diff(found.limits) - n + 1, 0)
    limits = np.concatenate(([0], np.cumsum(count)))
    start = np.arange(limits[-1]) + np.repeat(found.limits[:-1] - limits[:-1], count)
    return Rolling(found.code, base).of(start, start + n), limits


@dataclass
class Characters:
    """Code points of a block and the limits of each text."""

    points: np.ndarray
    limits: np.ndarray


def characters(block: Block) -> Characters:
    data = block.data.tobytes()
    try:
        points = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    except UnicodeDecodeError:
        # Bytes that are no UTF-8 become U+FFFD, text by text.
        parts = [np.frombuffer(data[a:b].decode("utf-8", "replace").encode("utf-32-le"),
                               dtype=np.uint32)
                 for a, b in zip(block.limits[:-1], block.limits[1:])]
        sizes = np.array([len(p) for p in parts])
        return Characters(np.concatenate(parts), np.concatenate(([0], np.cumsum(sizes))))
    begins = np.concatenate(([0], np.cumsum((block.data & 0xC0) != 0x80)))
    return Characters(points, begins[block.limits])



_kinds: dict[str, np.ndarray] = {}


def letters(points: np.ndarray) -> np.ndarray:
    """Lower-case code points of letters, 0 for everything else."""
    if "lower" not in _kinds:
        table = np.zeros(1 << 16, dtype=np.uint32)
        for p in range(1 << 16):
            c = chr(p)
            if c.isalpha():
                low = c.lower()
                table[p] = ord(low) if len(low) == 1 else p
        _kinds["lower"] = table
    low = _kinds["lower"][points & np.uint32(0xFFFF)]
    far = points > 0xFFFF
    if far.any():
        low = low.copy()
        own, at = np.unique(points[far], return_inverse=True)
        low[far] = np.array([p if chr(p).isalpha() else 0 for p in own], dtype=np.uint32)[at]
    return low


def text_column(keep: list[str], text: str) -> tuple[str, list]:
    """Under which name the text travels beside the columns `keep`, and what to select."""
    if text in keep:
        return text, [F.col(f"`{c}`") for c in keep]
    return "__text", [*(F.col(f"`{c}`") for c in keep), F.col(f"`{text}`").alias("__text")]
