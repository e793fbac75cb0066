"""Whole-batch text primitives on UTF-8 bytes: words, hashes of words and of word windows.

An Arrow string column is one byte buffer with offsets, so words, hashes and windows of all its texts
are found with a few numpy passes instead of a loop over words. Work goes in slices of half a million
bytes, which bounds the memory of a task; a single longer text makes a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 500_000
BASE = np.uint64(0x9E3779B97F4A7C15)
SALT_A = np.uint64(0xD1342543DE82EF95)
SALT_B = np.uint64(0xAF251AF3B0F025B5)
ONE = np.uint64(1)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch whose texts come to about ``limit`` bytes, one row at least."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.cumsum(sizes) // limit
    for part in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(group)) + 1):
        if len(part):
            yield batch.slice(part[0], len(part))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts in a row, offsets of the texts); a null is an empty text."""
    column = pa.chunked_array([column]).combine_chunks() if column.offset else column
    column = column.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, kept up to the longest slice so far."""

    def __init__(self, base: np.uint64):
        self.base, self.up, self.down = base, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 1 << 12)
            for name, base in (("up", self.base), ("down", _inverse(self.base))):
                steps = np.full(size, base, np.uint64)
                steps[0] = ONE
                setattr(self, name, np.cumprod(steps))
        return self.up, self.down


_POWERS = {int(b): _Powers(b) for b in (BASE, SALT_A, SALT_B)}


def prefix_sums(values: np.ndarray, base: np.uint64) -> np.ndarray:
    """Prefix sums of values[i] * base**i modulo 2**64, with a leading zero."""
    up, _ = _POWERS[int(base)].get(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * up[: len(values)], out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: np.uint64) -> np.ndarray:
    """Hash of each range [start, end) of the values under the sums; equal ranges have equal hashes."""
    _, down = _POWERS[int(base)].get(len(sums))
    return mix((sums[end] - sums[start]) * down[start])


class Words(NamedTuple):
    """Words of a slice of texts: byte ranges, the text of each, and per text the range of its words."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    bounds: np.ndarray

    def hashes(self) -> np.ndarray:
        sums = prefix_sums(self.data.astype(np.uint64) + ONE, BASE)
        lengths = (self.end - self.start).astype(np.uint64)
        return mix(range_hash(sums, self.start, self.end, BASE) + lengths)

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def line_of_words(self, first: int, last: int) -> bytes:
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.start[first:last], self.end[first:last]))


def split_words(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray) -> Words:
    """Maximal runs of bytes that ``breaks`` (by byte value) does not name, never across texts."""
    inside = ~breaks[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    bounds = np.searchsorted(start, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    return Words(data, offsets, start, end, text, bounds)


def window_hashes(words: Words, hashes: np.ndarray, size: int, base: np.uint64 = SALT_A) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of every window of ``size`` words inside one text."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.flatnonzero(words.text[:n] == words.text[size - 1 :])
    return first, range_hash(prefix_sums(hashes, base), first, first + size, base)


def cover(first: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n positions lie in a range [f, f + size) for some f."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, np.minimum(first + size, n), -1)
    return np.cumsum(change[:-1]) > 0


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of values over each text, ``bounds`` giving the ranges; an empty range sums to 0."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each window of ``size`` values, by doubling."""
    out, width = values, 1
    while width < size:
        step = min(width, size - width)
        out = np.minimum(out[: len(out) - step], out[step:])
        width += step
    return out


def winnow(values: np.ndarray, size: int) -> np.ndarray:
    """Positions that are a minimum of some window of ``size`` values; of all values if fewer."""
    size = min(size, len(values))
    if size <= 0:
        return np.zeros(0, np.int64)
    least = sliding_min(values, size)
    padded = np.concatenate([np.zeros(size - 1, values.dtype), least, np.zeros(size - 1, values.dtype)])
    highest = ~sliding_min(~padded, size)
    return np.flatnonzero(highest[: len(values)] == values)
