"""Words of many texts at once, as numpy arrays.

A word is a run of bytes other than space and the control bytes 9 to 13.  Each word gets a
64-bit code; codes of neighbouring words combine into codes of shingles and windows.
Codes propose candidates.  Where two codes of a window stand for its words, both are made of
the same word codes: they differ for different sequences of codes, but two words of equal
64-bit code (a chance of about ``v**2 / 2**65`` among v distinct words) are one word to both.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_powers = np.ones(1, dtype=np.uint64)


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        more = np.full(max(n, 4096), _BASE, dtype=np.uint64)
        more[0] = 1
        _powers = np.multiply.accumulate(more)
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """starts, ends: byte places in data; of text i the words are first[i] to first[i + 1]."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, fold: bool = False):
        self.data, self.offsets = data, offsets
        solid = ~_SPACE[data]
        begins, stops = solid.copy(), solid.copy()
        begins[1:] &= ~solid[:-1]
        stops[:-1] &= ~solid[1:]
        inner = offsets[:-1][offsets[:-1] < len(data)]
        begins[inner] = solid[inner]
        inner = offsets[1:][offsets[1:] > 0] - 1
        stops[inner] = solid[inner]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.codes = np.zeros(0, dtype=np.uint64)
        if len(self.starts):
            low = self.starts[0]
            spans = np.diff(np.append(self.starts, len(data)))
            place = np.arange(low, len(data)) - np.repeat(self.starts, spans)
            byte = (_LOWER[data[low:]] if fold else data[low:]).astype(np.uint64) + np.uint64(1)
            byte *= _power_table(int(place.max()) + 1)[place]
            byte[~solid[low:]] = 0
            self.codes = mixed(np.add.reduceat(byte, self.starts - low))

    def runs(self, k: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Codes of k consecutive words from each word on, and whether those words are of one text."""
        n = len(self.codes) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        out = np.zeros(n, dtype=np.uint64)
        by = np.uint64((_BASE * (2 * seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        for j in range(k):
            out = out * by + self.codes[j : j + n]
        left = np.repeat(self.first[1:], self.counts) - np.arange(len(self.codes))
        return mixed(out), left[:n] >= k

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def text(self, i: int, j: int) -> bytes:
        """The bytes from word i to before word j, spaces as they were."""
        return self.data[self.starts[i] : self.ends[j - 1]].tobytes()

    def words(self, i: int, j: int) -> list[bytes]:
        return self.text(i, j).split() if j > i else []


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """The least of each w neighbours."""
    if len(a) < w:
        return a[:0]
    out, span = a, 1
    while span * 2 <= w:
        out, span = np.minimum(out[:-span], out[span:]), span * 2
    return out if span == w else np.minimum(out[: len(a) - w + 1], out[w - span : w - span + len(a) - w + 1])


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, dtype=wide, count=len(column) + 1 + column.offset)[column.offset :].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_chunks(column: pa.Array, fold: bool = False, most: int = 2 << 20) -> Iterator[tuple[int, int, Words]]:
    """Rows lo to hi of the column with their words, of about ``most`` bytes or one row each."""
    data, offsets = text_buffers(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], fold)
        lo = hi
