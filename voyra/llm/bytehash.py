"""Words, lines and window hashes of whole Arrow text batches, in numpy.

A batch is cut into slices of a few MB of UTF-8; inside a slice every step is
one vector operation over all of its documents. Words are runs of bytes other
than space and 0x09-0x0D. A word's 64-bit hash is a polynomial sum of random
byte values, taken from prefix sums (the multiplier is odd, so the power of
the start can be divided out modulo 2**64), then mixed.

Nulls count as empty texts. Nothing is cut: a text longer than a slice is a
slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
_MULT = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift and multiply)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULT))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def run(base: int) -> np.ndarray:
        out = np.full(n + 1, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)
    return run(_MULT), run(pow(_MULT, -1, 1 << 64))


def _power_pair(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << 16
    while size < n:
        size *= 2
    return _powers(size)


@dataclass
class Slice:
    """Rows ``lo:hi`` of a batch: UTF-8 bytes, row offsets, word bounds."""

    lo: int
    hi: int
    buf: np.ndarray
    offs: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray        # row (from 0 in the slice) of each word
    first: np.ndarray      # first word of each row, and one past the last

    @property
    def n(self) -> int:
        return self.hi - self.lo

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def span_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        power, inverse = _power_pair(len(self.buf))
        acc = np.empty(len(self.buf) + 1, np.uint64)
        acc[0] = 0
        np.cumsum(_BYTE[self.buf] * power[: len(self.buf)], out=acc[1:])
        return mix((acc[ends] - acc[starts]) * inverse[starts])

    def word_hash(self) -> np.ndarray:
        return self.span_hash(self.starts, self.ends)

    def window_ok(self, length: int) -> np.ndarray:
        """Word positions where a window of ``length`` words of one row starts."""
        if len(self.row) < length:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.row[: len(self.row) - length + 1] == self.row[length - 1:])


def join_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two windows side by side, from the hashes of the two."""
    return mix(left * np.uint64(0xD6E8FEB86659FD93) + (right ^ np.uint64(0xA0761D6478BD642F)))


def window_hash(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every window of ``length`` words, by doubling; the last step
    overlaps two windows of the largest power of two. Element p belongs to the
    window that starts at word p; windows across rows are for the caller to drop."""
    h, size = words, 1
    while size * 2 <= length:
        h = join_hash(h[: len(h) - size], h[size:]) if len(h) > size else h[:0]
        size *= 2
    if size < length:
        rest = length - size
        h = join_hash(h[: len(h) - rest], h[rest:]) if len(h) > rest else h[:0]
    return h


def raw(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 offsets of a string column, nulls as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[col.offset: col.offset + len(col) + 1]
    offs = offs.astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data, offs


def slices(col: pa.Array, lower: bool = False, max_bytes: int = SLICE_BYTES) -> Iterator[Slice]:
    if not len(col):
        return
    data, offs = raw(col)
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + max_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        buf = data[offs[lo]: offs[hi]]
        if lower:
            buf = _LOWER[buf]
        yield words_of(lo, hi, buf, offs[lo: hi + 1] - offs[lo])
        lo = hi


def words_of(lo: int, hi: int, buf: np.ndarray, offs: np.ndarray) -> Slice:
    inside = np.zeros(len(buf) + 2, bool)
    np.logical_not(_SPACE[buf], out=inside[1:-1])
    edge = np.zeros(len(buf) + 1, bool)          # a row begins at this byte
    edge[offs[:-1]] = True
    edge[len(buf)] = True
    now, before, after = inside[1:-1], inside[:-2], inside[2:]
    starts = np.flatnonzero(now & (~before | edge[:-1]))
    ends = np.flatnonzero(now & (~after | edge[1:])) + 1
    first = np.searchsorted(starts, offs)
    row = np.repeat(np.arange(hi - lo), np.diff(first))
    return Slice(lo, hi, buf, offs, starts, ends, row, first)


def take_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """String array of the byte spans (each valid UTF-8)."""
    size = ends - starts
    offs = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(size, out=offs[1:])
    at = np.repeat(starts - offs[:-1], size) + np.arange(offs[-1])
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offs), pa.py_buffer(buf[at])).cast(pa.string())
