"""Vectorised word hashing over Arrow string columns (numpy, used inside tasks).

Words are the runs between the six ASCII white-space characters. A word's 64-bit hash is a
polynomial over its bytes taken from prefix sums, so a whole batch is hashed
without a Python loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
WORD_BASE = 0xD6E8FEB86659FD93 | 1


def _inverse(b: int) -> int:
    return pow(b, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a finaliser; one to one)."""
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    h = h ^ (h >> U(29))
    h = h * U(0xBF58476D1CE4E5B9)
    return h ^ (h >> U(32))


class Hasher:
    """Tables for one task; powers grow with the longest slice seen."""

    def __init__(self, lower: bool):
        codes = np.arange(256, dtype=np.uint8)
        if lower:
            codes = np.where((codes >= 65) & (codes <= 90), codes + 32, codes).astype(np.uint8)
        self.value = mix(np.arange(1, 257, dtype=U) * U(0xA0761D6478BD642F))[codes]
        self.gap = np.zeros(256, bool)
        self.gap[[32, 9, 10, 11, 12, 13]] = True
        self.powers: dict[int, np.ndarray] = {}

    def power(self, base: int, n: int) -> np.ndarray:
        have = self.powers.get(base)
        if have is None or len(have) < n:
            have = np.full(max(n, 1 << 16), base, U)
            have[0] = 1
            have = self.powers[base] = np.cumprod(have, dtype=U)
        return have[:n]

    def words(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word hashes, byte starts, byte ends, and per text the index of its first word (one more at the end)."""
        n = len(data)
        if n == 0:
            return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
        gap = self.gap[data]
        first = ~gap
        last = first.copy()
        first[1:] &= gap[:-1]
        last[:-1] &= gap[1:]
        full = off[:-1] < off[1:]
        s, e = off[:-1][full], off[1:][full] - 1
        first[s] = ~gap[s]
        last[e] = ~gap[e]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        sums = np.zeros(n + 1, U)
        np.cumsum(self.value[data] * self.power(BASE, n), out=sums[1:])
        h = (sums[ends] - sums[starts]) * self.power(_inverse(BASE), n)[starts]
        h = mix(h + (ends - starts).astype(U))
        return h, starts, ends, np.searchsorted(starts, off)

    def windows(self, h: np.ndarray, size: int) -> np.ndarray:
        """Hash of every run of ``size`` words (across texts too: the caller drops those)."""
        n = len(h)
        if n < size:
            return np.zeros(0, U)
        sums = np.zeros(n + 1, U)
        np.cumsum(h * self.power(WORD_BASE, n), out=sums[1:])
        return mix((sums[size:] - sums[:-size]) * self.power(_inverse(WORD_BASE), n)[:n - size + 1])

    def whole(self, h: np.ndarray) -> np.uint64:
        """Hash of a whole short sequence, its length included."""
        w = self.windows(h, len(h))
        return mix(w + U(len(h)))[0]


def slices(col: pa.Array, limit: int = 2 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column (null: empty) into runs of rows of about ``limit`` bytes:
    (first row, end row, bytes, offsets into them). A longer text is a run of its own."""
    col = pc.fill_null(col.cast(pa.large_binary()), b"")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(col):
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        j = min(j, len(col))
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j
