"""Dictionary codes of the words of Arrow string columns (numpy and Arrow, used inside tasks).

A word is a run of bytes outside a byte class, so every step is vectorised: words are cut out of one
buffer, laid side by side and dictionary-encoded by Arrow. Codes are exact: no hash stands for a word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def byte_class(members: str) -> np.ndarray:
    """Marks of the ASCII characters of ``members``."""
    out = np.zeros(256, bool)
    out[list(members.encode("ascii"))] = True
    return out


#: A-Z lower-cased, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_bounds(gap: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the runs where ``gap`` is false; a run never goes on into the next text."""
    first = ~gap
    last = first.copy()
    if len(gap):
        first[1:] &= gap[:-1]
        last[:-1] &= gap[1:]
        full = off[:-1] < off[1:]
        s, e = off[:-1][full], off[1:][full] - 1
        first[s] = ~gap[s]
        last[e] = ~gap[e]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def encode(data: np.ndarray, gap: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The distinct words and, per word, its place among them."""
    off = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=off[1:])
    text = np.ascontiguousarray(data[~gap])
    words = pa.Array.from_buffers(pa.large_utf8(), len(starts), [None, pa.py_buffer(off), pa.py_buffer(text)])
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
