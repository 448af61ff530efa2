"""Vectorised word splitting for Arrow text columns.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D; ASCII A-Z is
lower-cased first. Nulls count as empty texts. Work goes through NumPy over the
UTF-8 buffer of a batch, one slice of documents at a time, so memory follows
``SLICE_BYTES`` (or the longest single text), never the partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_NO_WORD = np.ones(256, dtype=bool)
_NO_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# Odd multiplier and its inverse modulo 2**64, and one random value per byte.
_R = 0x9E3779B97F4A7C15
_R_INV = pow(_R, -1, 1 << 64)
_BYTE = np.random.Generator(np.random.PCG64(20240607)).integers(0, 1 << 64, 256, dtype=np.uint64)


@dataclass
class Words:
    """Words of a run of documents: ``data[start[i]:end[i]]`` is word ``i`` and
    document ``d`` owns words ``first[d]`` up to ``first[d + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    offset: int  # row of the first document in the batch

    @property
    def docs(self) -> int:
        return len(self.first) - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (shift, multiply, shift)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_buffer(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a text column; nulls become empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        if isinstance(col, pa.ChunkedArray):  # zero chunks or too large for one
            col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.large_string())
    if col.type != pa.large_string():
        col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    raw = col.buffers()[2] if len(col) else None
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data, off


def split_words(col: pa.Array | pa.ChunkedArray, slice_bytes: int = SLICE_BYTES) -> Iterator[Words]:
    """Words of every document of a text column, a slice of documents at a time."""
    return _split(col, slice_bytes, _LOWER, _SPACE)


def letter_words(col: pa.Array | pa.ChunkedArray, slice_bytes: int = SLICE_BYTES) -> Iterator[Words]:
    """As ``split_words``, but words are runs of ASCII letters and digits and of bytes beyond
    ASCII, and each character of a script written without blanks is one; upper-case Latin-1 letters
    (two UTF-8 bytes) are lower-cased as well."""
    for w in _split(col, slice_bytes, _LOWER, _NO_WORD, _blank_free):
        d = w.data
        if len(d) > 1:
            upper = (d[:-1] == 0xC3) & (d[1:] >= 0x80) & (d[1:] <= 0x9E) & (d[1:] != 0x97)
            d[1:][upper] += 0x20
        yield w


def _blank_free(data: np.ndarray) -> np.ndarray:
    """Byte positions before and after every character of Chinese, Japanese, Thai, Lao, Burmese and Khmer."""
    at = np.flatnonzero(data >= 0xE0)  # first bytes of the longer characters
    a, b = data[at], data[at + 1]
    three = ((a == 0xE0) & (b >= 0xB8) & (b <= 0xBB)) | ((a == 0xE1) & ((b <= 0x82) | (b == 0x9E) | (b == 0x9F)))
    three |= ((a >= 0xE3) & (a <= 0xE9)) | ((a == 0xEF) & (b >= 0xA4) & (b <= 0xAB))
    four = (a == 0xF0) & (b >= 0xA0) & (b <= 0xB3)
    return np.concatenate([at[three], at[three] + 3, at[four], at[four] + 4])


def _split(
    col: pa.Array | pa.ChunkedArray, slice_bytes: int, lower: np.ndarray, space: np.ndarray, alone: Callable[[np.ndarray], np.ndarray] | None = None
) -> Iterator[Words]:
    data, off = text_buffer(col)
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + slice_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        part = lower[data[off[lo] : off[hi]]]
        rows = off[lo : hi + 1] - off[lo]
        inside = ~space[part]
        edge = np.zeros(len(part) + 1, dtype=bool)
        edge[rows] = True  # a document's first byte starts anew
        if alone:
            edge[alone(part)] = True
        begins = inside.copy()
        if len(part):
            begins[1:] &= ~inside[:-1] | edge[1:-1]
        ends = inside.copy()
        if len(part):
            ends[:-1] &= ~inside[1:] | edge[1:-1]
        start = np.flatnonzero(begins)
        end = np.flatnonzero(ends) + 1
        yield Words(part, start, end, np.searchsorted(start, rows), lo)
        lo = hi


def hash_words(w: Words) -> np.ndarray:
    """A 64-bit hash per word: a polynomial over random byte values, taken from
    prefix sums, then mixed. Never 0 or 1, which callers use as marks."""
    n = len(w.data)
    power = np.empty(n + 1, dtype=np.uint64)
    power[0] = 1
    power[1:] = _R
    np.multiply.accumulate(power, out=power)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[w.data] * power[:-1], out=total[1:])
    inverse = np.empty(n + 1, dtype=np.uint64)
    inverse[0] = 1
    inverse[1:] = np.uint64(_R_INV)
    np.multiply.accumulate(inverse, out=inverse)
    h = (total[w.end] - total[w.start]) * inverse[w.start]
    h = mix64(h ^ mix64((w.end - w.start).astype(np.uint64)))
    return np.where(h < 2, h + np.uint64(2), h)
