"""Word kernels on Arrow string buffers, in numpy.

A word is a run of characters outside [\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F] after lower-casing A-Z.
In UTF-8 these are exactly the bytes 0-9, a-z and 0x80-0xFF, so words are found on bytes.
"""

from __future__ import annotations

import ctypes
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

#: Bytes of text that one pass of a kernel takes at a time; a longer single text is taken alone.
BLOCK = 1 << 20


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, BLOCK + 1)
        out = np.ones(size, dtype=np.uint64)
        done = 1
        while done < size:  # doubling: x^(done+i) = x^done * x^i
            step = min(done, size - done)
            out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
            done += step
        if size > 4 * BLOCK:  # do not hold on to the table of one giant text
            return out
        _powers[base] = have = out
    return have


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Give freed memory back to the system: a worker process serves the tasks of many operators, one after another."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def listed(column: pa.Array) -> list[str]:
    """A string column without nulls as Python strings, many times faster than to_pylist."""
    return column.to_numpy(zero_copy_only=False).tolist()


def blocks(offsets: np.ndarray, most: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `most` bytes each, one row at the least."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        yield lo, hi
        lo = hi


def pieces(text: bytes, most: int = BLOCK) -> Iterator[bytes]:
    """A text as one piece, or a long one in pieces of about `most` bytes that end at ASCII white space."""
    at = 0
    while len(text) - at > 2 * most and (found := _SPACE.search(text, at + most)):
        yield text[at : found.end()]
        at = found.end()
    yield text[at:]


@dataclass
class Words:
    """Words of some texts. per_text: n+1 word offsets; start, end: byte offsets in low."""

    low: np.ndarray
    start: np.ndarray
    end: np.ndarray
    per_text: np.ndarray

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, the same wherever the word stands."""
        n = len(self.low)
        prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((self.low.astype(np.uint64) + np.uint64(1)) * _power(_BASE, n + 1)[:n], out=prefix[1:])
        h = (prefix[self.end] - prefix[self.start]) * _power(_BASE_INVERSE, n + 1)[self.start]
        return mix(h)

    def word(self, i: int) -> bytes:
        return self.low[self.start[i] : self.end[i]].tobytes()


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The words of the texts data[offsets[i]:offsets[i+1]]; no word reaches over a text's end."""
    base = offsets[0]
    low = _LOWER[data[base : offsets[-1]]]
    at = offsets - base
    is_word = _WORD[low]
    first = is_word.copy()
    first[1:] &= ~is_word[:-1]
    edge = at[1:-1][at[1:-1] < len(low)]
    first[edge] = is_word[edge]
    last = is_word.copy()
    last[:-1] &= ~is_word[1:]
    edge = at[1:-1][at[1:-1] > 0] - 1
    last[edge] = is_word[edge]
    start = np.flatnonzero(first)
    return Words(low, start, np.flatnonzero(last) + 1, np.searchsorted(start, at))


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the len(h)-n+1 windows of n consecutive values (order counts)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, dtype=np.uint64)
    for i in range(n):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += h[i : i + m]
    return mix(out)
