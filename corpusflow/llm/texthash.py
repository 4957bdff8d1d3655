"""Vectorised 64-bit hashes of words and word windows over Arrow text batches.

Hashes are fixed functions of the bytes (no per-process seed), so every task
and every run agrees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_SLICE = 1 << 19  # bytes hashed at a time, so that the temporaries stay in cache


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift-multiply)."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int) -> None:
        self.base, self.inv = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            m = len(self.up)
            self.up = np.concatenate([self.up, self.up * U(pow(self.base, m, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * U(pow(self.inv, m, 1 << 64))])
        return self.up[:n], self.down[:n]


_BYTES = _Powers(0x9E3779B97F4A7C15)
_WORDS = (_Powers(0xD6E8FEB86659FD93), _Powers(0xA0761D6478BD642F))
_SEP = np.zeros(256, bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_PLAIN = mix(np.arange(1, 257, dtype=U) * U(0x2545F4914F6CDD1D))
_FOLDED = _PLAIN.copy()
_FOLDED[65:91] = _PLAIN[97:123]  # A-Z as a-z


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and its n+1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if column.null_count == 0 else pa.array(
        [b"" if v is None else v for v in column.cast(pa.large_binary()).to_pylist()], pa.large_binary())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None and len(off) and off[-1] > off[0] else np.zeros(0, np.uint8)
    return raw, off - (off[0] if len(off) else 0)


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the index of each text's first word (n+1)."""
    if len(raw) == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    inside = ~_SEP[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True  # a word ends with its text
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold_case: bool = False) -> np.ndarray:
    """64-bit hash of each word (A-Z read as a-z if ``fold_case``)."""
    table, out, i = (_FOLDED if fold_case else _PLAIN), np.empty(len(starts), U), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _SLICE, side="right")))
        base, stop = int(starts[i]), int(ends[j - 1])
        up, down = _BYTES.upto(stop - base + 1)
        total = np.zeros(stop - base + 1, U)
        np.cumsum(table[raw[base:stop]] * up[:-1], out=total[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((total[e] - total[s]) * down[s] + (e - s).astype(U))
        i = j
    return out


def windows(h: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """Hash of every run of ``size`` consecutive word hashes."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, U)
    up, down = _WORDS[which].upto(len(h) + 1)
    total = np.zeros(len(h) + 1, U)
    np.cumsum(h * up[:-1], out=total[1:])
    return mix((total[size:] - total[:n]) * down[:n] + U(size))


def texts(batch_column: pa.Array, fold_case: bool = False, limit: int = 1 << 22) -> Iterator[tuple[int, np.ndarray]]:
    """(row, word hashes) of each text, worked off in runs of about ``limit`` bytes."""
    for row, h, *_ in texts_with_bounds(batch_column, fold_case, limit):
        yield row, h


def texts_with_bounds(batch_column, fold_case: bool = False, limit: int = 1 << 22):
    """(row, word hashes, bytes, word starts, word ends) of each text."""
    raw, offsets = text_buffer(batch_column)
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        part, off = raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        starts, ends, first = word_bounds(part, off)
        h = hash_words(part, starts, ends, fold_case)
        for k in range(j - i):
            a, b = first[k], first[k + 1]
            yield i + k, h[a:b], part, starts[a:b], ends[a:b]
        i = j


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)
