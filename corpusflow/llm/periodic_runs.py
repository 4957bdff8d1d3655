"""Periodic runs of words by a sparse diagonal dynamic programme.

Diagonal ``d`` holds the pairs of words ``d`` apart. Where such pairs are equal from
one word to the next, the match length on the diagonal grows; where they stop, the
diagonal ends, and a match length that suffices gives a run of period ``d`` at once.

Word by word a frequent word would touch a diagonal for each of its earlier
occurrences, the square of its count. But a run of period ``d`` needs at least ``d``
equal pairs in a row. So lags below 8 are followed word by word, and lags from ``2 b``
to ``4 b`` block by block, ``b`` = 4, 8, 16, ...: for each aligned block of ``b`` words, its
earlier occurrences at such lags increase the match lengths of their diagonals by
``b``. Every sufficient stretch holds a whole block, so none is missed, and a block has
``2 b`` such lags at most, so a text of n words has 2 n cells a level, whatever it
repeats. Ends of a stretch, shorter than a block, are found by halving.

Words and blocks are compared by 64-bit hashes. All texts of a batch are worked on
at once; no stretch crosses from one text to the next.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import texthash as H
from corpusflow.llm.common import ensure_parallel, text_or_empty

MIN_LENGTH = 12
#: lags below this one are followed word by word
_SHORT = 8
#: words worked on at once; a longer text is worked on alone
_SLICE = 1 << 19


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of each stretch of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], equal.view(np.int8), [0]])))
    return edge[::2], edge[1::2] - edge[::2]


class _Blocks:
    """Hashes of blocks of any length at any place, from prefix sums."""

    def __init__(self, words: np.ndarray) -> None:
        up, self.down = H._WORDS[0].upto(len(words) + 1)
        self.total = np.zeros(len(words) + 1, H.U)
        np.cumsum(words * up[:-1], out=self.total[1:])

    def at(self, start: np.ndarray, size: int) -> np.ndarray:
        return (self.total[start + size] - self.total[start]) * self.down[start]


def find_runs(words: np.ndarray, text_starts: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, length, period`` of the maximal runs in word hashes, ordered by start and period.

    ``text_starts`` has the first word of each text and, last, the number of words.
    A run lies within one text, has length ``max(min_length, 2 * period)`` at least,
    and its period is the smallest of its words.
    """
    n = len(words)
    number = np.repeat(np.arange(len(text_starts) - 1), np.diff(text_starts))
    first, end = text_starts[:-1][number], text_starts[1:][number]
    found = []

    def emit(at: np.ndarray, length: np.ndarray, lag: np.ndarray) -> None:
        enough = (length >= lag) & (length + lag >= min_length)
        found.append((at[enough] - lag[enough], length[enough] + lag[enough], lag[enough]))

    for d in range(1, min(_SHORT, n)):
        at, length = _stretches((words[d:] == words[:-d]) & (number[d:] == number[:-d]))
        emit(at + d, length, np.full(len(at), d))

    blocks, b, longest = _Blocks(words), _SHORT // 2, int(np.diff(text_starts).max(initial=0))
    while 4 * b <= longest:  # a run of lag 2 b has 4 b words at least
        at, lag = _cells(blocks, b, first, end)
        if len(at):
            # cells of one diagonal, block after block, are one stretch
            order = np.lexsort((at, lag))
            at, lag = at[order], lag[order]
            new = np.flatnonzero(np.append(True, (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + b)))
            last = np.append(new[1:], len(at)) - 1
            lag, left, right = lag[new], at[new], at[last] + b
            step = b // 2
            while step:
                fits = left - lag - step >= first[left]
                some = np.flatnonzero(fits)
                some = some[blocks.at(left[some] - step, step) == blocks.at(left[some] - step - lag[some], step)]
                left[some] -= step
                some = np.flatnonzero(right + step <= end[right - 1])
                some = some[blocks.at(right[some], step) == blocks.at(right[some] - lag[some], step)]
                right[some] += step
                step //= 2
            emit(left, right - left, lag)
        b *= 2

    found.append((np.zeros(0, np.int64),) * 3)
    start, length, period = (np.concatenate(c) for c in zip(*found))
    # a lag that is a multiple of the period gives the same stretch of words: the smallest stays
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    if len(start):
        keep = np.append(True, (start[1:] != start[:-1]) | (length[1:] != length[:-1]))
        start, length, period = start[keep], length[keep], period[keep]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _cells(blocks: _Blocks, b: int, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(place, lag)`` of the aligned blocks of ``b`` words that occur ``2 b`` to ``4 b - 1`` words earlier in their text.

    Blocks are aligned within the batch; a block that crosses a text's end has no cells.
    """
    n = len(first)
    whole = np.flatnonzero((np.arange(n) + b <= end) & (end - first >= 4 * b))
    hashes = blocks.at(whole, b)
    wanted = np.unique(hashes[whole % b == 0])
    if not len(wanted):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # most places are ruled out by a table of hash bits before they are searched
    bits = H.U((16 << len(wanted).bit_length()) - 1)
    marks = np.zeros(int(bits) + 1, bool)
    marks[wanted & bits] = True
    likely = marks[hashes & bits]
    place, hashes = whole[likely], hashes[likely]
    group = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
    same = wanted[group] == hashes
    place, group = place[same], group[same]
    aligned = place % b == 0
    key = np.sort(group * (n + 1) + place)  # places of equal blocks, ascending
    anchor, of = place[aligned], group[aligned]
    low = np.searchsorted(key, of * (n + 1) + np.maximum(anchor - 4 * b + 1, first[anchor]))
    high = np.searchsorted(key, of * (n + 1) + np.maximum(anchor - 2 * b, -1), side="right")
    count = np.maximum(high - low, 0)
    at = np.repeat(anchor, count)
    nth = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
    return at, at - (key[np.repeat(low, count) + nth] - np.repeat(of * (n + 1), count))


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Places of the words that the documents' stated edit takes, or None where it changes nothing.

    One document in ten, by the CRC-32 of its id in decimal, repeats a piece of itself to its end.
    """
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([np.arange(a), a + np.arange(n - a) % p])


def _report(batches: Iterator[pa.RecordBatch], edit=None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
        held, n = [], 0
        for row, h in H.texts(texts):
            places = edit(ids[row], len(h)) if edit else None
            held.append((row, h if places is None else h[places], places))
            n += len(h)
            if n >= _SLICE:
                yield _rows(ids, texts, held)
                held, n = [], 0
        if held:
            yield _rows(ids, texts, held)


def _rows(ids: list, texts: pa.Array, held: list) -> pa.RecordBatch:
    starts = np.cumsum([0, *(len(h) for _, h, _ in held)])
    start, length, period = find_runs(np.concatenate([h for _, h, _ in held]), starts)
    cut = np.searchsorted(start, starts)
    out = []
    for k, (row, h, places) in enumerate(held):
        s, m, q = start[cut[k]:cut[k + 1]] - starts[k], length[cut[k]:cut[k + 1]], period[cut[k]:cut[k + 1]]
        found = texts[row].as_py().encode().split() if len(h) else []
        if places is not None:
            found = [found[i] for i in places.tolist()]
        if len(s):
            # a run covers its words after the first period
            depth = np.zeros(len(h) + 1, np.int64)
            np.add.at(depth, s + q, 1)
            np.add.at(depth, s + m, -1)
            found = [found[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]
            i = int(np.lexsort((q, s, -m))[0])
            best = (int(s[i]), int(m[i]), int(q[i]), 1000 * int(m[i]) // int(q[i]))
        else:
            best = (None,) * 4
        lines = "".join(f"{x},{y},{z}\n" for x, y, z in zip(s.tolist(), m.tolist(), q.tolist()))
        out.append((ids[row], len(s), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(found)).hexdigest()))
    kinds = [pa.int64()] * 6 + [pa.string()] * 2
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=_NAMES)


_NAMES = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
_SCHEMA = ", ".join(f"{c} {'string' if c.endswith('sha256') else 'long'}" for c in _NAMES)


def run_report(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", edit=None) -> DataFrame:
    """Per document its maximal runs: ``doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256``.

    A run is a stretch of words with smallest period q, of at least max(12, 2 q)
    words, that no neighbouring word extends. ``start`` to ``exponent_milli`` tell of
    the longest (ties: the smallest start, then period). ``collapsed_sha256`` is the
    hash of the words that no run has after its first q, joined by one space.
    ``edit(doc_id, n_words)`` may name, as places, other words to be read instead.

    A null, empty or blank text has no words and no run: four nulls and the hashes
    of the empty string. A null doc_id is kept and never edited. Rows are worked on
    one by one, so repeated rows give equal rows; other columns are ignored; an
    empty table gives an empty result.
    """
    rows = ensure_parallel(docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(F.col(text)).alias("text")))
    return rows.mapInArrow(partial(_report, edit=edit), _SCHEMA)


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row, h in H.texts(batch.column("text")):
            found = batch.column("text")[row].as_py().encode().split() if len(h) else []
            start, length, period = find_runs(h, np.array([0, len(h)]))
            out += [(row, s, m, q, b" ".join(found[s:s + q]).decode()) for s, m, q in zip(start.tolist(), length.tolist(), period.tolist())]
        index = pa.array([r[0] for r in out], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(index), *[pa.array([r[i] for r in out], pa.int64()) for i in (1, 2, 3)],
             pa.array([r[4] for r in out], pa.string())], names=["doc_id", "start", "length", "period", "unit"])


def runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per maximal run of ``docs``: ``doc_id, start, length, period, unit``, the unit being the words of one period.

    Nulls, repeats and other columns as in ``run_report``.
    """
    rows = ensure_parallel(docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(F.col(text)).alias("text")))
    return rows.mapInArrow(_split, "doc_id long, start long, length long, period long, unit string")
