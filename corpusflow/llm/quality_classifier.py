"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Every text is reduced to document statistics. Random Fourier features map them
so that inner products approximate a Gaussian kernel; each partition sums its
part of the normal equations, and Spark adds the parts, so the driver gets a
matrix of fixed size whatever the number of rows. The ridge scores of the
training rows are binned at quantiles and made monotone by pooling adjacent
violators, which turns scores into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import texthash as H
from corpusflow.llm.common import ensure_parallel, stage
from corpusflow.llm.quality_rules import STOP_WORDS

FEATURES, RIDGE, BINS, THRESHOLD = 128, 1e-3, 200, 0.7

STATISTICS = ("log_words", "word_bytes", "symbols", "capitals", "digits", "marks", "exclamations", "bars", "wide", "distinct",
              "repeated_windows", "stutter", "line_copies", "log_line_words", "function_words", "log_bytes")


def _classes() -> np.ndarray:
    """Byte value -> membership in the counted byte classes."""
    out = np.zeros((7, 256), bool)
    for row, chars in enumerate((b"#*$%&<>", bytes(range(65, 91)), bytes(range(48, 58)), b".,;:?", b"!", b"|")):
        out[row, list(chars)] = True
    out[6, 128:] = True
    return out


_CLASSES = _classes()


def _stop_hashes() -> np.ndarray:
    (_, h), = H.texts(pa.array([" ".join(sorted(set(STOP_WORDS)))]), fold_case=True)
    return np.unique(h)


def _member(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def text_statistics(column: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` per text, from the whole text; null and empty texts give zeros."""
    stop, out = _stop_hashes(), np.zeros((len(column), len(STATISTICS)))
    for row, h, raw, starts, ends in H.texts_with_bounds(column, fold_case=True):
        n = len(h)
        if not n:
            continue
        body = raw[starts[0]:ends[-1]]
        per_byte = np.bincount(body, minlength=256)
        symbols, upper, digits, marks, bang, bar, wide = (_CLASSES * per_byte).sum(axis=1)
        size = int((ends - starts).sum())
        runs = H.windows(h, 5)
        line = np.searchsorted(np.flatnonzero(body == 10) + starts[0], starts)
        first = np.flatnonzero(np.concatenate([[True], np.diff(line) > 0]))
        lines = [H.windows(h[a:b], b - a)[0] for a, b in zip(first, np.append(first[1:], n))] if len(first) < n else h
        out[row] = (
            np.log1p(n), size / n, symbols / n, upper / size, digits / size, marks / n, bang / n, bar / n, wide / size,
            len(np.unique(h)) / n ** 0.8, 1 - len(np.unique(runs)) / len(runs) if len(runs) else 0.0,
            float((h[1:] == h[:-1]).sum()) / n, 1 - len(set(map(int, lines))) / len(first), np.log1p(n / len(first)),
            float(_member(h, stop).sum()) / n, np.log1p(len(body)))
    return out


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = text_statistics(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "x"])


class Model:
    """Statistics -> probability of label 1. A model of no rows says 0.5."""

    def __init__(self, mean, scale, features: int = FEATURES, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        d = len(mean)
        self.mean, self.scale = np.asarray(mean), np.asarray(scale)
        self.directions = rng.normal(size=(d, features)) / np.sqrt(d)
        self.phase = rng.uniform(0, 2 * np.pi, features)
        self.weights = None
        self.knots: tuple[np.ndarray, np.ndarray] | None = None

    def features(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features of a Gaussian kernel, and a constant."""
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.column_stack([np.sqrt(2 / len(self.phase)) * np.cos(z @ self.directions + self.phase), np.ones(len(x))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None or self.knots is None:
            return np.full(len(x), 0.5)
        return np.clip(np.interp(self.raw(x), *self.knots), 0, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), float).reshape(len(column), len(STATISTICS))


def isotonic(score: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing fit of ``label`` on ``score`` (sorted), by pooling adjacent violators: knots and values."""
    blocks: list[list[float]] = []
    for s, y, w in zip(score, label, weight):
        blocks.append([s * w, y * w, w])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def fit(training: DataFrame, features: int = FEATURES, ridge: float = RIDGE) -> Model:
    """Fit on all rows of ``training(x, y)``, y 0 or 1."""
    d = len(STATISTICS)
    stats = training.agg(F.count("*"), *[f(F.get("x", F.lit(i))) for i in range(d) for f in (F.avg, F.stddev_pop)]).first()
    n = stats[0]
    mean = [stats[1 + 2 * i] or 0.0 for i in range(d)]
    scale = [stats[2 + 2 * i] or 1.0 for i in range(d)]
    model = Model(mean, scale, features)
    if not n:
        return model
    width = features + 2

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            z = np.column_stack([model.features(_matrix(batch.column("x"))), batch.column("y").to_numpy().astype(float)])
            total += z.T @ z
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
                                         names=["i", "j", "v"])

    normal = np.zeros((width, width))
    for i, j, v in training.mapInArrow(sums, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v")).collect():
        normal[i, j] = normal[j, i] = v
    a, b = normal[:-1, :-1], normal[:-1, -1]
    model.weights = np.linalg.solve(a + ridge * n * np.diag([1.0] * features + [0.0]) + 1e-9 * n * np.eye(width - 1), b)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(model.raw(_matrix(batch.column("x")))), batch.column("y").cast(pa.float64())], names=["s", "y"])

    scored, _ = stage(training.mapInArrow(raw, "s double, y double"), "raw-scores")
    cuts = sorted(set(scored.agg(F.percentile_approx("s", [i / BINS for i in range(1, BINS)], 10_000)).first()[0]))
    at = F.size(F.filter(F.lit(cuts), lambda c: c <= F.col("s"))) if cuts else F.lit(0)
    bins = sorted(scored.groupBy(at.alias("bin")).agg(F.avg("s"), F.avg("y"), F.count("*")).collect())  # BINS rows at most
    model.knots = isotonic(*np.array([r[1:] for r in bins], float).T)
    return model


def is_held_out(doc_id: str = "doc_id"):
    """Whether crc32 of the doc_id as text leaves 2 modulo 4; a null doc_id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs(doc_id, text)``.

    Learns from the rows of ``labels(doc_id, <label>)`` that are not held out; the
    texts' statistics are the only inputs. Null labels and labels of unknown ids
    are left out; without any label every score is 0.5. Null and empty texts have
    zero statistics and get the score of those. Repeated rows are scored alike;
    other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    vectors, _ = stage(ensure_parallel(rows).mapInArrow(_vectors, "doc_id long, x array<double>"), "statistics")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("y in (0, 1)")
    training, _ = stage(vectors.where(~is_held_out()).join(known, "doc_id").select("x", "y"), "training")
    model = fit(training)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(model.score(_matrix(batch.column("x"))))], names=["doc_id", "score"])

    out = vectors.mapInArrow(scored, "doc_id long, score double")
    return out.select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
