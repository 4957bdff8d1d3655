"""Vector expressions (native higher-order functions) and the metric table.

Used where a score is needed per row (hybrid search re-rank, context checks).
The bulk top-k scans score Arrow batches with ``score_matrix`` instead, which is
much faster than interpreted lambdas.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow.functions._util import col

# Distance names of the reference's collections and whether a
# larger score means closer.
METRICS = {
    "cosine": True,
    "dot": True,
    "euclid": False,
    "manhattan": False,
}


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def dot(a, b) -> Column:
    return _sum(F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double")))


def norm(a) -> Column:
    return F.sqrt(_sum(F.transform(col(a), lambda x: x.cast("double") * x.cast("double"))))


def cosine(a, b) -> Column:
    """Cosine similarity; 0 where a vector has no length."""
    n = norm(a) * norm(b)
    return F.when(n == 0, F.lit(0.0)).otherwise(dot(a, b) / n)


def euclid(a, b) -> Column:
    return F.sqrt(_sum(F.zip_with(col(a), col(b), lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))))


def manhattan(a, b) -> Column:
    return _sum(F.zip_with(col(a), col(b), lambda x, y: F.abs(x.cast("double") - y.cast("double"))))


SCORERS = {"cosine": cosine, "dot": dot, "euclid": euclid, "manhattan": manhattan}


def score(metric: str, a, b) -> Column:
    return SCORERS[metric](a, b)


def score_matrix(metric: str, points: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Scores of all rows of ``points`` against all rows of ``queries`` (points x queries)."""
    if metric == "dot":
        return points @ queries.T
    if metric == "cosine":
        norms = np.outer(np.linalg.norm(points, axis=1), np.linalg.norm(queries, axis=1))
        return np.divide(points @ queries.T, norms, out=np.zeros_like(norms), where=norms > 0)
    if metric == "euclid":
        return np.stack([np.sqrt(((points - q) ** 2).sum(axis=1)) for q in queries], axis=1)
    return np.stack([np.abs(points - q).sum(axis=1) for q in queries], axis=1)
