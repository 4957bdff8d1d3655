"""Approximate top-k by an inverted file (O-87).

The index is a folder of points partitioned by cell, beside the cells' centroids and
sizes. Centroids are fitted by k-means on a bounded sample; every point is then
written to the cell of its nearest centroid. A query probes its nearest cells, as many
as it takes to hold ``share`` of all points, so only those partitions are read, and in
them a point is scored only against the queries that probe its cell. Scores are exact;
what a query misses lies in cells that it did not probe.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions import vectors as V
from corpusflow.operators import search as S

#: the sample for k-means: most rows, most bytes of vectors, and rows a cell; most cells, whose centroids every task holds
SAMPLE_ROWS, SAMPLE_BYTES, SAMPLE_PER_CELL, MAX_CELLS = 65_536, 64 << 20, 64, 4096
ROUNDS = 12
#: share of all points that a query's cells hold. Measured recall@10 on vectors without structure: README
SHARE = 0.45


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The centroid nearest to each row (least distance)."""
    return np.argmax(x @ centroids.T - (centroids ** 2).sum(axis=1) / 2, axis=1)


def fit_centroids(sample: np.ndarray, cells: int, seed: int = 7) -> np.ndarray:
    """K-means; a centroid that loses all rows moves to the row farthest from its own."""
    rng = np.random.default_rng(seed)
    centroids = sample[rng.choice(len(sample), cells, replace=False)].copy()
    for _ in range(ROUNDS):
        cell = _nearest(sample, centroids)
        count = np.bincount(cell, minlength=cells)
        total = np.zeros_like(centroids)
        np.add.at(total, cell, sample)
        centroids = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centroids)
        empty = np.flatnonzero(count == 0)
        if len(empty):
            far = np.argsort(((sample - centroids[cell]) ** 2).sum(axis=1))[::-1][:len(empty)]
            centroids[empty] = sample[far]
    return centroids


def build(points: DataFrame, path: str, metric: str = "cosine", cells: int | None = None, id_col: str = "id",
          vector_col: str = "vector", carry: tuple[str, ...] = (), seed: int = 7) -> None:
    """Write the index of ``points`` to ``path``.

    ``cells`` defaults to four times the root of the number of points, ``MAX_CELLS`` at
    most. Every point with a vector is indexed; one without has no score and is left
    out. With ``cosine``, cells follow directions; an all-zero vector goes to some cell.
    """
    if metric not in V.METRICS:
        raise ValueError(f"metric must be one of {list(V.METRICS)}")
    spark = points.sparkSession
    rows = points.where(F.col(vector_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), *carry)
    n, dim = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    if not n:
        raise ValueError("no point has a vector")
    most = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dim)))
    cells = max(1, min(cells or int(4 * n ** 0.5), MAX_CELLS, n, most))
    # a row enters the sample by a hash of its id, so that a rerun fits the same centroids
    wanted = min(most, max(cells * SAMPLE_PER_CELL, cells))
    chance = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "id"), 11) / float(1 << 53)
    drawn = rows.select(chance.alias("draw"), "id", "vector").orderBy("draw", "id").limit(wanted).collect()
    sample = np.array([list(r["vector"]) for r in drawn], np.float64)
    sample = _unit(sample) if metric == "cosine" else sample
    cells = min(cells, len(sample))
    centroids = fit_centroids(sample, cells, seed)
    schema = T.StructType([*rows.schema.fields, T.StructField("cell", T.IntegerType())])

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = np.array(pdf["vector"].tolist(), np.float64)
            if len(x):
                yield pdf.assign(cell=_nearest(_unit(x) if metric == "cosine" else x, centroids).astype(np.int32))

    # rebalanced by cell: a large cell becomes several files, small ones are not torn apart
    rows.mapInPandas(assign, schema).hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(f"{path}/points")
    sizes = spark.read.parquet(f"{path}/points").groupBy("cell").agg(F.count("*").alias("n"))
    known = spark.createDataFrame([(i, c.tolist(), metric) for i, c in enumerate(centroids)], "cell int, centroid array<double>, metric string")
    known.join(sizes, "cell", "left").fillna(0, ["n"]).coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")


def _probed(queries: np.ndarray, centroids: np.ndarray, sizes: np.ndarray, metric: str, share: float) -> list[np.ndarray]:
    """Each query's cells, nearest first, until they hold ``share`` of all points."""
    q = _unit(queries) if metric == "cosine" else queries
    near = np.argsort(-(q @ centroids.T - (0 if metric in ("dot",) else (centroids ** 2).sum(axis=1) / 2)), axis=1, kind="stable")
    out = []
    for row in near:
        filled = np.cumsum(sizes[row])
        out.append(row[:int(np.searchsorted(filled, share * filled[-1])) + 1])
    return out


def search(spark: SparkSession, path: str, queries: DataFrame, k: int = 10, share: float = SHARE, carry: tuple[str, ...] = (),
           max_queries: int = S.MAX_QUERIES_PER_SCAN) -> DataFrame:
    """``query_id, id, *carry, score, rank, scored`` of ``queries(query_id, vector)``.

    ``scored`` is the number of points that the query was scored against. Queries are
    worked on in blocks within the row and byte bounds of the exact search. A query
    without a vector has no hits.
    """
    cells = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()  # MAX_CELLS rows at most
    metric, sizes = cells[0]["metric"], np.array([c["n"] for c in cells])
    centroids = np.array([c["centroid"] for c in cells])
    points = spark.read.parquet(f"{path}/points")
    qs = queries.select(F.col("query_id").cast("string").alias("query_id"), "vector").where("vector is not null")
    out = None
    for block in S._query_blocks(qs, "query_id", "vector", max_queries):
        rows = S._collect_bounded(block, max_queries, "query block")
        if not rows:
            continue
        ids, q = [r["query_id"] for r in rows], np.array([list(r["vector"]) for r in rows], np.float64)
        probed = _probed(q, centroids, sizes, metric, share)
        asked: dict[int, list[int]] = {}
        for i, of in enumerate(probed):
            for c in of.tolist():
                asked.setdefault(c, []).append(i)
        found = _score_cells(points.where(F.col("cell").isin(sorted(asked))), asked, ids, q, k, metric, carry)
        scored = spark.createDataFrame([(x, int(sizes[of].sum())) for x, of in zip(ids, probed)], "query_id string, scored long")
        ranked = S.rank_per_query(found, k, metric).join(scored, "query_id")
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        schema = points.select("id", *carry).schema
        return spark.createDataFrame([], T.StructType([T.StructField("query_id", T.StringType()), *schema.fields,
            T.StructField("score", T.DoubleType()), T.StructField("rank", T.IntegerType()), T.StructField("scored", T.LongType())]))
    return out


def _score_cells(points: DataFrame, asked: dict[int, list[int]], ids: list[str], q: np.ndarray, k: int, metric: str,
                 carry: tuple[str, ...]) -> DataFrame:
    """Each task's best k points of every query, scored only where the query probes the point's cell."""
    larger = V.METRICS[metric]
    schema = T.StructType([T.StructField("query_id", T.StringType()), *points.select("id", *carry).schema.fields, T.StructField("score", T.DoubleType())])
    columns = ["query_id", "id", *carry, "score"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: list[pd.DataFrame] = []
        held = 0
        for pdf in batches:
            for cell, rows in pdf.groupby("cell", sort=False):
                of = np.array(asked[int(cell)])
                step = max(1, S.SCORES_AT_ONCE // len(of))
                for a in range(0, len(rows), step):
                    part = rows.iloc[a:a + step]
                    s = V.score_matrix(metric, np.array(part["vector"].tolist(), np.float64), q[of])
                    key = np.round(-s if larger else s, S.SCORE_DECIMALS)
                    near = key <= np.partition(key, k - 1, axis=0)[k - 1] if len(part) > k else np.ones_like(key, bool)
                    at, query = np.nonzero(near)
                    best.append(part[["id", *carry]].iloc[at].reset_index(drop=True).assign(score=s[at, query], query_id=of[query]))
                    held += len(at)
            if held > 8 * k * len(q):
                best = [S._keep_k(pd.concat(best, ignore_index=True), k, larger, "id")]
                held = len(best[0])
        if best:
            top = S._keep_k(pd.concat(best, ignore_index=True), k, larger, "id")
            yield top.assign(query_id=np.array(ids, object)[top["query_id"].to_numpy()])[columns]

    return points.select("id", "vector", "cell", *carry).mapInPandas(run, schema)


def recall(exact: DataFrame, found: DataFrame) -> DataFrame:
    """Share of the ``exact(query_id, id)`` hits that ``found`` has, over all queries."""
    hit = found.select("query_id", "id", F.lit(1).alias("hit"))
    return exact.join(hit, ["query_id", "id"], "left").agg(F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))
