"""Vector and keyword search (O-81 … O-86, O-88 … O-91); ``vector_index`` is the approximate search.

Exact top-k plan, for any number of points:

1. The query set is checked to be bounded (``max_queries`` rows and a byte
   budget) before it is shipped to executors; a larger set is processed in
   blocks of that size, each block one scan — exact, never truncated.
2. Each point partition is scored with NumPy over Arrow batches
   (``mapInPandas``) and reduced to its own top-k per query *before* any
   shuffle, so a scan of N points emits at most ``partitions × Q × k`` rows.
3. A window ``row_number`` per query over those candidates gives the global
   top-k (ties: rounded score, then id). Spark inserts a partial window
   group limit before that shuffle as well.

No cross join is planned and no point is ever grouped with all others.
Ranking uses the score rounded to 6 decimals, then the id, so results are
deterministic across engines and partitionings.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions import text as TX
from corpusflow.functions import vectors as V

#: query rows and bytes shipped to executors at once, and scores held at once by a task
MAX_QUERIES_PER_SCAN = 4096
MAX_QUERY_BYTES = 64 << 20
SCORES_AT_ONCE = 4_000_000
SCORE_DECIMALS = 6


def _larger_is_closer(metric: str) -> bool:
    return V.METRICS[metric]


def _collect_bounded(df: DataFrame, max_rows: int, what: str) -> list:
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise OverflowError(f"{what} has more than {max_rows} rows")
    return rows


def _query_blocks(queries: DataFrame, query_id: str, vector: str, max_queries: int, words: str | None = None, depth: int = 0) -> list[DataFrame]:
    """Split the query set into blocks within the row and byte budget.

    One pass counts the queries and finds their dimension and the bytes of the longest
    list of ``words``, if they have such. A block that is still
    too large (uneven hashing) is split again with a different salt, so every
    block is provably bounded before it is shipped.
    """
    text = F.max(F.octet_length(F.array_join(words, "  "))) if words else F.lit(0)
    n, dim, text = queries.agg(F.count(F.lit(1)), F.max(F.size(vector)), text).first()
    per_block = max(1, min(max_queries, MAX_QUERY_BYTES // (8 * max(dim or 0, 0) + (text or 0) + 64)))
    if n <= per_block:
        return [queries]
    if depth >= 8:
        raise OverflowError("query ids are not distinct enough to split into bounded blocks")
    n_blocks = math.ceil(n / per_block) * 2
    salt = F.concat(F.col(query_id).cast("string"), F.lit(f"#{depth}"))
    keyed = queries.withColumn("__blk", F.pmod(F.xxhash64(salt), F.lit(n_blocks)))
    out = []
    for b in range(n_blocks):
        out += _query_blocks(keyed.where(F.col("__blk") == b).drop("__blk"), query_id, vector, max_queries, words, depth + 1)
    return out


def _partition_topk(points: DataFrame, qids: list, qmat: np.ndarray, k: int, metric: str,
                    id_col: str, vector_col: str, carry: list[str], tokens: Column | None = None,
                    words: list[list[str]] | None = None) -> DataFrame:
    """Each partition's best ``k`` points for every query; with ``words``, among points that have all of a query's words in ``tokens``."""
    larger = _larger_is_closer(metric)
    schema = points.select(id_col, *carry).schema
    out_schema = T.StructType([T.StructField("query_id", T.StringType(), False)]
                              + list(schema.fields)
                              + [T.StructField("score", T.DoubleType(), True)])
    q = qmat.astype(np.float64)
    qids_s = np.array([str(x) for x in qids], dtype=object)

    masks = _WordMasks(words) if words is not None else None

    def best_of(pdf: pd.DataFrame) -> pd.DataFrame:
        """The k best rows of a batch for every query at once; ties at the boundary are kept."""
        if masks:
            may = masks.of(pdf["__tokens"])
            some = may.any(axis=1)
            pdf, may = pdf[some], may[some]
            if not len(pdf):
                return pdf[[id_col, *carry]].assign(score=0.0, query_id=0)
        s = V.score_matrix(metric, np.stack(pdf[vector_col].to_numpy()).astype(np.float64), q)
        key = np.round(s, SCORE_DECIMALS)
        key = -key if larger else key
        key = np.where(may, key, np.inf) if masks else key
        near = key <= np.partition(key, k - 1, axis=0)[k - 1] if len(key) > k else np.ones_like(key, bool)
        at, query = np.nonzero(near & may if masks else near)
        return pdf[[id_col, *carry]].iloc[at].reset_index(drop=True).assign(score=s[at, query], query_id=query)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: list[pd.DataFrame] = []
        held, step = 0, max(1, SCORES_AT_ONCE // max(len(q), masks.size if masks else 0))
        for pdf in batches:
            pdf = pdf[pdf[vector_col].notna()]
            for a in range(0, len(pdf), step):
                best.append(best_of(pdf.iloc[a:a + step]))
                held += len(best[-1])
                if held > 8 * k * len(q):
                    best = [_keep_k(pd.concat(best, ignore_index=True), k, larger, id_col)]
                    held = len(best[0])
        if best:
            out = _keep_k(pd.concat(best, ignore_index=True), k, larger, id_col)
            yield out.assign(query_id=qids_s[out["query_id"].to_numpy()])[["query_id", id_col, *carry, "score"]]

    columns = [id_col, vector_col, *carry] + ([tokens.alias("__tokens")] if masks else [])
    return points.select(*columns).mapInPandas(run, out_schema)


class _WordMasks:
    """Which rows have all the words of which query, by one bitmap of a batch's rows for each word that some query has."""

    def __init__(self, words: list[list[str]]):
        self.known = pd.Index(sorted({w for of in words for w in of}))
        self.codes = self.known.get_indexer([w for of in words for w in of])
        self.starts = np.cumsum([0] + [len(of) for of in words[:-1]])
        self.size = len(self.codes)

    def of(self, tokens: pd.Series) -> np.ndarray:
        """Rows by queries; every query has words."""
        lists = [t if t is not None else [] for t in tokens]
        row = np.repeat(np.arange(len(lists)), [len(t) for t in lists])
        code = self.known.get_indexer(np.concatenate([np.asarray(t, object) for t in lists])) if len(row) else np.empty(0, int)
        has = np.zeros((len(self.known), len(lists)), bool)
        has[code[code >= 0], row[code >= 0]] = True
        bitmaps = np.packbits(has, axis=1)
        every = np.bitwise_and.reduceat(bitmaps[self.codes], self.starts, axis=0)
        return np.unpackbits(every, axis=1, count=len(lists)).astype(bool).T


def _keep_k(df: pd.DataFrame, k: int, larger: bool, id_col: str) -> pd.DataFrame:
    """Best k rows per query by (rounded score, id)."""
    r = df["score"].round(SCORE_DECIMALS)
    order = df.assign(__r=-r if larger else r).sort_values(["query_id", "__r", id_col], kind="mergesort")
    return order.groupby("query_id", sort=False).head(k).drop(columns="__r")


RANK_BUCKETS = 256


def rank_per_query(cands: DataFrame, k: int, metric: str, id_col: str = "id",
                   query_col: str = "query_id", buckets: int = RANK_BUCKETS) -> DataFrame:
    """Global top-k per query from candidates; adds ``rank``, rounds ``score``.

    Two-level reduction so no task ever holds all candidates of one query:
    first the best k per (query, bucket of the point id), then the best k per
    query over at most ``buckets * k`` rows. Each level is a ``row_number <= k``
    window, for which Spark also applies a partial group limit before its
    shuffle.
    """
    r = F.round("score", SCORE_DECIMALS)
    order = r.desc() if _larger_is_closer(metric) else r.asc()
    c = cands.withColumn("score", r)
    if buckets and buckets > 1:
        b = F.pmod(F.xxhash64(F.col(id_col)), F.lit(buckets))
        w1 = Window.partitionBy(query_col, b).orderBy(order, F.col(id_col).asc())
        c = c.withColumn("__r1", F.row_number().over(w1)).where(F.col("__r1") <= k).drop("__r1")
    w = Window.partitionBy(query_col).orderBy(order, F.col(id_col).asc())
    return (c.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .withColumn("rank", F.col("rank").cast("int")))


def topk(points: DataFrame, queries: DataFrame, k: int = 10, metric: str = "cosine",
         id_col: str = "id", vector_col: str = "vector", query_id: str = "query_id",
         query_vector: str = "vector", carry: tuple[str, ...] = (),
         max_queries: int = MAX_QUERIES_PER_SCAN) -> DataFrame:
    """Exact top-k per query (O-81 … O-85). Output: query_id, id, carry…, score, rank.

    A zero vector has the cosine 0 to everything. Points without a vector have
    no score; a query without a vector has no hits.
    """
    if metric not in V.METRICS:
        raise ValueError(f"metric must be one of {list(V.METRICS)}")
    queries = queries.select(F.col(query_id).cast("string").alias("query_id"),
                             F.col(query_vector).alias("__qv"))
    return _topk_by_blocks(points, queries, k, metric, id_col, vector_col, carry, max_queries)


def _topk_by_blocks(points: DataFrame, queries: DataFrame, k: int, metric: str, id_col: str, vector_col: str, carry: tuple[str, ...],
                    max_queries: int, tokens: Column | None = None) -> DataFrame:
    """Top-k of ``queries(query_id, __qv)``, by blocks; with ``tokens``, of ``queries(query_id, __qv, __words)`` among points that have the words."""
    words = "__words" if tokens is not None else None
    results = []
    for block in _query_blocks(queries, "query_id", "__qv", max_queries, words):
        rows = _collect_bounded(block, max_queries, "query block")
        rows = [r for r in rows if r["__qv"] is not None]
        if not rows:
            continue
        qmat = np.asarray([list(r["__qv"]) for r in rows], dtype=np.float64)
        cands = _partition_topk(points, [r["query_id"] for r in rows], qmat, k, metric, id_col, vector_col, list(carry),
                                tokens, [list(r[words]) for r in rows] if words else None)
        results.append(rank_per_query(cands, k, metric, id_col))
    if not results:
        schema = points.select(id_col, *carry).schema
        return points.sparkSession.createDataFrame([], T.StructType(
            [T.StructField("query_id", T.StringType())] + list(schema.fields)
            + [T.StructField("score", T.DoubleType()), T.StructField("rank", T.IntegerType())]))
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def filtered_topk(points: DataFrame, queries: DataFrame, condition: Column, **kw) -> DataFrame:
    """Payload filter applied before ranking (O-86); the filter reaches the scan."""
    return topk(points.where(condition), queries, **kw)


def pair_topk(pairs: DataFrame, k: int, metric: str, id_col: str = "id",
              vector_col: str = "vector", query_vector: str = "query_vector") -> DataFrame:
    """Top-k over explicit (query, point) candidate pairs, scored natively."""
    scored = pairs.withColumn("score", V.score(metric, vector_col, query_vector))
    return rank_per_query(scored, k, metric, id_col)


def two_stage(file_points: DataFrame, content_points: DataFrame, queries: DataFrame,
              k_files: int = 5, k_chunks: int = 5, metric: str = "cosine",
              file_col: str = "filename", page_col: str = "page_number",
              max_queries: int = MAX_QUERIES_PER_SCAN, salts: int = 16) -> DataFrame:
    """Stage 1: top files by name vector; stage 2: top chunks within them (O-90).

    Stage 1 is written to the shared scratch folder as (query, file) rows and joined
    with the content points on the file, salted by point id, so a file with a third
    of all points is dealt over ``salts`` tasks. Points of files that no query found
    are dropped by a semi-join on the files alone before any vector is shuffled.
    Output: query_id, id, filename, page_number, score, rank.
    """
    import uuid

    from corpusflow.session import scratch_path
    spark = queries.sparkSession
    qs = queries.select(F.col("query_id").cast("string").alias("query_id"), F.col("vector"))
    first = topk(file_points, qs, k_files, metric, carry=(file_col,), max_queries=max_queries).select("query_id", file_col)
    path = scratch_path(spark, f"stage1-{uuid.uuid4().hex}")
    first.distinct().write.parquet(path)
    files = spark.read.schema(first.schema).parquet(path)
    asked = (files.join(qs.withColumnRenamed("vector", "query_vector"), "query_id")
             .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    points = (content_points.select("id", "vector", file_col, page_col).join(files.select(file_col).distinct(), file_col, "left_semi")
              .withColumn("__salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int")))
    pairs = points.where("vector is not null").join(asked, [file_col, "__salt"])
    return pair_topk(pairs, k_chunks, metric).select("query_id", "id", file_col, page_col, "score", "rank")


def context_window(hits: DataFrame, content_points: DataFrame, window: int,
                   file_col: str = "filename", page_col: str = "page_number",
                   text_col: str = "pagecontent", hit_keys: tuple[str, ...] = ("query_id", "rank"),
                   sep: str = "\n\n") -> DataFrame:
    """Pages ``[c-w, c+w]`` around each hit, combined in page order (O-91).

    Each hit expands to its 2w+1 wanted pages, then an equi-join on
    (file, page) fetches them — no range join, no scan per hit.
    """
    want = hits.select(*hit_keys, file_col, F.col(page_col).alias("center_page"), "score",
                       F.explode(F.sequence(F.col(page_col) - window, F.col(page_col) + window)).alias(page_col))
    pages = content_points.select(file_col, page_col, text_col)
    got = want.join(pages, [file_col, page_col])
    agg = got.groupBy(*hit_keys, file_col, "center_page", "score").agg(
        F.array_sort(F.collect_list(F.struct(F.col(page_col), F.col(text_col)))).alias("__p"))
    return agg.select(*hit_keys, file_col, "score", "center_page",
                      F.array_join(F.transform("__p", lambda x: x[text_col]), sep).alias("combined_page"),
                      F.transform("__p", lambda x: x[page_col]).alias("page_numbers"))


def keyword_search(points: DataFrame, queries: DataFrame, field: str, query_text: str = "text",
                   query_id: str = "query_id", id_col: str = "id", mode: str = "prefix",
                   min_len: int = 1, max_len: int | None = None) -> DataFrame:
    """All query tokens present among the field's tokens (O-74, O-88).

    ``mode='prefix'`` matches a query token against every prefix of the
    field's words (partial match), ``'word'`` needs whole words. Case is
    folded. A query token outside the length bounds (none above by default)
    is in no posting list, so its query has no hits. The field is tokenised once, into
    postings in the shared scratch folder; with an index written before, use
    ``text_index.token_search`` on it.
    """
    import uuid

    from corpusflow.operators import text_index as TI
    from corpusflow.session import scratch_path
    path = scratch_path(points.sparkSession, f"postings-{uuid.uuid4().hex}")
    TI.token_rows(points, id_col, field, mode, min_len, max_len).write.parquet(path)  # read once, so not clustered
    return TI.token_search(points.sparkSession, path, queries.select(F.col(query_id).alias("query_id"), F.col(query_text).alias("text")), id_col)


def hybrid_search(points: DataFrame, queries: DataFrame, field: str, k: int = 10,
                  metric: str = "cosine", id_col: str = "id", mode: str = "prefix",
                  carry: tuple[str, ...] = (), max_queries: int = MAX_QUERIES_PER_SCAN) -> DataFrame:
    """Text filter, then vector rank (O-89): a query's points are those whose ``field`` has all its words.

    ``queries`` has ``query_id, text, vector``. The words are matched as in ``keyword_search``, within the scoring
    scan: for each batch of points there is one bitmap per word of the block's queries, and a query's mask is the
    intersection of its words' bitmaps. Only each partition's best ``k`` of a query leave the scan, so no
    (query, point) pair is formed before the top-k, however frequent a word is. Points without a field or a vector
    and queries without a word or a vector have no hits; the reference documents no fusion formula.
    """
    if metric not in V.METRICS:
        raise ValueError(f"metric must be one of {list(V.METRICS)}")
    words = F.array_distinct(TX.normalise_tokens(TX.word_tokens("text")))
    asked = (queries.select(F.col("query_id").cast("string").alias("query_id"), F.col("vector").alias("__qv"), words.alias("__words"))
             .where("__qv is not null and size(__words) > 0"))
    tokens = TX.prefix_tokens(field) if mode == "prefix" else TX.normalise_tokens(TX.word_tokens(field))
    return _topk_by_blocks(points, asked, k, metric, id_col, "vector", carry, max_queries, F.array_distinct(tokens))
