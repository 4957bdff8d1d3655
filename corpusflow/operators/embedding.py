"""Embedding (O-50 … O-58).

The embedder is a plug-in: any ``embed(list[str]) -> list[list[float] | None]``.
``batch_embed`` runs it inside ``mapInArrow`` over Arrow batches, in slices
of ``batch_size`` texts per call, with per-row fallback and retries, so a
failing slice never fails the task and the output stays aligned with the
input. Spark's task retry covers executor loss; ids are deterministic so a
re-run produces the same rows.

``HashingEmbedder`` and ``hashing_vectors`` are the offline stand-in model: word
tokens -> MD5 bucket -> counts -> L2 normalised. ``hashing_buckets`` is the same as
native expressions (no Python), in long format.
"""

from __future__ import annotations

import hashlib
import re
import time
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions import text as TX

EmbedFn = Callable[[list[str]], list]

# Known model dimensions, the override-free default and the
# default slice size of embedding calls and upserts.
MODEL_DIMENSIONS = {
    "granite-embedding:30m": 384,
    "bge-m3": 1024,
    "all-minilm": 384,
    "nomic-embed-text": 768,
    "mxbai-embed-large": 1024,
}
DEFAULT_DIMENSION = 768
DEFAULT_BATCH_SIZE = 100
RETRY_ATTEMPTS = 3
RETRY_MIN_WAIT = 2.0
RETRY_MAX_WAIT = 10.0


def model_dimension(model: str, override: int | None = None) -> int:
    if override:
        return override
    for name, dim in MODEL_DIMENSIONS.items():
        if name in model:
            return dim
    return DEFAULT_DIMENSION


class _Buckets(dict):
    """The bucket of a word as it is written, by its lower-cased form; a full cache is emptied, so a worker's memory stays bounded."""

    CACHE = 300_000

    def __init__(self, dim: int) -> None:
        super().__init__()
        self.dim = dim

    def __missing__(self, word: str) -> int:
        bucket = int.from_bytes(hashlib.md5(word.lower().encode("utf-8")).digest()[:4], "big") % self.dim
        if len(self) >= self.CACHE:
            self.clear()
        self[word] = bucket
        return bucket


_LATIN_WORD = re.compile(r"[^\W_]+")


class HashingEmbedder:
    """Offline model stand-in, equal to ``hashing_vectors`` row by row."""

    def __init__(self, dim: int = 64):
        import regex
        self.dim = dim
        self._word = regex.compile(TX.WORD_PATTERN)
        self._buckets = _Buckets(dim)

    def words(self, text: str) -> list[str]:
        """The words of a text, by Python's own patterns if it is Latin-1, where both are the same."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self._word.findall(text)
        return _LATIN_WORD.findall(text)

    def counts(self, texts: list[str]) -> np.ndarray:
        """Words in each bucket, texts by buckets."""
        bucket = self._buckets.__getitem__
        found = [list(map(bucket, self.words(t))) if t else [] for t in texts]
        row = np.repeat(np.arange(len(found)), [len(x) for x in found])
        at = row * self.dim + np.fromiter(chain.from_iterable(found), np.int64, len(row))
        return np.bincount(at, minlength=len(found) * self.dim).reshape(len(found), self.dim)

    def __call__(self, texts: list[str]) -> list:
        v = self.counts(texts).astype(np.float64)
        n = np.sqrt((v * v).sum(axis=1, keepdims=True))
        v = np.divide(v, n, out=v, where=n > 0).astype(np.float32).tolist()
        return [None if t is None else x for t, x in zip(texts, v)]


def _embed_slice(fn: EmbedFn, texts: list[str], attempts: int, min_wait: float,
                 max_wait: float) -> tuple[list, list]:
    """One call for the slice; on failure or a length mismatch, each row alone with retries."""
    try:
        res = fn(texts)
        if res is not None and len(res) == len(texts):
            return list(res), [None if v is not None else "embedder returned null" for v in res]
        err = "length mismatch"
    except Exception as e:  # noqa: BLE001 - plug-in failure becomes a row error
        err = f"{type(e).__name__}: {e}"
    vecs, errs = [], []
    for t in texts:
        vec, last = None, err
        for a in range(attempts):
            try:
                r = fn([t])
                if r is not None and len(r) == 1 and r[0] is not None:
                    vec, last = r[0], None
                    break
                last = "embedder returned null"
            except Exception as e:  # noqa: BLE001
                last = f"{type(e).__name__}: {e}"
            if a + 1 < attempts and max_wait > 0:
                time.sleep(min(max_wait, min_wait * (2 ** a)))
        vecs.append(vec)
        errs.append(last)
    return vecs, errs


def batch_embed(df: DataFrame, embed: EmbedFn, text_col: str = "text",
                keep: tuple[str, ...] = (), batch_size: int = DEFAULT_BATCH_SIZE,
                out_col: str = "vector", attempts: int = RETRY_ATTEMPTS,
                min_wait: float = RETRY_MIN_WAIT, max_wait: float = RETRY_MAX_WAIT) -> DataFrame:
    """Attach vectors to texts in slices of ``batch_size`` (O-50, O-51, O-52).

    Output: ``keep`` columns, ``out_col`` (array<float>, null on failure),
    ``embed_error`` (string, null on success) and ``embed_seconds``.
    """
    keep = tuple(c for c in keep if c != text_col) + ((text_col,) if text_col in keep else ())
    cols = list(dict.fromkeys([*keep, text_col]))
    in_schema = df.select(*cols).schema
    out_schema = T.StructType(
        [f for f in in_schema.fields if f.name in keep]
        + [T.StructField(out_col, T.ArrayType(T.FloatType()), True),
           T.StructField("embed_error", T.StringType(), True),
           T.StructField("embed_seconds", T.DoubleType(), True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # each slice leaves the worker before the next one's texts become Python strings
            for s in range(0, batch.num_rows, batch_size):
                part = batch.slice(s, batch_size)
                t0 = time.perf_counter()
                vecs, errs = _embed_slice(embed, part.column(cols.index(text_col)).to_pylist(), attempts, min_wait, max_wait)
                seconds = (time.perf_counter() - t0) / max(1, len(vecs))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(cols.index(c)) for c in keep),
                     pa.array([None if v is None else np.asarray(v, dtype=np.float32) for v in vecs], pa.list_(pa.float32())),
                     pa.array(errs, pa.string()), pa.array([seconds] * len(vecs), pa.float64())], names=out_schema.names)

    from corpusflow.operators.chunking import ensure_parallelism
    return ensure_parallelism(df.select(*cols)).mapInArrow(run, out_schema)


def hashing_buckets(df: DataFrame, id_cols: list[str], text_col: str = "text", dim: int = 64) -> DataFrame:
    """Long-format hashing vectors: ``id_cols, bucket, weight`` (O-58).

    Tokens are exploded, counted per (id, bucket) with map-side partial
    aggregation, and normalised by a window over one id (at most ``dim`` rows).
    """
    from corpusflow.operators.chunking import ensure_parallelism
    df = ensure_parallelism(df)
    toks = df.select(*id_cols, F.explode(F.transform(TX.word_tokens(text_col), lambda t: F.lower(t))).alias("tok"))
    bucket = (F.conv(F.substring(F.md5(F.encode("tok", "UTF-8")), 1, 8), 16, 10).cast("bigint") % dim).cast("int")
    counts = toks.groupBy(*id_cols, bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("cnt"))
    from pyspark.sql import Window
    w = Window.partitionBy(*id_cols)
    return counts.select(*id_cols, "bucket",
                         (F.col("cnt") / F.sqrt(F.sum(F.col("cnt") * F.col("cnt")).over(w))).alias("weight"))


def dense_vectors(buckets: DataFrame, id_cols: list[str], dim: int, out_col: str = "vector") -> DataFrame:
    """Long (id, bucket, weight) -> dense array<double> of length ``dim``."""
    m = buckets.groupBy(*id_cols).agg(
        F.map_from_entries(F.collect_list(F.struct("bucket", "weight"))).alias("__m"))
    vec = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)),
                      lambda i: F.coalesce(F.element_at(F.col("__m"), i), F.lit(0.0)).cast("double"))
    return m.select(*id_cols, vec.alias(out_col))


def hashing_vectors(df: DataFrame, id_cols: list[str], text_col: str = "text", dim: int = 64,
                    out_col: str = "vector") -> DataFrame:
    """Dense hashing vectors of all rows with a word, one for each id: the words of rows of one id count together.

    A row's words are counted where it lies, so that one row of ``dim`` counts and not each word
    or bucket goes through the exchange that adds up the rows of an id. Vectors of
    more than ``WIDEST`` values are made of the long format.
    """
    if dim > WIDEST:
        return dense_vectors(hashing_buckets(df, id_cols, text_col, dim), id_cols, dim, out_col)
    counts = bucket_counts(df, id_cols, text_col, dim).groupBy(*id_cols).agg(
        *[F.sum(F.get("__counts", F.lit(i))).alias(f"__n{i}") for i in range(dim)])
    norm = F.sqrt(reduce(add, [F.col(f"__n{i}") * F.col(f"__n{i}") for i in range(dim)]))
    return (counts.withColumn("__norm", norm)
            .select(*id_cols, F.array(*[F.col(f"__n{i}") / F.col("__norm") for i in range(dim)]).alias(out_col)))


#: counts that one aggregation holds as columns
WIDEST = 128


def bucket_counts(df: DataFrame, id_cols: list[str], text_col: str = "text", dim: int = 64) -> DataFrame:
    """``id_cols, __counts`` (array<int>, words in each bucket) of every row with a word."""
    from corpusflow.operators.chunking import ensure_parallelism, slices
    rows = ensure_parallelism(df).select(*id_cols, F.col(text_col).cast("string").alias("__text")).where("__text <> ''")
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("__counts", T.ArrayType(T.IntegerType()))])
    embedder = HashingEmbedder(dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(len(id_cols))):
                part = batch.slice(a, b - a)
                counts = embedder.counts(part.column(len(id_cols)).to_pylist())
                kept = np.nonzero(counts.any(axis=1))[0]
                flat = pa.array(counts[kept].ravel(), pa.int32())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(kept) + 1) * dim, pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([*(part.column(i).take(pa.array(kept)) for i in range(len(id_cols))), lists], names=schema.names)

    return rows.mapInArrow(run, schema)


def attach_precomputed(df: DataFrame, vectors: DataFrame, key: str | list[str],
                       vector_col: str = "vector") -> DataFrame:
    """Left join of stored vectors; unmatched rows get null = embedding failure (O-57)."""
    keys = [key] if isinstance(key, str) else key
    return df.join(vectors.select(*keys, vector_col), keys, "left")


def dimension_check(df: DataFrame, vector_col: str, expected: int) -> DataFrame:
    """count, wrong-size count, min and max vector size (O-55)."""
    size = F.size(vector_col)
    return df.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_vectors"),
        F.count_if(F.col(vector_col).isNull() | (size != expected)).cast("bigint").alias("n_wrong"),
        F.min(size).cast("int").alias("min_dim"),
        F.max(size).cast("int").alias("max_dim"),
        F.lit(expected).cast("int").alias("expected_dim"),
    )


def require_dimension(df: DataFrame, vector_col: str, expected: int) -> DataFrame:
    """Hard failure before a write when any vector has the wrong size."""
    size = F.size(vector_col)
    return df.withColumn(vector_col, F.when(
        size == expected, F.col(vector_col)).otherwise(
        F.raise_error(F.concat(F.lit(f"vector size != {expected}: "), size.cast("string")))))


def embedding_ledger_rows(embedded: DataFrame, filename_col: str, hash_col: str,
                          collection: str, model: str) -> DataFrame:
    """One ledger row per file and collection (O-56): chunks, seconds (3 decimals)."""
    return (embedded.groupBy(filename_col, hash_col)
            .agg(F.count(F.lit(1)).cast("int").alias("chunks_created"),
                 F.round(F.sum("embed_seconds"), 3).alias("embedding_time_seconds"),
                 F.count_if(F.col("embed_error").isNotNull()).alias("__failed"))
            .select(F.current_timestamp().alias("timestamp"), F.col(filename_col).alias("filename"),
                    F.col(hash_col).alias("md5_hash"), F.lit(collection).alias("collection_name"),
                    "chunks_created", "embedding_time_seconds", F.lit(model).alias("model_name"),
                    F.when(F.col("__failed") == 0, "success").otherwise("partial").alias("status")))
