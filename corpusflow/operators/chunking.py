"""Recursive token-bounded chunking (O-27 … O-32) as one linear pass per text.

Definition (the recursive character splitter with a token length function):

* ``level(span, i)`` cuts a span before every non-overlapping occurrence of
  separator ``i`` (the separator stays with the following piece); the last,
  empty separator cuts into characters. Empty pieces are dropped.
* Pieces are scanned left to right. A piece of ``k >= N`` tokens flushes the
  open chunk and is split at the next level. Otherwise, if ``n + k > N`` the
  chunk is flushed and restarted (keeping a tail of at most ``overlap``
  tokens); else the piece joins it, ``n += k``.
* A flush strips ``[ \\t\\n\\r\\f]`` at both ends and drops empties.

An absent separator yields one piece, which either fits or falls through to
the next level — the same result as skipping to the first present separator,
except for a text with no non-empty separator at all: that one is split into
characters at once.

Pieces of a chunk are neighbours, so a chunk is a span of the text and the
state is two positions and a token count; strings are cut out only at a flush.
Separators never cut a token, so tokens are located once per text and a piece's
count is a difference of two ranks. The pass runs in an Arrow function, a megabyte
of text at a time, whose chunks leave the worker before the next; chunking never
shuffles, so it scales with the number of input splits.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from corpusflow.functions import hashing as H
from corpusflow.functions import text as T
from corpusflow.functions._util import col

# The separator order of the reference's splitter, and its
# default chunk size and overlap in tokens.
SEPARATORS = ("\n\n\n", "\n\n", "\n", ". ", " ", "")
DEFAULT_CHUNK_TOKENS = 500
DEFAULT_OVERLAP_TOKENS = 0

_SEPARATORS = [re.compile(re.escape(s)) for s in SEPARATORS[:-1]]
# the token pattern of functions.text in Python's classes: letters and digits are \w without the underscore
_TOKEN = re.compile(r"[^\W_]+|[^ \t\n\r\f\w]|_")
_WS = " \t\n\r\f"


class _Splitter:
    """Chunks of one text as ``(chunk, tokens)``; ``counter`` counts the tokens of a string (None: the default tokens)."""

    def __init__(self, text: str, size: int, overlap: int, counter: Callable[[str], int] | None) -> None:
        self.text, self.size, self.overlap, self.counter = text, size, overlap, counter
        self.starts = [m.start() for m in _TOKEN.finditer(text)] if counter is None else []

    def ranks(self, bounds: list[int], chars: bool) -> list[int]:
        """Tokens before each bound, as the pieces' counts add up."""
        if self.counter is None and not chars:
            return [bisect_left(self.starts, b) for b in bounds]
        out = [0]
        for a, b in zip(bounds, bounds[1:]):
            piece = self.text[a:b]
            out.append(out[-1] + (self.counter(piece) if self.counter else piece not in _WS))
        return out

    def chunk(self, a: int, b: int, n: int | None) -> Iterator[tuple[str, int]]:
        found = self.text[a:b].strip(_WS)
        if found:
            yield found, n if n is not None else self.counter(found) if self.counter else len(_TOKEN.findall(found))

    def split(self, a: int, b: int, level: int) -> Iterator[tuple[str, int]]:
        chars = level == len(_SEPARATORS)
        bounds = list(range(a, b + 1)) if chars else [a, *(m.start() for m in _SEPARATORS[level].finditer(self.text, a, b) if m.start() > a), b]
        rank = self.ranks(bounds, chars)
        # single characters of one token and custom counts do not add up to the chunk's count
        counted = self.counter is None and not chars
        first = 0
        for i in range(len(bounds) - 1):
            k = rank[i + 1] - rank[i]
            if k >= self.size:
                yield from self.chunk(bounds[first], bounds[i], rank[i] - rank[first] if counted else None)
                if chars:
                    yield from self.chunk(bounds[i], bounds[i + 1], None)
                else:
                    yield from self.split(bounds[i], bounds[i + 1], level + 1)
                first = i + 1
            elif rank[i + 1] - rank[first] > self.size and first < i:
                yield from self.chunk(bounds[first], bounds[i], rank[i] - rank[first] if counted else None)
                while rank[i] > rank[first] and (rank[i] - rank[first] > self.overlap or rank[i + 1] - rank[first] > self.size):
                    first += 1
        yield from self.chunk(bounds[first], b, rank[-1] - rank[first] if counted else None)


def split_text(text: str, size: int, overlap: int = 0, counter: Callable[[str], int] | None = None) -> list[tuple[str, int]]:
    """Chunks of ``text`` with their token counts, in order."""
    if not text:
        return []
    plain = not any(s in text for s in SEPARATORS[:-1])
    return list(_Splitter(text, size, overlap, counter).split(0, len(text), len(_SEPARATORS) if plain else 0))


_CHUNK = pa.struct([("t", pa.string()), ("n", pa.int32())])
#: bytes of text cut at once: what a Python worker holds besides the Arrow batch it was sent
BYTES_AT_ONCE = 1 << 20


def slices(column: pa.Array, at_once: int = BYTES_AT_ONCE) -> Iterator[tuple[int, int]]:
    """Bounds of runs of rows whose texts (or bytes) come to about ``at_once`` bytes; a longer one is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    a, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > at_once:
            yield a, i
            a, held = i, 0
        held += size
    if a < len(sizes):
        yield a, len(sizes)


def _split_all(texts: pa.Array, size: int, overlap: int, counter: Callable[[str], int] | None) -> tuple[list, pa.StructArray]:
    """The number of chunks of each text (None for a null text), and all chunks as ``t, n``."""
    counts, found, tokens = [], [], []
    for text in texts:
        text = text.as_py()
        chunks = [] if text is None else split_text(text, size, overlap, counter)
        counts.append(None if text is None else len(chunks))
        found += [c for c, _ in chunks]
        tokens += [n for _, n in chunks]
    return counts, pa.StructArray.from_arrays([pa.array(found, pa.string()), pa.array(tokens, pa.int32())], fields=list(_CHUNK))


def chunk_texts(text, chunk_tokens: int = DEFAULT_CHUNK_TOKENS, overlap_tokens: int = DEFAULT_OVERLAP_TOKENS,
                counter: Callable[[str], int] | None = None) -> Column:
    """array<string> of chunks of ``text`` (O-27, O-28)."""
    return F.transform(chunk_texts_counted(text, chunk_tokens, overlap_tokens, counter), lambda x: x["t"])


def chunk_texts_counted(text, chunk_tokens: int = DEFAULT_CHUNK_TOKENS, overlap_tokens: int = DEFAULT_OVERLAP_TOKENS,
                        counter: Callable[[str], int] | None = None) -> Column:
    """array<struct<t, n>>: chunks with their token counts; null for a null text."""
    if overlap_tokens >= chunk_tokens:
        raise ValueError("overlap must be smaller than the chunk size")

    @F.arrow_udf("array<struct<t:string,n:int>>")
    def chunks(texts: pa.Array) -> pa.Array:
        lists = []
        for a, b in slices(texts):
            counts, found = _split_all(texts.slice(a, b - a), chunk_tokens, overlap_tokens, counter)
            ends = np.cumsum([0] + [c or 0 for c in counts]).astype(np.int32)
            lists.append(pa.ListArray.from_arrays(pa.array(ends, mask=np.array([c is None for c in counts] + [False])), found))
        return pa.concat_arrays(lists) if lists else pa.array([], pa.list_(_CHUNK))

    return chunks(col(text))


# Logical operators after which the data is already spread by a shuffle (or
# whose partition count would need the shuffle to run under AQE).
_SPREADING = {"Join", "Aggregate", "Repartition", "RepartitionByExpression", "RebalancePartitions",
              "Window", "Sort", "Distinct", "Deduplicate", "Union", "Expand", "Intersect", "Except",
              "WindowGroupLimit", "GlobalLimit", "CoGroup", "FlatMapGroupsInPandas", "MapInPandas",
              "MapInArrow", "LocalRelation", "LogicalRDD"}


def _is_bare_scan(df: DataFrame) -> bool:
    """True when the logical plan is only scans, projections, filters, generators."""
    stack = [df._jdf.queryExecution().analyzed()]
    while stack:
        node = stack.pop()
        if node.nodeName() in _SPREADING:
            return False
        children = node.children()
        for i in range(children.size()):
            stack.append(children.apply(i))
    return True


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin spread only when a bare scan has fewer splits than cores.

    Large inputs already arrive in many splits and plans with a shuffle are
    already spread by it, so nothing changes there. Only a bare scan is asked
    for its split count (the logical plan is walked, never planned: asking a
    plan with exchanges for partitions would make AQE run those stages).
    """
    if min_partitions == 0:
        return df
    spark = df.sparkSession
    want = min_partitions or spark.sparkContext.defaultParallelism * 2
    if not _is_bare_scan(df):
        return df
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want)


def chunk_documents(docs: DataFrame, text_col: str = "text", filename_col: str = "filename",
                    chunk_tokens: int = DEFAULT_CHUNK_TOKENS,
                    overlap_tokens: int = DEFAULT_OVERLAP_TOKENS,
                    counter: Callable[[str], int] | None = None,
                    keep: tuple[str, ...] = (),
                    min_partitions: int | None = None) -> DataFrame:
    """One row per chunk: filename, chunk_number (1-based), text, element_type,
    md5_hash, n_tokens, plus the ``keep`` columns (O-27, O-29, O-30, O-31)."""
    if overlap_tokens >= chunk_tokens:
        raise ValueError("overlap must be smaller than the chunk size")
    docs = ensure_parallelism(docs, min_partitions)
    rows = docs.select(*[col(c) for c in keep_cols(keep, filename_col)], col(filename_col).alias("filename"), col(text_col).cast("string").alias("__text"))
    kept = rows.schema.fields[:-1]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for a, b in slices(texts):
                counts, found = _split_all(texts.slice(a, b - a), chunk_tokens, overlap_tokens, counter)
                n = np.array([c or 0 for c in counts], np.int64)
                row = pa.array(np.repeat(np.arange(a, b), n))
                number = np.arange(1, len(row) + 1) - np.repeat(np.cumsum(n) - n, n)
                yield pa.RecordBatch.from_arrays([*(batch.column(i).take(row) for i in range(len(kept))), pa.array(number, pa.int32()),
                                                  found.field(0), found.field(1)], names=[*(f.name for f in kept), "chunk_number", "text", "n_tokens"])

    made = ST.StructType([*kept, ST.StructField("chunk_number", ST.IntegerType()), ST.StructField("text", ST.StringType()),
                          ST.StructField("n_tokens", ST.IntegerType())])
    return rows.mapInArrow(cut, made).select(
        *keep_cols(keep, filename_col), "filename", "chunk_number", "text",
        T.element_type("text").alias("element_type"),
        H.text_md5("text").alias("md5_hash"),
        "n_tokens",
    )


def keep_cols(keep, filename_col):
    return [c for c in keep if c != filename_col]


def chunk_record(chunks: DataFrame) -> DataFrame:
    """Nested chunk record: text + metadata struct with page_number (O-31)."""
    return chunks.select(
        "text",
        F.struct(
            F.col("filename").alias("filename"),
            F.col("chunk_number").alias("page_number"),
            F.col("element_type").alias("element_type"),
            F.col("md5_hash").alias("md5_hash"),
        ).alias("metadata"),
    )


def chunk_stats(chunks: DataFrame, files: DataFrame | None = None,
                filename_col: str = "filename") -> DataFrame:
    """Per file: total chunks, avg/min/max tokens and per-type counts (O-32).

    One grouped pass with conditional counts (one column per element type);
    files without chunks get zeros when ``files`` is given.
    """
    agg = chunks.groupBy(filename_col).agg(
        F.count(F.lit(1)).cast("bigint").alias("total_chunks"),
        F.avg("n_tokens").alias("avg_tokens"),
        F.min("n_tokens").cast("bigint").alias("min_tokens"),
        F.max("n_tokens").cast("bigint").alias("max_tokens"),
        F.sum("n_tokens").cast("bigint").alias("sum_tokens"),
        *[F.count_if(F.col("element_type") == t).cast("bigint").alias(f"n_{t.lower()}")
          for t in T.ELEMENT_TYPES],
    )
    if files is None:
        return agg
    zero_cols = ["total_chunks", "min_tokens", "max_tokens", "sum_tokens"] + [f"n_{t.lower()}" for t in T.ELEMENT_TYPES]
    out = files.select(filename_col).join(agg, filename_col, "left")
    return out.fillna(0, subset=zero_cols + ["avg_tokens"])
