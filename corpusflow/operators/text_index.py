"""Inverted text index as tables (O-38), and searches on it (O-75, O-88).

Postings stay in long format ``(token, id, tf, first_pos)``: a token that
occurs in every document is many rows spread over many partitions, never one
collected list. The per-token summary is a grouped count with map-side
partial aggregation. Postings are written clustered by token, so that a lookup of
tokens reads the pages that may hold them only: the tokens of the queries and their hashes
are a pushed filter of the scan. A search never tokenises the indexed texts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.functions import text as TX
from corpusflow.operators.chunking import ensure_parallelism
from corpusflow.session import scratch_path


def postings(df: DataFrame, id_col: str, field: str, tokenizer: str = "word",
             min_len: int = 1, max_len: int | None = None, lowercase: bool = True) -> DataFrame:
    """(token, id, tf, first_pos) for every token of every row."""
    df = ensure_parallelism(df)
    toks = TX.TOKENIZERS[tokenizer](field)
    if lowercase:
        toks = F.transform(toks, lambda t: F.lower(t))
    pos = df.select(id_col, F.posexplode(toks).alias("pos", "token"))
    pos = pos.where(F.length("token") >= min_len)
    if max_len is not None:
        pos = pos.where(F.length("token") <= max_len)
    return pos.groupBy("token", id_col).agg(
        F.count(F.lit(1)).cast("bigint").alias("tf"), F.min("pos").cast("int").alias("first_pos"))


def token_summary(post: DataFrame, id_col: str) -> DataFrame:
    """(token, doc_freq, total_freq)."""
    return post.groupBy("token").agg(
        F.count(id_col).cast("bigint").alias("doc_freq"), F.sum("tf").cast("bigint").alias("total_freq"))


def token_rows(df: DataFrame, id_col: str, field: str, mode: str = "prefix", min_len: int = 1, max_len: int | None = None) -> DataFrame:
    """``token, id`` once each: the field's words, or all prefixes of them, lower-cased."""
    tokens = TX.prefix_tokens(field, min_len, max_len) if mode == "prefix" else TX.normalise_tokens(TX.word_tokens(field), min_len, max_len)
    return ensure_parallelism(df).select(F.explode(F.array_distinct(tokens)).alias("token"), id_col)


def position_rows(df: DataFrame, id_col: str, field: str, lowercase: bool = True) -> DataFrame:
    """``token, id, pos`` for every word of every row."""
    tokens = TX.word_tokens(field)
    tokens = F.transform(tokens, lambda t: F.lower(t)) if lowercase else tokens
    return ensure_parallelism(df).select(id_col, F.posexplode(tokens).alias("pos", "token")).select("token", id_col, "pos")


def write_index(rows: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write rows with a ``token`` as segments, each in the order of ``token_hash``: a lookup reads the pages of a segment that may hold its tokens.

    A segment is what one task makes of its texts, so texts are tokenised once, no row is
    exchanged and a frequent token is dealt out as the texts are. With ``partitions`` there
    are that many segments, which are ranges: they split at tokens and, within a frequent token, at the next column.
    One long is sorted with far fewer comparisons of rows than words are.
    """
    rows = rows.withColumn("token_hash", F.xxhash64("token"))
    out = rows.repartitionByRange(partitions, "token_hash", next(c for c in rows.columns if c != "token")) if partitions else rows
    out.sortWithinPartitions("token_hash").write.mode("overwrite").parquet(path)


#: tokens that become a filter of the scan; more are joined
TOKENS_AT_ONCE = 10_000


def lookup(spark, path: str, tokens: DataFrame) -> DataFrame:
    """The index rows of the given tokens: a pushed filter for ``TOKENS_AT_ONCE`` tokens at most, a semi-join for more.

    An index that ``write_index`` wrote is asked for the tokens' hashes first.
    """
    index, tokens = spark.read.parquet(path), tokens.select("token").distinct()
    asked = tokens.select("token", F.xxhash64("token").alias("hash")).limit(TOKENS_AT_ONCE + 1).collect()
    if len(asked) > TOKENS_AT_ONCE:
        return index.drop("token_hash").join(tokens, "token", "left_semi")
    if "token_hash" in index.columns:
        index = index.where(F.col("token_hash").isin(sorted(r["hash"] for r in asked))).drop("token_hash")
    return index.where(F.col("token").isin(sorted(r["token"] for r in asked)))


def _found(spark, path: str, tokens: DataFrame) -> DataFrame:
    """The rows of ``lookup`` in the shared scratch folder: a search reads them three times and the index once."""
    found, to = lookup(spark, path, tokens), scratch_path(spark, f"found-{uuid.uuid4().hex}")
    found.write.parquet(to)
    return spark.read.schema(found.schema).parquet(to)


def token_search(spark, path: str, queries: DataFrame, id_col: str = "id") -> DataFrame:
    """``query_id, id`` of the rows that have all words of ``queries(query_id, text)`` among their tokens.

    A query is driven by its rarest word: candidates come from that word's rows only,
    and each other word is looked up by (token, id), so a word that every row has never
    pairs all rows with a query. A query without words has no hits.
    """
    words = F.array_distinct(TX.normalise_tokens(TX.word_tokens("text")))
    asked = queries.select("query_id", words.alias("words")).distinct()
    tokens = asked.select("query_id", F.size("words").alias("n"), F.explode("words").alias("token"))
    rows = _found(spark, path, tokens)
    often = rows.groupBy("token").agg(F.count("*").alias("often"))
    rarest = (tokens.join(often, "token").groupBy("query_id", "n")
              .agg(F.min_by("token", F.struct("often", "token")).alias("token"), F.count("*").alias("known")).where("known = n"))
    found = rows.join(rarest.select("query_id", "n", "token"), "token").select("query_id", "n", id_col, F.col("token").alias("rarest"))
    others = found.where("n > 1").join(tokens.select("query_id", "token"), "query_id").where("token <> rarest")
    whole = (others.join(rows, ["token", id_col]).groupBy("query_id", "n", id_col).agg(F.count("*").alias("hits")).where("hits = n - 1"))
    return found.where("n = 1").select("query_id", id_col).unionByName(whole.select("query_id", id_col))


def phrase_search(spark, path: str, phrases: DataFrame, id_col: str = "id", lowercase: bool = True) -> DataFrame:
    """``phrase_id, id`` of the rows that hold the words of ``phrases(phrase_id, phrase)`` one after the other.

    ``path`` has ``position_rows``. A phrase starts at its rarest word's places; each of
    its other words is looked up at the place that follows from there. A phrase
    without words has no hits.
    """
    words = TX.word_tokens("phrase")
    words = F.transform(words, lambda t: F.lower(t)) if lowercase else words
    tokens = (phrases.select("phrase_id", words.alias("words")).distinct()
              .select("phrase_id", F.size("words").alias("n"), F.posexplode("words").alias("offset", "token")))
    rows = _found(spark, path, tokens)
    often = rows.groupBy("token").agg(F.count("*").alias("often"))
    rarest = (tokens.join(often, "token").groupBy("phrase_id", "n")
              .agg(F.min_by(F.struct("token", "offset"), F.struct("often", "offset")).alias("r"), F.count("*").alias("known")).where("known = n"))
    starts = (rows.join(rarest.select("phrase_id", "n", F.col("r.token").alias("token"), F.col("r.offset").alias("offset")), "token")
              .select("phrase_id", "n", id_col, (F.col("pos") - F.col("offset")).alias("start")))
    places = (starts.join(tokens.select("phrase_id", "offset", "token"), "phrase_id")
              .select("phrase_id", "n", id_col, "start", "token", (F.col("start") + F.col("offset")).alias("pos")))
    return (places.join(rows, ["token", id_col, "pos"]).groupBy("phrase_id", "n", id_col, "start").agg(F.count("*").alias("hits"))
            .where("hits = n").select("phrase_id", id_col).distinct())
