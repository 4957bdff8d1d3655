"""Whole jobs (O-106 … O-109) as DataFrame plans.

Each job is a function of input DataFrames returning output DataFrames;
``ingest_run`` persists runs. Cheap membership tests (ledger anti joins,
dedup decision) are placed *before* chunking and the embedder, because
Catalyst cannot push a join below a Python stage.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.functions import hashing as H
from corpusflow.functions import paths as P
from corpusflow.operators import chunking as CH
from corpusflow.operators import convert as CV
from corpusflow.operators import dedup as DD
from corpusflow.operators import embedding as EM
from corpusflow.operators import points as PT
from corpusflow.operators import reports as RP


# Fixed value: failure stage name for files whose points could not be written.
UPLOAD_STAGE = "qdrant"


class IngestOutputs:
    """Outputs of one ingest plan, built lazily: a caller that reads only the
    decisions never builds the chunk, embedding or point plans."""

    def __init__(self, decisions: DataFrame, todo: DataFrame, collection: str, embed, filename_embed,
                 chunk_tokens: int, overlap_tokens: int, batch_size: int, min_partitions, model_name: str, id_scope: str = "name"):
        self.decisions = decisions
        self._todo = todo
        self._args = (collection, embed, filename_embed, chunk_tokens, overlap_tokens, batch_size,
                      min_partitions, model_name)
        self._scope = id_scope

    @cached_property
    def chunks(self) -> DataFrame:
        _c, _e, _fe, size, overlap, _b, minp, _m = self._args
        return CH.chunk_documents(self._todo.withColumnRenamed("hash", "file_hash"), keep=("key", "file_hash"),
                                  chunk_tokens=size, overlap_tokens=overlap, min_partitions=minp)

    @cached_property
    def embedded(self) -> DataFrame:
        embed, batch = self._args[1], self._args[5]
        return EM.batch_embed(self.chunks, embed, keep=("key", "filename", "file_hash", "chunk_number", "text",
                                                        "element_type", "md5_hash", "n_tokens"), batch_size=batch)

    @cached_property
    def content_points(self) -> DataFrame:
        return PT.content_points(self.embedded, file_hash_col="file_hash", id_scope=self._scope)

    @cached_property
    def filename_points(self) -> DataFrame:
        names = EM.batch_embed(self._todo.select("key", "hash", "filename"), self._args[2], text_col="filename",
                               keep=("key", "hash"), batch_size=self._args[5])
        return PT.filename_points(names, "key", hash_col="hash", vector_col="vector", id_scope=self._scope)

    @cached_property
    def embedding_rows(self) -> DataFrame:
        return EM.embedding_ledger_rows(self.embedded, "key", "file_hash", self._args[0], self._args[7])

    @cached_property
    def skipped_rows(self) -> DataFrame:
        return DD.skip_rows(self.decisions, key_col="key")

    @cached_property
    def failed_rows(self) -> DataFrame:
        with_vec = self.embedded.where(F.col("vector").isNotNull()).select("key").distinct()
        return (self.chunks.select("key").distinct().join(with_vec, "key", "left_anti")
                .select(F.col("key").alias("filename"), F.lit("no valid embeddings").alias("error"),
                        F.lit(UPLOAD_STAGE).alias("stage")))


def full_ingest(files: DataFrame, upload_ledger: DataFrame, embedding_ledger: DataFrame,
                resident: DataFrame | None, embed=None, filename_embed=None,
                collection: str = "content", chunk_tokens: int = CH.DEFAULT_CHUNK_TOKENS,
                overlap_tokens: int = CH.DEFAULT_OVERLAP_TOKENS, force: bool = False,
                batch_size: int = EM.DEFAULT_BATCH_SIZE, min_partitions: int | None = None,
                model_name: str = "hashing-64", id_scope: str = "name") -> IngestOutputs:
    """List -> anti join -> convert -> dedup -> chunk -> embed -> points (O-106).

    ``files``: key, text (markdown or plain text; binary inputs go through
    ``convert.convert_with`` first). Files already in the upload ledger are
    skipped unless ``force`` (trap T-01: the upload ledger decides).
    """
    embed = embed or EM.HashingEmbedder(64)
    filename_embed = filename_embed or EM.HashingEmbedder(32)
    # decided on keys and hashes alone: no text goes through an exchange keyed by a hash that many files may share
    f = files.select(F.col("key"), H.text_md5("text").alias("hash"))
    if not force:
        done = upload_ledger.select(F.col("hash").alias("__h")).where(F.col("__h").isNotNull()).distinct()
        f = f.join(done, f["hash"] == done["__h"], "left_anti")
    f = f.withColumn("filename", P.basename("key"))
    dec = DD.dedup_decision(f, embedding_ledger, resident, key_col="key", collection=collection, force=force)
    spark = files.sparkSession
    spread = min_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    # a file is its key and content, so equal keys keep their own texts; a broadcast join leaves the rows where
    # the scan put them, so they are dealt out before the heavy steps
    wanted = dec.where(F.col("action") == "process").select("key", "hash").distinct()
    todo = (files.select("key", "text", H.text_md5("text").alias("hash")).join(wanted, ["key", "hash"], "left_semi")
            .select("key", P.basename("key").alias("filename"), "hash", "text").repartition(spread))
    return IngestOutputs(dec, todo, collection, embed, filename_embed, chunk_tokens, overlap_tokens,
                         batch_size, min_partitions, model_name, id_scope)


def convert_only(pages: DataFrame, key_col: str = "key", html_col: str = "html",
                 source_prefix: str = "source", markdown_prefix: str = "markdown") -> tuple[DataFrame, DataFrame]:
    """Pipeline A (O-107): convert, mirror keys; returns (markdown rows, failed rows)."""
    conv = CV.convert_pages(pages, html_col, (key_col,))
    ok = conv.where(F.col("markdown").isNotNull()).select(
        P.mirrored_key(key_col, source_prefix, markdown_prefix).alias("markdown_key"),
        F.col(key_col).alias("source_key"), F.col("markdown").alias("text"))
    failed = CV.failed_rows(conv, key_col)
    return ok, failed


def markdown_to_points(markdown: DataFrame, embedding_ledger: DataFrame, resident: DataFrame | None,
                       embed=None, collection: str = "content", force: bool = False,
                       chunk_tokens: int = CH.DEFAULT_CHUNK_TOKENS, min_partitions: int | None = None) -> IngestOutputs:
    """Pipeline B (O-108): markdown store -> '.md' keys -> original names -> points.

    The restored key keeps the directory of the markdown key, and ids follow the key,
    so equal base names in two directories stay two files.
    """
    md = markdown.where(P.is_markdown("key"))
    restored = F.concat(F.lit("restored/"), F.regexp_replace("key", "[^/]*$", ""), P.original_name("key"))
    files = md.select(restored.alias("key"), "text")
    empty_upload = embedding_ledger.sparkSession.createDataFrame([], "hash string")
    return full_ingest(files, empty_upload, embedding_ledger, resident, embed=embed, collection=collection,
                       force=force, chunk_tokens=chunk_tokens, min_partitions=min_partitions, id_scope="key")


def retry_failed(failed: DataFrame, source_files: DataFrame, markdown: DataFrame, embedding_ledger: DataFrame,
                 resident: DataFrame | None, embed=None, min_partitions: int | None = None):
    """O-109: locate each failed name, re-run the matching pipeline with force,
    and return (points, remaining failed rows, summary).

    The points are written to the shared scratch folder once, so the embedder runs
    once for all three results.
    """
    import uuid

    from corpusflow.session import scratch_path
    spark = failed.sparkSession
    work = RP.retry_worklist(failed, source_files.select("key"), markdown.select("key"))
    src = work.where(F.col("type") == "source").select(F.col("found_key").alias("key")).distinct() \
        .join(source_files.select("key", "text"), "key")
    mdk = work.where(F.col("type") == "markdown").select(F.col("found_key").alias("key")).distinct() \
        .join(markdown.select("key", "text"), "key")
    empty_upload = embedding_ledger.sparkSession.createDataFrame([], "hash string")
    a = full_ingest(src, empty_upload, embedding_ledger, resident, embed=embed, force=True,
                    min_partitions=min_partitions, id_scope="key")
    b = markdown_to_points(mdk, embedding_ledger, resident, embed=embed, force=True, min_partitions=min_partitions)
    made = a.content_points.unionByName(b.content_points)
    path = scratch_path(spark, f"retried-{uuid.uuid4().hex}")
    made.write.parquet(path)
    points = spark.read.schema(made.schema).parquet(path)
    ok_hashes = points.select(F.col("file_hash").alias("hash")).distinct()
    remaining = RP.clear_resolved(failed, ok_hashes)
    return points, remaining, RP.retry_summary(work, ok_hashes)
