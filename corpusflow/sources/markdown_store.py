"""Markdown corpus as a table (O-12, O-13).

Rows ``markdown_key, source_key, text`` stored as Parquet partitioned by the
top directory of the key, written with dynamic partition overwrite so a run
only rewrites the directories it touches. Documents of those directories that
the run did not produce stay: stored and new rows are merged by key first.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions import paths as P
from corpusflow.session import remove_path, scratch_path
from corpusflow.sources.ledgers import _exists


def write_markdown(df: DataFrame, path: str, key: str = "markdown_key") -> None:
    """Write (markdown_key, source_key, text), partitioned by top directory (O-12)."""
    out = df.select(F.col(key).alias("markdown_key"), "source_key", "text",
                    F.coalesce(P.top_directory(key), F.lit("_root")).alias("top_dir")).dropDuplicates(["markdown_key"])
    spark = df.sparkSession
    staged = None
    if _exists(spark, path):
        old = spark.read.parquet(path)
        kept = (old.join(out.select("top_dir").distinct(), "top_dir", "left_semi")
                .join(out.select("markdown_key"), "markdown_key", "left_anti"))
        staged = scratch_path(spark, f"markdown-{uuid.uuid4().hex}")  # the folders read here are replaced below
        out.unionByName(kept.select(*out.columns)).write.parquet(staged)
        out = spark.read.parquet(staged)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("top_dir").parquet(path))
    if staged:
        remove_path(spark, staged)


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    if not _exists(spark, path):
        return spark.createDataFrame([], "markdown_key string, source_key string, text string, top_dir string")
    return spark.read.parquet(path)


def lookup_markdown(listing: DataFrame, store: DataFrame, key: str = "key",
                    source_prefix: str = "source", markdown_prefix: str = "markdown") -> DataFrame:
    """Markdown text for each source key via its mirrored key, null when absent (O-13)."""
    wanted = listing.withColumn("markdown_key", P.mirrored_key(key, source_prefix, markdown_prefix))
    texts = store.select("markdown_key", F.col("text").alias("markdown"))
    return wanted.join(texts, "markdown_key", "left")
