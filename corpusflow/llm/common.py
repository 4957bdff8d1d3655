"""Helpers shared by the training-data operators.

A *word* is a maximal run of bytes other than ``\\x20`` and ``\\x09-\\x0D``;
a null text has no words.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.operators.chunking import ensure_parallelism
from corpusflow.session import scratch_path

_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
WORD_BREAK = r"[\x20\x09-\x0D]+"


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text in order, as an array (native)."""
    return F.array_remove(F.split(text_or_empty(text), WORD_BREAK, -1), "")


def stage_path(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex[:12]}")


def stage(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared scratch folder; the reread table and its path.

    A staged table outlives lost executors, cuts the lineage and has fixed rows
    (``monotonically_increasing_id`` columns included). The shuffle files of the
    write are released as soon as it is done; nothing reads them again.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    before = spark.conf.get(_RELEASE)
    spark.conf.set(_RELEASE, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_RELEASE, before)
    return spark.read.schema(df.schema).parquet(path), path


def unstage(spark: SparkSession, *paths: str) -> None:
    """Delete staged tables that no later step reads."""
    for p in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(p)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def rows_repeat(df: DataFrame, *columns: str) -> bool:
    """Whether some values of ``columns`` stand on several rows."""
    return bool(df.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1").limit(1).count())


def ensure_parallel(df: DataFrame) -> DataFrame:
    """Spread a bare scan that has fewer splits than the cluster has cores, round-robin, so that equal rows spread as well.

    A table of one small file would otherwise run its per-row work in one task.
    """
    return ensure_parallelism(df, df.sparkSession.sparkContext.defaultParallelism)
