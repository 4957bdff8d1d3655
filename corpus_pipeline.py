"""The corpus pipeline: STAGES over ``documents``, each written and reread as the next one's input.

Every stage works on all rows its predecessor kept. A missing source is a source of its
own, an empty table passes through all stages, and columns besides those of
``documents`` are carried to the packing stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import mixing, near_dedup, packing, quality_rules, substring_dedup
from corpusflow.llm.common import documents, stage

#: The fitted rules, similarity, mixing order and packing have no SQL form; tests/llm checks each stage by brute force.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.kept_documents(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group stays, that of the smallest doc_id and text hash; rows without words all stay."""
    firsts, _ = stage(near_dedup.grouped_rows(docs).where("stays").select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), (F.col("n_shingles") > 0).alias("__words")), "groups")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (near_dedup.text_hash("text") == F.col("__hash"))
    kept = docs.join(firsts, same, "left_semi")
    copies = firsts.where("__words").groupBy("__id", "__hash").agg(F.count("*").alias("n")).where("n > 1")
    if not copies.limit(1).count():
        return kept
    # true copies: one row of each, by the hash of all its columns
    row = F.struct(*[F.col(c) for c in docs.columns])
    one = (docs.join(copies, same, "left_semi").groupBy(F.col("doc_id").alias("__id"), near_dedup.text_hash("text").alias("__hash"))
           .agg(F.min_by(row, F.xxhash64(*docs.columns)).alias("row")).select("row.*"))
    return kept.join(copies, same, "left_anti").union(one)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 35 words or more that stand elsewhere too are cut out."""
    return substring_dedup.remove_repeats(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it."""
    return mixing.materialise(docs, mixing.mix(docs, mixing.word_count()))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as pieces in sequences of at most 1024 tokens."""
    return packing.packed_documents(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("substring_dedup", substring_stage),
    ("mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = documents(spark, sf_dir)
    for name, step in STAGES[:-1]:
        docs, _ = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
