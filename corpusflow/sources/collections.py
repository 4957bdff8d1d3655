"""Vector collections as bucket-partitioned Parquet tables (O-62, O-65).

A collection lives under ``<root>/<name>/``: a one-row ``_meta`` table
(name, dim, distance, buckets) and ``data/`` partitioned by ``bucket`` = a hash of the
file name. An upsert touches only the buckets of its new points: it reads
those partitions (partition pruning), keeps the latest row per id, stages the
result in the shared checkpoint folder and replaces just those partitions
(dynamic partition overwrite) — a path is never overwritten while it is
read, and the cost of a run grows with the run, not with the collection.
Ids are deterministic (uuid5), so re-running a write after an executor loss
produces the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from corpusflow.sources.ledgers import _exists

# Distances a collection may declare and the name rule.
DISTANCES = ("Cosine", "Euclid", "Dot", "Manhattan")
_NAME_RULE = re.compile(r"^[A-Za-z0-9_.-]{1,255}$")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def collection_path(root: str, name: str) -> str:
    return root.rstrip("/") + "/" + name


def collection_exists(spark: SparkSession, root: str, name: str) -> bool:
    return _exists(spark, collection_path(root, name) + "/_meta")


def create_collection(spark: SparkSession, root: str, name: str, dim: int,
                      distance: str = "Cosine", buckets: int = 64) -> bool:
    """Create the collection if absent; an existing one is left alone. Returns True if created.

    ``buckets`` is kept with the collection: every write uses that number.
    """
    if not _NAME_RULE.match(name):
        raise ValueError(f"invalid collection name: {name!r}")
    if distance not in DISTANCES:
        raise ValueError(f"distance must be one of {DISTANCES}")
    if collection_exists(spark, root, name):
        return False
    meta = spark.createDataFrame([(name, int(dim), distance, int(buckets))],
                                 "name string, dim int, distance string, buckets int")
    meta.coalesce(1).write.mode("errorifexists").parquet(collection_path(root, name) + "/_meta")
    return True


def collection_meta(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(collection_path(root, name) + "/_meta").select("name", "dim", "distance")


def bucket_count(spark: SparkSession, root: str, name: str) -> int:
    """The collection's own number of buckets (``DEFAULT_BUCKETS`` where it was never created explicitly)."""
    if not collection_exists(spark, root, name):
        return DEFAULT_BUCKETS
    meta = spark.read.parquet(collection_path(root, name) + "/_meta")
    return meta.first()["buckets"] if "buckets" in meta.columns else DEFAULT_BUCKETS


def list_collections(spark: SparkSession, root: str) -> list[str]:
    fs, hpath = _fs(spark, root)
    if not fs.exists(hpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath)
                  if s.isDirectory() and fs.exists(s.getPath().suffix("/_meta")))


def data_path(root: str, name: str) -> str:
    return collection_path(root, name) + "/data"


def read_points(spark: SparkSession, root: str, name: str, schema: str | None = None) -> DataFrame:
    """All points of a collection; an empty collection reads as empty."""
    path = data_path(root, name)
    if not _exists(spark, path):
        if schema is None:
            raise FileNotFoundError(f"collection {name} has no points")
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path)


def upsert(old: DataFrame, new: DataFrame, key: str = "id", seq: str = "version",
           replace_file: str | None = None, chunk_col: str = "page_number") -> DataFrame:
    """Later write wins per id (O-62).

    Rows of ``old`` and ``new`` are unioned and the highest ``seq`` per id is
    kept. ``replace_file`` (a file column) additionally drops old chunks of a
    re-written file whose number exceeds the new chunk count, so a shrinking
    document leaves no stale points. A window over a unique id has at most
    two rows per group, so there is no hot key.
    """
    both = old.unionByName(new, allowMissingColumns=True)
    # equal versions: a hash of the whole row decides, so that every run keeps the same one
    w = Window.partitionBy(key).orderBy(F.col(seq).desc(), F.xxhash64(F.to_json(F.struct(*both.columns))))
    merged = both.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
    if replace_file:
        counts = new.groupBy(replace_file).agg(F.max(chunk_col).alias("__max_chunk"))
        merged = (merged.join(counts, replace_file, "left")
                  .where(F.col("__max_chunk").isNull() | (F.col(chunk_col) <= F.col("__max_chunk")))
                  .drop("__max_chunk"))
    return merged


DEFAULT_BUCKETS = 64


def write_points(spark: SparkSession, root: str, name: str, points: DataFrame,
                 bucket_col: str = "filename") -> str:
    """Upsert ``points`` into the collection, rewriting only the touched buckets."""
    import time
    import uuid as _uuid

    from corpusflow.session import remove_path, scratch_path
    buckets = bucket_count(spark, root, name)
    seq = int(time.time() * 1000)
    new = (points.withColumn("version", F.lit(seq).cast("long"))
           .withColumn("bucket", F.pmod(F.xxhash64(bucket_col), F.lit(buckets)).cast("int")))
    touched = [r[0] for r in new.select("bucket").distinct().collect()]  # at most ``buckets`` values
    path = data_path(root, name)
    if not touched:
        return path  # nothing to upsert
    if _exists(spark, path):
        old = spark.read.parquet(path).where(F.col("bucket").isin(touched))
        merged = upsert(old, new)
    else:
        merged = upsert(new.limit(0), new)  # ids repeated within one write
    stage = scratch_path(spark, f"upsert-{name}-{_uuid.uuid4().hex}")
    # no repartition by bucket: a hot bucket (one file with a third of all
    # points) stays spread over the tasks of the id-partitioned upsert
    order = ["bucket", bucket_col] + (["page_number"] if "page_number" in merged.columns else [])
    merged.sortWithinPartitions(*order).write.mode("overwrite").partitionBy("bucket").parquet(stage)
    (spark.read.parquet(stage).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("bucket").parquet(path))
    remove_path(spark, stage)
    return path
