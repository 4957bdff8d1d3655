"""Append-only ledgers (O-16, O-17).

Each ledger is a Parquet table under ``<root>/<name>``. A run appends its rows
with one write per ledger (Spark's commit protocol makes the append atomic per
job); lookups are joins, never scans in a loop. A missing ledger reads as an
empty DataFrame with the declared schema. Legacy JSON-array files can be read
with ``read_json_ledger``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _TS, _I, _D = T.StringType(), T.TimestampType(), T.IntegerType(), T.DoubleType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Ledger names and their fields as the reference writes them.
SCHEMAS: dict[str, T.StructType] = {
    "conversion": _schema(("filename", _S), ("hash", _S), ("datetime", _TS), ("error", _S)),
    "upload": _schema(("filename", _S), ("hash", _S), ("datetime", _TS), ("error", _S)),
    "failed": _schema(("filename", _S), ("hash", _S), ("datetime", _TS), ("error", _S), ("stage", _S)),
    "embedding": _schema(("timestamp", _TS), ("filename", _S), ("md5_hash", _S), ("collection_name", _S),
                         ("chunks_created", _I), ("embedding_time_seconds", _D), ("model_name", _S),
                         ("status", _S)),
    "qdrant_upload": _schema(("timestamp", _TS), ("filename", _S), ("md5_hash", _S), ("collection_name", _S),
                             ("points_uploaded", _I), ("point_ids", T.ArrayType(_S)), ("batch_size", _I),
                             ("upload_time_seconds", _D), ("status", _S)),
    "skipped": _schema(("timestamp", _TS), ("filename", _S), ("md5_hash", _S), ("skip_reason", _S),
                       ("found_in", _S), ("collection_name", _S), ("original_processing_date", _TS)),
}


def ledger_path(root: str, name: str) -> str:
    return root.rstrip("/") + "/" + name


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[name])


def read_ledger(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Read one ledger; absent -> empty DataFrame with the schema (O-16)."""
    path = ledger_path(root, name)
    if not _exists(spark, path):
        return empty(spark, name)
    return spark.read.schema(SCHEMAS[name]).parquet(path)


def read_json_ledger(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Read a JSON-array ledger file; a missing file is empty. ``corrupt_json_rows`` has the rows that don't fit."""
    if not _exists(spark, path):
        return empty(spark, name)
    return _json_rows(spark, path, name).where("_corrupt_record IS NULL").drop("_corrupt_record")


def corrupt_json_rows(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The rows that ``read_json_ledger`` leaves out, with their raw text in ``_corrupt_record``."""
    return _json_rows(spark, path, name).where("_corrupt_record IS NOT NULL")


def _json_rows(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One row per element of the JSON array; each element is parsed on its own, so a bad one spoils no other."""
    schema = T.StructType([*SCHEMAS[name].fields, T.StructField("_corrupt_record", T.StringType())])
    text = spark.read.text(path, wholetext=True)
    elements = F.coalesce(F.from_json("value", "array<string>"), F.array("value"))
    rows = text.select(F.explode(elements).alias("element"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    return rows.select(F.from_json("element", schema, options).alias("r")).select("r.*")


def conform(df: DataFrame, name: str) -> DataFrame:
    """Select and cast a DataFrame to the ledger schema; absent fields are null."""
    cols = []
    for f in SCHEMAS[name].fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def append_ledger(df: DataFrame, root: str, name: str) -> None:
    """Append rows to a ledger in one job (O-17)."""
    conform(df, name).write.mode("append").parquet(ledger_path(root, name))


def replace_ledger(spark: SparkSession, df: DataFrame, root: str, name: str) -> None:
    """Rewrite a ledger from a DataFrame that may read the same ledger.

    The new content is first written to a fresh versioned folder of the shared
    checkpoint location, then copied over, so a path is never overwritten
    while it is being read.
    """
    from corpusflow.session import remove_path, scratch_path
    import uuid as _uuid
    staged = scratch_path(spark, f"ledger-{name}-{_uuid.uuid4().hex}")
    conform(df, name).write.mode("overwrite").parquet(staged)
    spark.read.schema(SCHEMAS[name]).parquet(staged).write.mode("overwrite").parquet(ledger_path(root, name))
    remove_path(spark, staged)
