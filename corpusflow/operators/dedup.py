"""Incremental processing and deduplication (O-39 … O-49).

Every membership test is a join against a de-duplicated key set, so it
works for ledgers of any size: small sets become broadcast hash joins by
Spark's own size estimate (and AQE's runtime statistics), large ones
sort-merge joins. Nothing is collected to the driver.

Skew: a content hash shared by a third of all files must not land in one
task. The in-run duplicate rule therefore joins on ``(hash, key)`` against
the per-hash first key (a partial aggregate) instead of ranking inside a
window partitioned by hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Skip reasons and the places a duplicate was found, as the
# reference's skipped ledger records them (plus our name for a forced skip).
ALREADY_EMBEDDED, ALREADY_IN_COLLECTION, FORCE_SKIP, DUPLICATE_DETECTED = (
    "already_embedded", "already_in_qdrant", "force_skip", "duplicate_detected")
LOG_FILE, COLLECTION, BOTH, CONFIGURATION = ("log_file", "qdrant_collection", "both", "configuration")


def _flag(df: DataFrame, keys: DataFrame, on: list[tuple[str, str]], flag: str) -> DataFrame:
    """Left join a distinct key set and turn the match into a boolean column."""
    right = keys.select(*[F.col(r).alias(f"__r{i}") for i, (_, r) in enumerate(on)]).distinct()
    right = right.withColumn(f"__hit_{flag}", F.lit(True))
    cond = [df[l] == right[f"__r{i}"] for i, (l, _) in enumerate(on)]
    out = df.join(right, cond, "left")
    out = out.withColumn(flag, F.coalesce(F.col(f"__hit_{flag}"), F.lit(False)))
    return out.drop(f"__hit_{flag}", *[f"__r{i}" for i in range(len(on))])


def processed_hashes(conversion: DataFrame, upload: DataFrame, hash_col: str = "hash") -> DataFrame:
    """Distinct non-empty hashes of the conversion and upload ledgers (O-39)."""
    both = conversion.select(F.col(hash_col).alias("hash")).unionByName(
        upload.select(F.col(hash_col).alias("hash")))
    return both.where(F.col("hash").isNotNull() & (F.col("hash") != "")).distinct()


def new_files(listing: DataFrame, processed: DataFrame, etag_col: str = "etag") -> DataFrame:
    """Listed files whose ETag is not a processed hash (O-40)."""
    return listing.join(processed, listing[etag_col] == processed["hash"], "left_anti")


def in_ledger(files: DataFrame, ledger: DataFrame, hash_col: str = "hash",
              ledger_hash: str = "hash", flag: str = "in_ledger") -> DataFrame:
    """Hash membership in one ledger; rows carrying an error count too (O-41)."""
    return _flag(files, ledger, [(hash_col, ledger_hash)], flag)


def already_embedded(files: DataFrame, embedding_ledger: DataFrame, hash_col: str = "hash",
                     collection_col: str | None = None, flag: str = "already_embedded") -> DataFrame:
    """(hash[, collection]) present in the embedding ledger (O-42)."""
    on = [(hash_col, "md5_hash")]
    if collection_col:
        on.append((collection_col, "collection_name"))
    return _flag(files, embedding_ledger, on, flag)


def already_in_collection(files: DataFrame, points: DataFrame, hash_col: str = "hash",
                          points_hash: str = "file_hash", collection_col: str | None = None,
                          points_collection: str = "collection_name",
                          flag: str = "in_collection") -> DataFrame:
    """Any point of the collection carries this file hash (O-43).

    Points store the chunk MD5 in ``md5_hash`` and the file hash in
    ``file_hash``; the test uses the file hash (see README, trap T-02).
    """
    on = [(hash_col, points_hash)]
    if collection_col:
        on.append((collection_col, points_collection))
    return _flag(files, points, on, flag)


def first_in_run(files: DataFrame, hash_col: str, key_col: str, group_cols: tuple[str, ...] = (),
                 flag: str = "first_in_run") -> DataFrame:
    """True for the first key (in key order) of each content hash in this run (O-46).

    The first key per hash is a grouped min (map-side partial aggregation);
    joining back on (hash, key) spreads a hot hash over many partitions. A file
    without a hash (its content could not be read) is equal to no other, so it is
    a first as well.
    """
    keys = [hash_col, *group_cols]
    firsts = files.where(F.col(hash_col).isNotNull()).groupBy(*keys).agg(F.min(key_col).alias(key_col))
    return _flag(files, firsts, [(c, c) for c in [*keys, key_col]], flag).withColumn(flag, F.col(flag) | F.col(hash_col).isNull())


def dedup_decision(files: DataFrame, embedding_ledger: DataFrame, points: DataFrame | None,
                   hash_col: str = "hash", key_col: str = "filename",
                   collection: str | None = None, collection_col: str | None = None,
                   force: bool = False, four_reasons: bool = False,
                   skip_list: DataFrame | None = None, in_run: bool = True) -> DataFrame:
    """Process/skip decision per file (O-44, O-45, O-46, O-47).

    Order: force -> process; in the embedding ledger -> skip
    (already_embedded, log_file); in the collection -> skip
    (already_in_qdrant, qdrant_collection); else process. With
    ``four_reasons`` a file found in both is reported as
    (duplicate_detected, both) and a file on ``skip_list`` as force_skip.
    With ``in_run`` a later file with the content of an earlier one in the same
    run is skipped as already_embedded: the reference writes its ledger after
    each file, so the second copy finds the first.
    Adds ``action, skip_reason, found_in, original_processing_date``.
    """
    df = files
    if collection is not None and collection_col is None:
        df = df.withColumn("collection_name", F.lit(collection))
        collection_col = "collection_name"
    ccol = collection_col
    if force:
        return (df.withColumn("action", F.lit("process"))
                  .withColumn("skip_reason", F.lit(None).cast("string"))
                  .withColumn("found_in", F.lit(None).cast("string"))
                  .withColumn("original_processing_date", F.lit(None).cast("timestamp")))
    led = embedding_ledger
    first_seen = led.groupBy(F.col("md5_hash").alias("__h"), F.col("collection_name").alias("__c")) \
        .agg(F.min("timestamp").alias("original_processing_date"), F.lit(True).alias("__in_log"))
    if ccol:
        df = df.join(first_seen, (df[hash_col] == first_seen["__h"]) & (df[ccol] == first_seen["__c"]), "left")
    else:
        first_any = first_seen.groupBy("__h").agg(
            F.min("original_processing_date").alias("original_processing_date"), F.lit(True).alias("__in_log"))
        df = df.join(first_any, df[hash_col] == first_any["__h"], "left")
    df = df.withColumn("__in_log", F.coalesce("__in_log", F.lit(False))).drop("__h", "__c")  # a row without a date counts
    if points is not None:
        df = already_in_collection(df, points, hash_col, collection_col=ccol, flag="__in_coll")
    else:
        df = df.withColumn("__in_coll", F.lit(False))
    if in_run:
        df = first_in_run(df, hash_col, key_col, (ccol,) if ccol else (), flag="__first")
    else:
        df = df.withColumn("__first", F.lit(True))
    if skip_list is not None and four_reasons:
        df = _flag(df, skip_list, [(hash_col, "hash")], "__forced")
    else:
        df = df.withColumn("__forced", F.lit(False))

    in_log, in_coll, first = F.col("__in_log"), F.col("__in_coll"), F.col("__first")
    if four_reasons:
        reason = (F.when(F.col("__forced"), FORCE_SKIP)
                  .when(in_log & in_coll, DUPLICATE_DETECTED)
                  .when(in_log, ALREADY_EMBEDDED)
                  .when(in_coll, ALREADY_IN_COLLECTION)
                  .when(~first, ALREADY_EMBEDDED))
        place = (F.when(F.col("__forced"), CONFIGURATION)
                 .when(in_log & in_coll, BOTH)
                 .when(in_log, LOG_FILE)
                 .when(in_coll, COLLECTION)
                 .when(~first, LOG_FILE))
    else:
        reason = (F.when(in_log, ALREADY_EMBEDDED).when(in_coll, ALREADY_IN_COLLECTION)
                  .when(~first, ALREADY_EMBEDDED))
        place = (F.when(in_log, LOG_FILE).when(in_coll, COLLECTION)
                 .when(~first, LOG_FILE))
    return (df.withColumn("skip_reason", reason)
              .withColumn("found_in", place)
              .withColumn("action", F.when(F.col("skip_reason").isNull(), "process").otherwise("skip"))
              .drop("__in_log", "__in_coll", "__first", "__forced"))


def skip_rows(decisions: DataFrame, key_col: str = "filename", hash_col: str = "hash",
              collection_col: str = "collection_name", now=None) -> DataFrame:
    """Skipped-ledger rows from a decision table."""
    ts = now if now is not None else F.current_timestamp()
    return decisions.where(F.col("action") == "skip").select(
        ts.alias("timestamp"), F.col(key_col).alias("filename"), F.col(hash_col).alias("md5_hash"),
        "skip_reason", "found_in", F.col(collection_col).alias("collection_name"),
        "original_processing_date")


def lookup_report(hashes: DataFrame, embedding_ledger: DataFrame, points: DataFrame,
                  hash_col: str = "hash") -> DataFrame:
    """For each hash: in the ledger, in the collection, should skip (O-48)."""
    df = _flag(hashes, embedding_ledger, [(hash_col, "md5_hash")], "in_embedding_log")
    df = _flag(df, points, [(hash_col, "file_hash")], "in_qdrant")
    return df.withColumn("should_skip", F.col("in_embedding_log") | F.col("in_qdrant"))


def duplicate_groups(files: DataFrame, hash_col: str = "hash", key_col: str = "filename") -> DataFrame:
    """Content hashes stored under more than one name (O-49); partial aggregation."""
    return (files.groupBy(hash_col)
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_files"),
                 F.min(key_col).alias("first_key"), F.max(key_col).alias("last_key"))
            .where(F.col("n_files") > 1))
