"""Ledger reports, corpus diagnosis and retry (O-92 … O-105).

All reports are grouped aggregations with map-side partial aggregation;
breakdowns over several dimensions are one ``GROUPING SETS`` pass. Per-group
samples use ``row_number() <= n``, for which Spark inserts a partial window
group limit before the shuffle, so a directory holding a third of all keys
sends only ``n`` rows per input partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions import paths as P


def ledger_counts(ledgers: dict[str, DataFrame]) -> DataFrame:
    """Rows per ledger (O-92)."""
    parts = [df.agg(F.lit(name).alias("ledger"), F.count(F.lit(1)).cast("bigint").alias("n_entries"))
             for name, df in ledgers.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def avg_embedding_time(embedding: DataFrame, by_collection: bool = False) -> DataFrame:
    """Mean embedding seconds (O-93)."""
    g = embedding.groupBy("collection_name") if by_collection else embedding.groupBy()
    return g.agg(F.count(F.lit(1)).cast("bigint").alias("n_files"),
                 F.round(F.avg("embedding_time_seconds"), 6).alias("avg_embedding_seconds"))


def failures_by_stage(failed: DataFrame) -> DataFrame:
    """Count per failure stage (O-94)."""
    return failed.groupBy("stage").agg(F.count(F.lit(1)).cast("bigint").alias("n_failed"))


def skip_breakdown(skipped: DataFrame) -> DataFrame:
    """Total and counts by reason, place and collection in one pass (O-95)."""
    g = skipped.groupingSets([["skip_reason"], ["found_in"], ["collection_name"], []],
                             "skip_reason", "found_in", "collection_name")
    agg = g.agg(F.count(F.lit(1)).cast("bigint").alias("n_skipped"),
                F.grouping_id().alias("__gid"))
    dim = (F.when(F.col("__gid") == 3, "by_reason").when(F.col("__gid") == 5, "by_source")
           .when(F.col("__gid") == 6, "by_collection").otherwise("total"))
    val = F.coalesce(F.col("skip_reason"), F.col("found_in"), F.col("collection_name"))
    return agg.select(dim.alias("breakdown"), F.when(F.col("__gid") == 7, F.lit("all")).otherwise(val).alias("value"),
                      "n_skipped")


def run_summary(outcomes: DataFrame, seconds: float | None = None, listed: DataFrame | None = None) -> DataFrame:
    """total, new, processed, failed, skipped, seconds, files/s (0 when no time) (O-96).

    ``outcomes`` has one row per considered file with ``outcome`` in
    (processed, failed, skipped).
    """
    rows = outcomes.select("outcome", F.lit(False).alias("__listed"))
    if listed is not None:
        rows = rows.unionByName(listed.select(F.lit(None).cast("string").alias("outcome"),
                                              F.lit(True).alias("__listed")))
    o, lst = F.col("outcome"), F.col("__listed")
    agg = rows.agg(  # one pass over listed files and outcomes together
        F.count_if(~lst).cast("bigint").alias("new_files"),
        F.count_if(~lst & (o == "processed")).cast("bigint").alias("processed"),
        F.count_if(~lst & (o == "failed")).cast("bigint").alias("failed"),
        F.count_if(~lst & (o == "skipped")).cast("bigint").alias("skipped"),
        F.count_if(lst).cast("bigint").alias("total_files"))
    if listed is None:
        agg = agg.withColumn("total_files", F.col("new_files"))
    secs = float(seconds or 0.0)
    return agg.withColumn("seconds", F.lit(round(secs, 3))).withColumn(
        "files_per_second", F.lit(0.0) if secs <= 0 else F.round(F.col("processed") / F.lit(secs), 3))


def directory_distribution(listing: DataFrame, key: str = "key") -> DataFrame:
    """Count per first directory, sorted by name (O-97)."""
    return (listing.groupBy(F.coalesce(P.top_directory(key), F.lit("(root)")).alias("directory"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_files")).orderBy("directory"))


def corpus_diagnosis(listing: DataFrame, key: str = "key") -> DataFrame:
    """Markdown vs other, by extension, by directory, by depth — one pass (O-98).

    Output rows (dimension, value, n_files).
    """
    ext = F.lower(P.suffix(key))
    d = listing.select(
        F.when(P.is_markdown(key), "markdown").otherwise("other").alias("kind"),
        F.when(ext == "", "(no extension)").otherwise(ext).alias("extension"),
        P.top_directory(key).alias("directory"),
        P.depth(key).cast("string").alias("depth"))
    g = d.groupingSets([["kind"], ["extension"], ["directory"], ["depth"]], "kind", "extension", "directory", "depth")
    agg = g.agg(F.count(F.lit(1)).cast("bigint").alias("n_files"), F.grouping_id().alias("__gid"))
    dim = (F.when(F.col("__gid") == 7, "kind").when(F.col("__gid") == 11, "by_extension")
           .when(F.col("__gid") == 13, "by_directory").otherwise("by_depth"))
    val = (F.when(F.col("__gid") == 7, F.col("kind")).when(F.col("__gid") == 11, F.col("extension"))
           .when(F.col("__gid") == 13, F.col("directory")).otherwise(F.col("depth")))
    out = agg.select(dim.alias("dimension"), val.alias("value"), "n_files")
    # keys without a sub-directory have no directory value; they are not a group
    return out.where(~((F.col("dimension") == "by_directory") & F.col("value").isNull()))


def sample_per_group(listing: DataFrame, n: int = 3, others: int = 10, key: str = "key") -> DataFrame:
    """First ``n`` markdown keys per directory with size in KB (1 decimal), and
    the first ``others`` non-markdown keys (O-99)."""
    md = listing.where(P.is_markdown(key)).withColumn("directory", P.top_directory(key))
    w = Window.partitionBy("directory").orderBy(key)
    firsts = (md.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
              .select(F.lit("markdown").alias("sample"), "directory", key,
                      F.round(F.col("size") / 1024, 1).alias("size_kb"), F.col("rank").cast("int")))
    rest = listing.where(~P.is_markdown(key)).orderBy(key).limit(others)
    w2 = Window.orderBy(key)  # over at most ``others`` rows
    rest = rest.select(F.lit("other").alias("sample"), F.lit(None).cast("string").alias("directory"), key,
                       F.round(F.col("size") / 1024, 1).alias("size_kb"),
                       F.row_number().over(w2).cast("int").alias("rank"))
    return firsts.unionByName(rest)


def corpus_issues(listing: DataFrame, key: str = "key") -> DataFrame:
    """Upper-case markdown suffixes, '.markdown' files, keys without sub-directory (O-100)."""
    sfx = P.suffix(key)
    k = F.col(key)
    return listing.agg(
        F.count_if(F.lower(sfx) == ".md").cast("bigint").alias("n_markdown"),
        F.count_if((F.lower(sfx) == ".md") & (sfx != ".md")).cast("bigint").alias("n_uppercase_md"),
        F.count_if(F.lower(k).endswith(".markdown")).cast("bigint").alias("n_dot_markdown"),
        F.count_if(F.size(F.split(k, "/")) <= 2).cast("bigint").alias("n_without_subdir"))


def retry_worklist(failed: DataFrame, source_listing: DataFrame, markdown_listing: DataFrame,
                   key: str = "key") -> DataFrame:
    """Where to retry each failed name (O-101).

    First source key (in key order) whose base name equals the failed name;
    otherwise the first markdown key whose stem equals the failed name's stem or
    whose name equals it; otherwise ``not_found``. Each lookup is a grouped
    ``min`` joined on equality — no per-name scan.
    """
    src = source_listing.groupBy(P.basename(key).alias("__name")).agg(F.min(key).alias("source_key"))
    md_stem = markdown_listing.groupBy(P.stem(key).alias("__stem")).agg(F.min(key).alias("__md_by_stem"))
    md_name = markdown_listing.groupBy(P.basename(key).alias("__mname")).agg(F.min(key).alias("__md_by_name"))
    f = failed.withColumn("__stem_f", P.stem("filename"))
    j = (f.join(src, f["filename"] == src["__name"], "left")
          .join(md_stem, F.col("__stem_f") == md_stem["__stem"], "left")
          .join(md_name, F.col("filename") == md_name["__mname"], "left"))
    md_key = F.least("__md_by_stem", "__md_by_name")
    return j.select(
        *failed.columns,
        F.coalesce(F.col("source_key"), md_key).alias("found_key"),
        F.when(F.col("source_key").isNotNull(), "source").when(md_key.isNotNull(), "markdown")
        .otherwise("not_found").alias("type"))


def clear_resolved(failed: DataFrame, succeeded: DataFrame, hash_col: str = "hash") -> DataFrame:
    """Failed-ledger rows whose hash has not since succeeded (O-102)."""
    ok = succeeded.select(F.col(hash_col).alias("hash")).where(F.col("hash").isNotNull()).distinct()
    return failed.join(ok, "hash", "left_anti")


def retry_summary(worklist: DataFrame, succeeded: DataFrame | None = None, hash_col: str = "hash") -> DataFrame:
    """total, processed, still failed, not found (O-103). Without ``succeeded``
    it is the dry run: found entries are counted as pending."""
    df = worklist
    if succeeded is not None:
        ok = succeeded.select(F.col(hash_col).alias("__ok")).distinct().withColumn("__done", F.lit(True))
        df = df.join(ok, df[hash_col] == ok["__ok"], "left")
    else:
        df = df.withColumn("__done", F.lit(None).cast("boolean"))
    found = F.col("type") != "not_found"
    return df.agg(
        F.count(F.lit(1)).cast("bigint").alias("total_files"),
        F.count_if(found & F.coalesce(F.col("__done"), F.lit(False))).cast("bigint").alias("processed"),
        F.count_if(found & ~F.coalesce(F.col("__done"), F.lit(False))).cast("bigint").alias("still_failed"),
        F.count_if(~found).cast("bigint").alias("not_found"))


def file_history(events: dict[str, DataFrame]) -> DataFrame:
    """All ledger events of each file in time order, with the previous event (O-104).

    ``events`` maps ledger name -> DataFrame with filename, hash, ts, detail.
    The window is per (file name, hash): one file's events, never a whole hash
    group of duplicates.
    """
    parts = [df.select("filename", "hash", "ts", F.col("detail").cast("string"), F.lit(n).alias("ledger"))
             for n, df in events.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    w = Window.partitionBy("filename", "hash").orderBy("ts", "ledger", "detail")
    return (u.withColumn("seq", F.row_number().over(w).cast("int"))
             .withColumn("previous_ledger", F.lag("ledger").over(w)))


def monitoring_rates(events: DataFrame, ts_col: str = "ts", failed=None, group_col: str | None = None,
                     window: str = "1 hour") -> DataFrame:
    """Files per window and failed percentage (O-105)."""
    fail = failed if failed is not None else F.lit(False)
    keys = [F.window(ts_col, window).alias("w")] + ([F.col(group_col)] if group_col else [])
    agg = events.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_files"),
        F.count_if(fail).cast("bigint").alias("n_failed"))
    return agg.select(F.col("w.start").cast("string").alias("window_start"),
                      *([group_col] if group_col else []), "n_files", "n_failed",
                      F.round(F.col("n_failed") * 100.0 / F.col("n_files"), 6).alias("failed_pct"))
