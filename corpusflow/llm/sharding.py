"""Sharding into ranges of near equal bytes by sampled splitters (native).

Records are ordered by (hash of the text, second hash), so equal texts lie next
to each other and sources mix. Splitters from a size-weighted key sample cut the
order into many fine ranges; a range with more rows than one task should sort (a
text with very many copies, say) is subdivided by the second hash. Exact sums of
the fine ranges then place each record: its shard is that of the middle of its
bytes in the whole order. Shards differ by about one record's size, whatever the
sample was like.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import stage, text_or_empty, unstage
from corpusflow.llm.ranges import MAX_RANGES, range_of, splitters

SHARDS = 24
ROWS_PER_RANGE = 50_000


def record_size(text: str | Column = "text") -> Column:
    """UTF-8 bytes of a text (null: none) plus 8."""
    return (F.octet_length(text_or_empty(F.col(text) if isinstance(text, str) else text)) + 8).cast("long")


def shard(docs: DataFrame, shards: int = SHARDS, text: str = "text", doc_id: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` per row; law is ``bytes``, grown_shard null.

    ``slot`` counts a shard's records from 0 in their order. A null text is an
    empty one. Null doc_ids and repeated rows are placed like others; which of
    several equal rows comes first does not show in the result. An empty table
    gives an empty result; with fewer records than shards some shards stay empty.
    ``keep`` names further columns to carry.
    """
    t = text_or_empty(F.col(text))
    rows, rows_path = stage(docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), record_size(text).alias("size"),
        F.crc32(t.cast("binary")).alias("text_crc32"), F.xxhash64(t).alias("key"),
        F.xxhash64(F.col(doc_id).cast("long"), F.monotonically_increasing_id()).alias("h2"), *keep), "shard-rows")
    n, total = rows.agg(F.count("*"), F.sum("size")).first()
    bounds = splitters(rows, "key", "size", min(MAX_RANGES, max(4 * shards, ceil(n / ROWS_PER_RANGE))), float(total or 0))
    ranged = rows.withColumn("range", range_of(F.col("key"), bounds))
    # one row per range, MAX_RANGES at most, hence broadcast
    parts = ranged.groupBy("range").agg(F.ceil(F.count("*") / F.lit(2 * ROWS_PER_RANGE)).alias("parts"))
    place = F.floor(F.shiftrightunsigned("h2", 11) / float(1 << 53) * F.col("parts")).cast("int")
    ranged, ranged_path = stage(ranged.join(F.broadcast(parts), "range").withColumn("part", place).drop("parts"), "ranged")

    sums = ranged.groupBy("range", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.partitionBy("range").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    of_range = sums.groupBy("range").agg(F.sum("bytes").alias("b"), F.sum("rows").alias("r"))
    ahead = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    of_range = of_range.select("range", F.coalesce(F.sum("b").over(ahead), F.lit(0)).alias("b0"),
                               F.coalesce(F.sum("r").over(ahead), F.lit(0)).alias("r0"))
    offsets = (sums.select("range", "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("b1"),
                           F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("r1"))
               .join(F.broadcast(of_range), "range")
               .select("range", "part", (F.col("b0") + F.col("b1")).alias("bytes_before"), (F.col("r0") + F.col("r1")).alias("rows_before")))
    order = Window.partitionBy("range", "part").orderBy("key", "h2", "doc_id")
    upto = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    total = max(int(total or 0), 1)
    middle = 2 * (F.col("bytes_before") + F.col("upto")) - F.col("size")
    placed, _ = stage(
        ranged.withColumn("upto", upto).withColumn("rn", F.row_number().over(order)).join(offsets, ["range", "part"])
        .select("doc_id", "size", "text_crc32", F.least(F.lit(shards - 1), F.floor(
            middle.cast("double") * shards / float(2 * total))).cast("int").alias("shard"),
            (F.col("rows_before") + F.col("rn") - 1).alias("rank"), *keep), "placed")
    unstage(docs.sparkSession, rows_path, ranged_path)
    first = placed.groupBy("shard").agg(F.min("rank").alias("first"))  # one row per shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("rank") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), *keep)


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write ``docs`` as ``path/shard=N/``, each shard's records in slot order.

    Rows are numbered and staged first, so null and repeated ids are written once each.
    """
    numbered, staged = stage(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    at = shard(numbered, shards, keep=("__row",)).select("__row", "shard", "slot")
    (numbered.join(at, "__row").drop("__row").repartition(shards, "shard").sortWithinPartitions("shard", "slot")
     .drop("slot").write.partitionBy("shard").parquet(path))
    unstage(docs.sparkSession, staged)
