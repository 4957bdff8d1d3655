"""Structured Streaming forms of ingest and monitoring (O-110, O-111).

* ``stream_to_store`` — a file-source stream of documents; each micro-batch is one
  run of a ``RunStore``, named after the stream and the batch. A batch that is
  executed again, as after a failure, replaces what it had written of its run, or
  writes nothing if the run already counts: every file is in every ledger once.
* ``stream_ingest`` — the same against fixed ledgers; each micro-batch writes its
  points to ``<out>/epoch=<id>`` with overwrite. The checkpoint replaces the listing
  prefilter for file discovery; the ledgers still decide by content.
* ``stream_rates`` — hourly counts with a watermark; late rows beyond the
  watermark are dropped by Spark's state store.
* ``stream_dedup`` — ``dropDuplicatesWithinWatermark`` on the content hash,
  the streaming form of the in-run duplicate rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions import hashing as H


def stream_to_store(store, name: str, files: DataFrame, checkpoint: str, **ingest_kw) -> None:
    """Drain a stream of ``files(key, text | content)`` into a store (O-110), one run ``<name>-<batch>`` per micro-batch.

    Each batch reads the ledgers and collections as the batch before left them, so
    content that an earlier batch brought is known. ``ingest_kw`` goes to
    ``ingest_run.ingest``. Runs are keyed by (name, batch): a stream that starts over
    with a new checkpoint needs a new name if its batches are cut differently.
    """
    from corpusflow.plans.ingest_run import ingest

    def run_batch(batch: DataFrame, epoch_id: int) -> None:
        ingest(store, batch, run_id=f"{name}-{epoch_id}", **ingest_kw)

    (files.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def stream_ingest(spark: SparkSession, source_dir: str, schema, out_path: str, checkpoint: str,
                  upload_ledger: DataFrame, embedding_ledger: DataFrame, resident: DataFrame | None,
                  text_col: str = "text", key_expr=None, max_files_per_trigger: int | None = None,
                  min_partitions: int | None = None, glob: str | None = None) -> None:
    """Stream against fixed ledgers; each batch writes its points to ``epoch=<id>``."""
    from corpusflow.plans.jobs import full_ingest
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    key = key_expr if key_expr is not None else F.concat(F.lit("stream/doc_"), F.col("doc_id").cast("string"), F.lit(".md"))
    files = stream.select(key.alias("key"), F.col(text_col).alias("text"))

    def run_batch(batch: DataFrame, epoch_id: int) -> None:
        out = full_ingest(batch, upload_ledger, embedding_ledger, resident, min_partitions=min_partitions)
        (out.content_points.withColumn("epoch", F.lit(epoch_id))
            .write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/epoch={epoch_id}"))

    q = (files.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def stream_rates(events: DataFrame, ts_col: str = "ts", watermark: str = "10 minutes",
                 window: str = "1 hour", failed=None, group_col: str | None = None) -> DataFrame:
    """Windowed counts with a watermark (works on a streaming or static DataFrame).

    Event time must be a TIMESTAMP for watermarks; a TIMESTAMP_NTZ column is
    converted in the session time zone and window bounds are returned as
    TIMESTAMP_NTZ again, so wall-clock values are preserved.
    """
    fail = failed if failed is not None else F.lit(False)
    ntz = dict(events.dtypes).get(ts_col) == "timestamp_ntz"
    if ntz:
        events = events.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    keys = [F.window(ts_col, window).alias("w")] + ([F.col(group_col)] if group_col else [])
    out = (events.withWatermark(ts_col, watermark).groupBy(*keys)
           .agg(F.count(F.lit(1)).alias("n_files"), F.count_if(fail).alias("n_failed")))
    if ntz:
        out = out.withColumn("w", F.struct(F.col("w.start").cast("timestamp_ntz").alias("start"),
                                           F.col("w.end").cast("timestamp_ntz").alias("end")))
    return out


def stream_dedup(files: DataFrame, ts_col: str, text_col: str = "text", delay: str = "1 hour") -> DataFrame:
    return (files.withColumn("hash", H.text_md5(text_col)).withWatermark(ts_col, delay)
            .dropDuplicatesWithinWatermark(["hash"]))


def run_to_files(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Drain a streaming DataFrame with availableNow into Parquet files and return these as a table.

    ``append`` writes each window once, when the watermark has passed its end;
    ``complete`` replaces the table by all windows after every batch. No result
    passes through the driver.
    """
    out = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "complete":
        def replace(batch: DataFrame, epoch_id: int) -> None:
            batch.write.mode("overwrite").parquet(path)
        out.foreachBatch(replace).start().awaitTermination()
    else:
        out.format("parquet").option("path", path).start().awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)
