"""A persisted ingest run (O-106, O-17, O-71): every file of a run ends in a stated way.

The states follow the order of the stages. A file whose content hash the upload ledger
has is left alone. One that the embedding ledger or the collection has is skipped, and
entered in the upload ledger, so that the next run leaves it alone. The others are
converted, cut into chunks and embedded; a file fails at the first stage that gives
nothing for it, under that stage's name, and only then has a row in the failed ledger:

* ``pipeline``: no content
* ``docling``: the converter failed or gave nothing
* ``chunker``: no chunk
* ``ollama``: no vector for the file's name
* ``qdrant``: no chunk has a vector (single chunks without one are dropped, and the
  embedding ledger says ``partial``)

Of files with equal content that reach the embedder only the first, by key, is
embedded; the others are skipped if it succeeds and fail as it does if not, so that they
are tried again. A failed file has no points and no row in the upload ledger.

All rows belong to one run of a ``RunStore`` and count together, when its manifest is
written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions import paths as P
from corpusflow.operators import chunking as CH
from corpusflow.operators import convert as CV
from corpusflow.operators import dedup as DD
from corpusflow.operators import embedding as EM
from corpusflow.operators import points as PT
from corpusflow.session import remove_path, scratch_path, write_table
from corpusflow.sources.run_store import Run, RunStore

# The failure stages of the failed ledger, in the order a file passes them, and their messages.
STAGE_ERRORS = {
    "pipeline": "Failed to download file",
    "docling": "Conversion failed",
    "chunker": "Chunking failed",
    "ollama": "Filename embedding failed",
    "qdrant": "Content upload failed",
}
_CHUNK = ("key", "filename", "file_hash", "chunk_number", "text", "element_type", "md5_hash", "n_tokens")


def ingest(store: RunStore, files: DataFrame, run_id: str | None = None, convert: CV.ConvertFn | None = None,
           embed: EM.EmbedFn | None = None, name_embed: EM.EmbedFn | None = None,
           collection: str = "content", name_collection: str = "filenames", model: str = "hashing-64", name_model: str = "hashing-32",
           chunk_tokens: int = CH.DEFAULT_CHUNK_TOKENS, overlap_tokens: int = CH.DEFAULT_OVERLAP_TOKENS,
           batch_size: int = EM.DEFAULT_BATCH_SIZE, force: bool = False, id_scope: str = "key",
           skip_extensions: list[str] | None = None, **retry) -> DataFrame:
    """Ingest ``files`` as one run of the store; ``key, hash, state, stage, reason`` of every file.

    With ``id_scope="name"`` files of one base name are one file to the collections, and
    the last of them, by key, holds it; all of them count as processed.
    ``files`` has ``key`` and either ``content`` (bytes, for ``convert``) or ``text``
    (markdown). State is ``known``, ``skipped``, ``processed`` or ``failed``; stage is that
    of a failure, reason that of a skip. With ``force`` no file is known or skipped.
    ``retry`` goes to the embedder (attempts, min_wait, max_wait). With a ``run_id``
    that already counts nothing is done and the result is empty. Keys must be
    distinct and not null.
    """
    spark = store.spark
    run = store.begin(run_id)
    if run is None:
        return spark.createDataFrame([], "key string, hash string, state string, stage string, reason string")
    embed, name_embed = embed or EM.HashingEmbedder(64), name_embed or EM.HashingEmbedder(32)
    body = "content" if convert else "text"
    if skip_extensions:
        files = files.where(~P.skip_by_extension("key", skip_extensions))
    files = files.select("key", body).withColumn("hash", F.md5(body))
    scratch = scratch_path(spark, f"ingest-{run.id}-{run.seq}")

    def staged(name: str, df: DataFrame) -> DataFrame:
        write_table(df, f"{scratch}/{name}")
        return spark.read.schema(df.schema).parquet(f"{scratch}/{name}")

    listing = staged("listing", files.select("key", "hash"))
    if listing.where("key is null").limit(1).count() or listing.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").limit(1).count():
        raise ValueError("keys must be distinct and not null")
    decided = staged("decided", _decide(store, listing, collection, force))

    # conversion of the files to process, kept as the run's markdown; texts go through one exchange, dealt out evenly
    if decided.where("state <> 'process'").limit(1).count():
        files = files.join(decided.where("state = 'process'").select("key"), "key", "left_semi")
    todo = _spread(files)
    made = (CV.convert_with(todo, convert, "content", "key", keep=("hash",)) if convert else
            todo.select("key", "hash", F.col("text").alias("markdown"), F.lit(None).cast("string").alias("error")))
    markdown = store.write(run, "markdown", made.select(
        "key", P.mirrored_key("key").alias("markdown_key"), "hash", F.col("markdown").alias("text"),
        F.when(F.col("markdown").isNull(), F.coalesce("error", F.lit(STAGE_ERRORS["docling"]))).alias("error")))

    ready = markdown.where(F.col("text").rlike(r"[^ \t\n\r\f]")).select("key", "hash", P.basename("key").alias("filename"))
    names = staged("names", EM.batch_embed(ready, name_embed, "filename", ("key", "hash", "filename"), batch_size, **retry))
    named = names.where("vector is not null").select("key", "hash", "filename")
    first = named if force else named.groupBy("hash").agg(F.min("key").alias("key")).select("key", "hash")
    texts = markdown.join(first.select("key"), "key", "left_semi").select(
        "key", P.basename("key").alias("filename"), F.col("hash").alias("file_hash"), "text")
    chunks = CH.chunk_documents(texts, keep=("key", "file_hash"), chunk_tokens=chunk_tokens, overlap_tokens=overlap_tokens)
    embedded = staged("embedded", EM.batch_embed(chunks, embed, "text", _CHUNK, batch_size, **retry))
    made_of = embedded.groupBy("key", "file_hash").agg(F.count("*").alias("n_chunks"), F.count("vector").alias("n_vectors"))
    if force:
        fate = made_of.select("key", "n_vectors")
    else:  # the others of equal content go the way of the first
        fate = named.join(made_of.select(F.col("file_hash").alias("hash"), "n_vectors"), "hash", "left").select(
            "key", F.coalesce("n_vectors", F.lit(0)).alias("n_vectors"))

    state = staged("state", _states(decided, markdown, names, fate, first))
    done = state.where("state = 'processed'").select("key")
    if id_scope == "name":  # of files of one base name the last one's points stay
        done = done.groupBy(P.basename("key").alias("name")).agg(F.max("key").alias("key")).select("key")
    content = embedded.where("vector is not null")
    # chunks are joined, and so exchanged, only if some file with vectors is not done
    if made_of.where("n_vectors > 0").join(done, "key", "left_anti").limit(1).count():
        content = content.join(done, "key", "left_semi")
    store.create_collection(collection, _dim(embed))
    store.create_collection(name_collection, _dim(name_embed))
    points = PT.content_points(content, id_scope=id_scope, keep=("key",))
    store.write_points(run, collection, points.withColumn("file", _file(id_scope, "key", "filename")))
    good_names = names.join(done, "key", "left_semi")
    store.write_points(run, name_collection, PT.filename_points(good_names, "key", hash_col="hash", vector_col="vector", id_scope=id_scope)
                       .withColumn("file", _file(id_scope, "source", "pagecontent")))

    now = F.current_timestamp()
    key = F.col("key").alias("filename")
    store.write_ledger(run, "conversion", markdown.where("text is not null").select(key, "hash", now.alias("datetime")))
    store.write_ledger(run, "upload", state.where("state in ('processed', 'skipped')").select(key, "hash", now.alias("datetime")))
    store.write_ledger(run, "failed", state.where("state = 'failed'").select(
        key, "hash", now.alias("datetime"), F.coalesce("error", _message()).alias("error"), "stage"))
    store.write_ledger(run, "skipped", state.where("state = 'skipped'").select(
        now.alias("timestamp"), key, F.col("hash").alias("md5_hash"), F.col("reason").alias("skip_reason"), "found_in",
        F.lit(collection).alias("collection_name"), "original_processing_date"))
    ok = embedded.join(done, "key", "left_semi")
    name_rows = good_names.withColumn("file_hash", F.col("hash"))
    store.write_ledger(run, "embedding", EM.embedding_ledger_rows(ok, "key", "file_hash", collection, model).unionByName(
        EM.embedding_ledger_rows(name_rows, "key", "file_hash", name_collection, name_model)))
    store.write_ledger(run, "qdrant_upload", _uploads(content, collection, batch_size).unionByName(
        _uploads(name_rows, name_collection, batch_size)))
    result = store.write(run, "states", state.select("key", "hash", "state", "stage", "reason"))
    n = {r["state"]: r["n"] for r in state.groupBy("state").agg(F.count("*").alias("n")).collect()}
    store.commit(run, sum(n.values()), n.get("processed", 0), n.get("skipped", 0) + n.get("known", 0), n.get("failed", 0))
    remove_path(spark, scratch)
    return result


def _decide(store: RunStore, listing: DataFrame, collection: str, force: bool) -> DataFrame:
    """``key, hash, state, reason, found_in, original_processing_date`` before any conversion: known, skipped or process."""
    if force:
        none = F.lit(None).cast("string")
        return listing.select("key", "hash", F.lit("process").alias("state"), none.alias("reason"), none.alias("found_in"),
                              F.lit(None).cast("timestamp").alias("original_processing_date"))
    known = DD.in_ledger(listing, store.ledger("upload").select("hash"), flag="known")
    made = DD.dedup_decision(known, store.ledger("embedding"), store.resident(collection), key_col="key", collection=collection, in_run=False)
    state = F.when(F.col("known"), "known").when(F.col("action") == "skip", "skipped").otherwise("process")
    return made.select("key", "hash", state.alias("state"), F.when(~F.col("known"), F.col("skip_reason")).alias("reason"),
                       F.when(~F.col("known"), F.col("found_in")).alias("found_in"), "original_processing_date")


def _states(decided: DataFrame, markdown: DataFrame, names: DataFrame, fate: DataFrame, first: DataFrame) -> DataFrame:
    """Every file's ``state``, with stage and error of a failure and reason of a skip."""
    made = markdown.select("key", F.col("text").isNotNull().alias("converted"), F.col("error").alias("convert_error"))
    named = names.select("key", F.col("vector").isNotNull().alias("named"), F.col("embed_error").alias("name_error"))
    all_ = (decided.join(made, "key", "left").join(named, "key", "left").join(fate, "key", "left")
            .join(first.select("key", F.lit(True).alias("first")), "key", "left"))
    todo = F.col("state") == "process"
    stage = (F.when(F.col("hash").isNull(), "pipeline").when(~F.col("converted"), "docling").when(F.col("named").isNull(), "chunker")
             .when(~F.col("named"), "ollama").when(F.coalesce("n_vectors", F.lit(0)) == 0, "qdrant"))
    copy = todo & stage.isNull() & F.col("first").isNull()
    error = F.when(stage == "docling", F.col("convert_error")).when(stage == "ollama", F.concat(
        F.lit(STAGE_ERRORS["ollama"] + ": "), F.coalesce("name_error", F.lit(""))))
    return all_.select(
        "key", "hash", F.when(~todo, F.col("state")).when(stage.isNotNull(), "failed").when(copy, "skipped").otherwise("processed").alias("state"),
        F.when(todo, stage).alias("stage"), F.when(todo, error).alias("error"),
        F.when(copy, DD.ALREADY_EMBEDDED).otherwise(F.col("reason")).alias("reason"),
        F.when(copy, DD.LOG_FILE).otherwise(F.col("found_in")).alias("found_in"), "original_processing_date")


def _message() -> Column:
    out = F.lit(None).cast("string")
    for stage, text in STAGE_ERRORS.items():
        out = F.when(F.col("stage") == stage, text).otherwise(out)
    return out


def _file(id_scope: str, key: str, name: str) -> Column:
    """What makes two points' files one: the key, or the base name alone."""
    return F.col(key if id_scope == "key" else name)


def _dim(embed: EM.EmbedFn) -> int:
    return getattr(embed, "dim", EM.DEFAULT_DIMENSION)


def _spread(df: DataFrame) -> DataFrame:
    """Rows dealt out evenly before the heavy steps."""
    conf = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return df.repartition(max(int(conf), 2 * df.sparkSession.sparkContext.defaultParallelism))


def _uploads(rows: DataFrame, collection: str, batch_size: int) -> DataFrame:
    """Upload-ledger rows (O-64): points of each file; all their ids are the collection's rows of that run."""
    return rows.groupBy(F.col("key").alias("filename"), F.col("file_hash").alias("md5_hash")).agg(
        F.count("*").cast("int").alias("points_uploaded")).select(
        F.current_timestamp().alias("timestamp"), "filename", "md5_hash", F.lit(collection).alias("collection_name"), "points_uploaded",
        F.lit(batch_size).alias("batch_size"), F.lit("success").alias("status"))


def rebuild(store: RunStore, collection: str, embed: EM.EmbedFn, model: str, run_id: str | None = None,
            chunk_tokens: int = CH.DEFAULT_CHUNK_TOKENS, overlap_tokens: int = CH.DEFAULT_OVERLAP_TOKENS,
            batch_size: int = EM.DEFAULT_BATCH_SIZE, id_scope: str = "key", **retry) -> Run | None:
    """Embed all stored markdown anew, with another model, into another collection (O-71).

    One run: the collection's points, embedding and upload-to-collection rows, and a
    failed row (stage ``reprocess``) for each file without a chunk or without a vector.
    Nothing is done if the run id already counts.
    """
    spark = store.spark
    run = store.begin(run_id)
    if run is None:
        return None
    scratch = scratch_path(spark, f"rebuild-{run.id}-{run.seq}")
    store.create_collection(collection, _dim(embed))
    markdown = store.markdown()
    texts = _spread(markdown.select("key", P.basename("key").alias("filename"), F.col("hash").alias("file_hash"), "text"))
    chunks = CH.chunk_documents(texts, keep=("key", "file_hash"), chunk_tokens=chunk_tokens, overlap_tokens=overlap_tokens)
    write_table(EM.batch_embed(chunks, embed, "text", _CHUNK, batch_size, **retry), scratch)
    embedded = spark.read.parquet(scratch)
    good = embedded.where("vector is not null")
    files = good.select("key").distinct()
    store.write_points(run, collection, PT.content_points(good, id_scope=id_scope, keep=("key",))
                       .withColumn("file", _file(id_scope, "key", "filename")))
    store.write_ledger(run, "embedding", EM.embedding_ledger_rows(embedded.join(files, "key", "left_semi"), "key", "file_hash", collection, model))
    store.write_ledger(run, "qdrant_upload", _uploads(good, collection, batch_size))
    failed = markdown.join(files, "key", "left_anti").select(
        F.col("key").alias("filename"), "hash", F.current_timestamp().alias("datetime"),
        F.lit("no chunk has a vector").alias("error"), F.lit("reprocess").alias("stage"))
    store.write_ledger(run, "failed", failed)
    n_files, n_good = markdown.count(), files.count()
    store.commit(run, n_files, n_good, 0, n_files - n_good)
    remove_path(spark, scratch)
    return run
