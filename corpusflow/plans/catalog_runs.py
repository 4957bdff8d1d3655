"""Registered queries, part 4: persisted runs, collections that change, streams into a store."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.operators import embedding as EM
from corpusflow.plans import fixtures as FX
from corpusflow.plans import ingest_run as IR
from corpusflow.plans import jobs as J
from corpusflow.plans.catalog import query
from corpusflow.session import scratch_path, write_table
from corpusflow.sources.run_store import RunStore

LONG = 6000


def _store(spark) -> RunStore:
    return RunStore(spark, scratch_path(spark, f"store-{uuid.uuid4().hex[:12]}"))


def squeezed(text) -> F.Column:
    """MD5 of a text without its white space, which chunks joined in order keep."""
    return F.md5(F.regexp_replace(text, r"[ \t\n\r\f]+", ""))


SQL_SQUEEZED = r"md5(regexp_replace({t}, '[ \t\n\r\f]+', '', 'g'))"


def per_file(points: DataFrame, *by: str) -> DataFrame:
    """Per file whether pages count from 1 without holes and ids differ, and its text without white space."""
    text = F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("page_number", "pagecontent"))), lambda x: x["pagecontent"]))
    # counted in lists, as distinct aggregates would exchange the texts twice
    ids, pages = (F.size(F.array_distinct(F.collect_list(c))) for c in ("id", "page_number"))
    whole = (F.count("*") == F.max("page_number")) & (ids == F.count("*")) & (pages == F.count("*"))
    return points.groupBy(*by).agg(whole.alias("pages_whole"), squeezed(text).alias("text_md5"))


# ------------------------------------------------------------------ a run after a run with failures

class LimitedEmbedder:
    """A service that gives no vector for texts that are too long for it, or of a kind it refuses."""

    def __init__(self, dim: int, longest: int | None = None, refuses: str | None = None):
        self.inner, self.dim, self.longest, self.refuses = EM.HashingEmbedder(dim), dim, longest, refuses

    def __call__(self, texts: list[str]) -> list:
        if self.refuses and any(t.endswith(self.refuses) for t in texts):
            raise RuntimeError("refused")
        return [None if self.longest and len(t) > self.longest else v for t, v in zip(texts, self.inner(texts))]


def convert_text(content: bytes, name: str) -> tuple:
    """A converter of text files that knows one format it cannot read."""
    if name.endswith(".DS_Store"):
        raise ValueError("unsupported format")
    return content.decode(), None


def listed_files(spark, d) -> DataFrame:
    """Objects with bytes: the documents, blank files (one a nation) and objects that could not be read (one a region)."""
    docs = FX.fx_files(spark, d).select(F.col("object_key").alias("key"), F.encode("text", "UTF-8").alias("content"))
    blank = FX.table(spark, d, "nation").select(F.concat(F.lit("source/nation/n"), F.col("n_nationkey").cast("string"), F.lit(".pdf")).alias("key"),
                                                F.encode(F.lit(" \n"), "UTF-8").alias("content"))
    gone = FX.table(spark, d, "region").select(F.concat(F.lit("source/region/r"), F.col("r_regionkey").cast("string"), F.lit(".pdf")).alias("key"),
                                               F.lit(None).cast("binary").alias("content"))
    return docs.unionByName(blank).unionByName(gone)


def ledger_rows(store: RunStore) -> DataFrame:
    """Every row of the six ledgers and every file of the collections: ``seq, ledger, filename, hash, detail, n``."""
    one = F.lit(1).cast("bigint")

    def rows(name, hash_col, detail, n=one):
        return store.ledger(name).select("seq", F.lit(name).alias("ledger"), "filename", F.col(hash_col).alias("hash"),
                                         detail.alias("detail"), n.cast("bigint").alias("n"))

    parts = [rows("conversion", "hash", F.lit("converted")), rows("upload", "hash", F.lit("uploaded")),
             rows("failed", "hash", F.col("stage")), rows("skipped", "md5_hash", F.concat_ws("/", "skip_reason", "found_in", "collection_name")),
             rows("embedding", "md5_hash", F.concat_ws("/", "collection_name", "status"), F.col("chunks_created")),
             rows("qdrant_upload", "md5_hash", F.col("collection_name"), F.col("points_uploaded"))]
    for c in store.collections():
        parts.append(store.points(c).groupBy("seq", "file", "file_hash").agg(F.count("*").alias("n")).select(
            "seq", F.lit("points").alias("ledger"), F.col("file").alias("filename"), F.col("file_hash").alias("hash"), F.lit(c).alias("detail"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_RUN_SQL = """
listed AS (
  SELECT object_key AS key, content_md5 AS hash, text FROM fx_files
  UNION ALL SELECT 'source/nation/n' || n_nationkey || '.pdf', md5(' ' || chr(10)), ' ' || chr(10) FROM nation
  UNION ALL SELECT 'source/region/r' || r_regionkey || '.pdf', NULL, NULL FROM region),
-- the stage at which a file fails before its chunks are embedded
early AS (
  SELECT *, CASE WHEN text IS NULL THEN 'pipeline' WHEN key LIKE '%.DS_Store' THEN 'docling' WHEN trim(text, e' \\t\\n\\r\\f') = '' THEN 'chunker' END AS stage,
    length(trim(text, e' \\t\\n\\r\\f')) AS n_chars FROM listed),
run1 AS (
  SELECT key, hash, CASE WHEN stage IS NOT NULL THEN stage WHEN key LIKE '%.MD' THEN 'ollama' WHEN n_chars > 6000 THEN 'qdrant' END AS stage FROM early),
state1 AS (
  SELECT *, CASE WHEN stage IS NOT NULL THEN 'failed' WHEN key = min(key) FILTER (stage IS NULL) OVER (PARTITION BY hash) THEN 'processed' ELSE 'skipped' END AS state FROM run1),
done AS (SELECT DISTINCT hash FROM state1 WHERE state = 'processed'),
run2 AS (SELECT key, hash, stage FROM early WHERE hash IS NULL OR hash NOT IN (SELECT hash FROM done)),
state2 AS (
  SELECT *, CASE WHEN stage IS NOT NULL THEN 'failed' WHEN key = min(key) FILTER (stage IS NULL) OVER (PARTITION BY hash) THEN 'processed' ELSE 'skipped' END AS state FROM run2),
states AS (SELECT 1 AS seq, * FROM state1 UNION ALL SELECT 2, * FROM state2)
"""


@query("ingest_ledger_state", "WITH " + _RUN_SQL + """
SELECT CAST(seq AS BIGINT) AS seq, ledger, key AS filename, hash, detail, CAST(1 AS BIGINT) AS n FROM (
  SELECT seq, 'conversion' AS ledger, key, hash, 'converted' AS detail FROM states WHERE stage IS NULL OR stage NOT IN ('pipeline', 'docling')
  UNION ALL SELECT seq, 'upload', key, hash, 'uploaded' FROM states WHERE state IN ('processed', 'skipped')
  UNION ALL SELECT seq, 'failed', key, hash, stage FROM states WHERE state = 'failed'
  UNION ALL SELECT seq, 'skipped', key, hash, 'already_embedded/log_file/content' FROM states WHERE state = 'skipped'
  UNION ALL SELECT seq, 'embedding', key, hash, c || '/success' FROM states, (VALUES ('content'), ('filenames')) t(c) WHERE state = 'processed'
  UNION ALL SELECT seq, 'qdrant_upload', key, hash, c FROM states, (VALUES ('content'), ('filenames')) t(c) WHERE state = 'processed'
  UNION ALL SELECT seq, 'points', key, hash, c FROM states, (VALUES ('content'), ('filenames')) t(c) WHERE state = 'processed')""",
       "O-106 O-17 O-16 O-56 O-59 O-60 O-64 O-46")
def ingest_ledger_state(spark, d):
    """All ledgers and collections after a run with failing converter and embedders, and a second one with working embedders.

    A chunk is a whole file here, so that the counts follow from the files alone.
    """
    store, files = _store(spark), listed_files(spark, d)
    common = {"convert": convert_text, "chunk_tokens": 1_000_000_000, "attempts": 1}
    IR.ingest(store, files, embed=LimitedEmbedder(16, longest=LONG), name_embed=LimitedEmbedder(8, refuses=".MD"), **common)
    IR.ingest(store, files, embed=EM.HashingEmbedder(16), name_embed=EM.HashingEmbedder(8), **common)
    return ledger_rows(store)


# ------------------------------------------------------------------ streams

@query("stream_ingest_exactly_once", """
WITH s AS (SELECT object_key AS key, content_md5 AS hash, object_key = min(object_key) OVER (PARTITION BY content_md5) AS first FROM fx_files
           WHERE trim(text, e' \\t\\n\\r\\f') <> '')
SELECT CAST(1 AS BIGINT) AS seq, ledger, key AS filename, hash, detail, CAST(1 AS BIGINT) AS n FROM (
  SELECT 'conversion' AS ledger, key, hash, 'converted' AS detail FROM s
  UNION ALL SELECT 'upload', key, hash, 'uploaded' FROM s
  UNION ALL SELECT 'skipped', key, hash, 'already_embedded/log_file/content' FROM s WHERE NOT first
  UNION ALL SELECT 'embedding', key, hash, c || '/success' FROM s, (VALUES ('content'), ('filenames')) t(c) WHERE first
  UNION ALL SELECT 'qdrant_upload', key, hash, c FROM s, (VALUES ('content'), ('filenames')) t(c) WHERE first
  UNION ALL SELECT 'points', key, hash, c FROM s, (VALUES ('content'), ('filenames')) t(c) WHERE first)""", "O-110")
def stream_ingest_exactly_once(spark, d):
    """A stream into a store whose batch is executed twice, the second time as after a lost checkpoint."""
    from corpusflow.streaming.ingest import stream_to_store
    store = _store(spark)
    keys = FX.fx_files(spark, d).select("doc_id", F.col("object_key").alias("key"))
    stream = FX.table_stream(spark, d, "documents")
    files = stream.where(F.trim(F.regexp_replace("text", r"[\t\n\r\f]", " ")) != "").join(keys, "doc_id").select("key", "text")
    for _ in range(2):
        stream_to_store(store, "documents", files, f"{store.root}/ckpt-{uuid.uuid4().hex[:8]}", embed=EM.HashingEmbedder(16),
                        name_embed=EM.HashingEmbedder(8), chunk_tokens=1_000_000_000)
    return ledger_rows(store)


@query("stream_ingest_retried_batch", """
SELECT object_key AS filename, content_md5 AS hash, CAST(1 AS BIGINT) AS n_rows FROM fx_files""", "O-110 O-17")
def stream_ingest_retried_batch(spark, d):
    """A batch that was lost before its manifest, leaving half its rows, and is executed again."""
    store = _store(spark)
    files = FX.fx_files(spark, d).select(F.col("object_key").alias("filename"), F.col("content_md5").alias("hash"))
    lost = store.begin("documents-0")
    store.write_ledger(lost, "upload", files.unionByName(files.where("hash < '8'")))
    again = store.begin("documents-0")
    store.write_ledger(again, "upload", files)
    store.commit(again, files.count())
    return store.ledger("upload").groupBy("filename", "hash").agg(F.count("*").alias("n_rows"))


# ------------------------------------------------------------------ collections that change

@query("collection_generations", """
SELECT CAST(id AS VARCHAR) AS id, filename, page_number, pagecontent,
  CAST(CASE WHEN CAST(regexp_extract(filename, '[0-9]+') AS INTEGER) % 3 = 0 THEN 2 ELSE 1 END AS BIGINT) AS seq
FROM fx_points
WHERE (CAST(regexp_extract(filename, '[0-9]+') AS INTEGER) % 3 <> 0 OR label % 2 = 0)
  AND filename NOT IN (SELECT filename FROM fx_points WHERE page_number = 1 AND label = 7)""", "O-62 O-65 O-66")
def collection_generations(spark, d):
    """Three runs: all points; every third file anew with some of its pages; files removed whose first page has label 7."""
    store = _store(spark)
    points = FX.fx_points(spark, d).withColumn("id", F.col("id").cast("string")).withColumn("file", F.col("filename"))
    store.create_collection("content", 64)
    third = F.regexp_extract("filename", "[0-9]+", 0).cast("int") % 3 == 0
    for rows in (points, points.where(third & (F.col("label") % 2 == 0))):
        run = store.begin()
        store.write_points(run, "content", rows)
        if run.seq == 2:  # a file of which nothing is left has no points to say so
            kept = rows.groupBy("file").agg(F.count("*").alias("n_points"))
            gone = points.where(third).select("file").distinct().join(kept, "file", "left_anti").withColumn("n_points", F.lit(0))
            store.replace_files(run, "content", kept.unionByName(gone))
        store.commit(run)
    run = store.begin()
    store.replace_files(run, "content", points.where("page_number = 1 AND label = 7").select("file", F.lit(0).alias("n_points")))
    store.commit(run)
    return store.points("content").select("id", "filename", "page_number", "pagecontent", "seq")


@query("collection_rebuild", f"""
WITH k AS (SELECT object_key AS file, content_md5, text, min(object_key) OVER (PARTITION BY content_md5) AS first FROM fx_files
           WHERE trim(text, e' \\t\\n\\r\\f') <> '')
SELECT 'content' AS collection, CAST(16 AS INTEGER) AS dim, file, content_md5 AS file_hash, true AS pages_whole, {SQL_SQUEEZED.format(t='text')} AS text_md5
FROM k WHERE file = first
UNION ALL
SELECT 'content-24', 24, file, content_md5, true, {SQL_SQUEEZED.format(t='text')} FROM k""", "O-71 O-62 O-12 O-13")
def collection_rebuild(spark, d):
    """An ingest, and all its stored markdown embedded anew with another model into another collection."""
    store = _store(spark)
    files = FX.fx_files(spark, d).select(F.col("object_key").alias("key"), "text")
    IR.ingest(store, files, embed=EM.HashingEmbedder(16), name_embed=EM.HashingEmbedder(8), chunk_tokens=200)
    IR.rebuild(store, "content-24", EM.HashingEmbedder(24), "hashing-24", chunk_tokens=100)
    # the texts of one collection's files are exchanged in two parts, so that the disk holds the shuffle files of one part at a time
    out = scratch_path(spark, f"per-file-{uuid.uuid4().hex[:12]}")
    for c in ("content", "content-24"):
        points = store.points(c).withColumn("dim", F.size("vector"))
        for part in range(2):
            some = points.where(F.pmod(F.xxhash64("file"), F.lit(2)) == part)
            write_table(per_file(some, "dim", "file", "file_hash").withColumn("collection", F.lit(c)), f"{out}/{c}-{part}")
    return spark.read.parquet(*[f"{out}/{c}-{part}" for c in ("content", "content-24") for part in range(2)])


# ------------------------------------------------------------------ the texts that the jobs' points hold

_TODO_SQL = """
SELECT regexp_extract(object_key, '[^/]*$') AS filename, content_md5 AS file_hash, true AS pages_whole, {sq} AS text_md5
FROM (SELECT *, object_key = min(object_key) OVER (PARTITION BY content_md5) AS first FROM fx_files
      WHERE content_md5 NOT IN (SELECT hash FROM fx_upload))
WHERE first AND content_md5 NOT IN (SELECT md5_hash FROM fx_embedding WHERE collection_name = 'content')
  AND content_md5 NOT IN (SELECT file_hash FROM fx_resident) AND trim(text, e' \\t\\n\\r\\f') <> ''"""


@query("full_ingest_texts", _TODO_SQL.format(sq=SQL_SQUEEZED.format(t="text")), "O-106 O-27 O-60")
def full_ingest_texts(spark, d):
    """The file, pages and text behind the content points of a full ingest."""
    files = FX.fx_files(spark, d).select(F.col("object_key").alias("key"), "text")
    out = J.full_ingest(files, FX.fx_upload(spark, d), FX.fx_embedding(spark, d), FX.fx_resident(spark, d), chunk_tokens=200)
    return per_file(out.content_points, "filename", "file_hash")


@query("markdown_to_points_texts", f"""
WITH m AS (SELECT 'restored/' || regexp_replace(key, '[^/]*$', '') || name AS rkey, name AS filename, md5(text) AS file_hash, text FROM (
  SELECT *, CASE WHEN stem LIKE '%.%' THEN stem ELSE stem || '.pdf' END AS name FROM (
    SELECT *, regexp_extract(key, '([^/]+)\\.[^./]+$', 1) AS stem FROM fx_markdown WHERE lower(key) LIKE '%.md'))),
f AS (SELECT *, rkey = min(rkey) OVER (PARTITION BY file_hash) AS first FROM m)
SELECT filename, file_hash, true AS pages_whole, {SQL_SQUEEZED.format(t='text')} AS text_md5 FROM f
WHERE first AND file_hash NOT IN (SELECT md5_hash FROM fx_embedding WHERE collection_name = 'content')
  AND file_hash NOT IN (SELECT file_hash FROM fx_resident) AND trim(text, e' \\t\\n\\r\\f') <> ''""", "O-108 O-71 O-09")
def markdown_to_points_texts(spark, d):
    """The file, pages and text behind the points made of stored markdown."""
    out = J.markdown_to_points(FX.fx_markdown(spark, d), FX.fx_embedding(spark, d), FX.fx_resident(spark, d), chunk_tokens=200)
    return per_file(out.content_points, "filename", "file_hash")


@query("markdown_to_points_equal_names", f"""
SELECT 'doc.pdf' AS filename, content_md5 AS file_hash, true AS pages_whole, {SQL_SQUEEZED.format(t='text')} AS text_md5
FROM (SELECT DISTINCT content_md5, text FROM fx_files) WHERE trim(text, e' \\t\\n\\r\\f') <> ''""", "O-108")
def markdown_to_points_equal_names(spark, d):
    """Markdown of one base name in a directory of its own per document: no text or hash is mixed up."""
    md = FX.fx_files(spark, d).select(F.concat(F.lit("markdown/d"), F.col("doc_id").cast("string"), F.lit("/doc.md")).alias("key"), "text")
    out = J.markdown_to_points(md, FX.fx_embedding(spark, d).limit(0), None, chunk_tokens=200)
    return per_file(out.content_points, "filename", "file_hash")


# ------------------------------------------------------------------ six ledgers, retried files, streams, structure, vectors

def _counted_store(spark, d) -> RunStore:
    store, files = _store(spark), listed_files(spark, d)
    IR.ingest(store, files, convert=convert_text, embed=LimitedEmbedder(16, longest=LONG), name_embed=LimitedEmbedder(8, refuses=".MD"),
              chunk_tokens=1_000_000_000, attempts=1)
    return store


_EVENTS_SQL = """
events AS (
  SELECT 'conversion' AS ledger, key AS filename, hash, 'converted' AS detail FROM state1 WHERE stage IS NULL OR stage NOT IN ('pipeline', 'docling')
  UNION ALL SELECT 'upload', key, hash, 'uploaded' FROM state1 WHERE state IN ('processed', 'skipped')
  UNION ALL SELECT 'failed', key, hash, stage FROM state1 WHERE state = 'failed'
  UNION ALL SELECT 'skipped', key, hash, 'already_embedded' FROM state1 WHERE state = 'skipped'
  UNION ALL SELECT 'embedding', key, hash, c FROM state1, (VALUES ('content'), ('filenames')) t(c) WHERE state = 'processed'
  UNION ALL SELECT 'qdrant_upload', key, hash, c FROM state1, (VALUES ('content'), ('filenames')) t(c) WHERE state = 'processed')"""


@query("ledger_counts_six", "WITH " + _RUN_SQL + "," + _EVENTS_SQL + """
SELECT ledger, CAST(count(*) AS BIGINT) AS n_entries FROM events GROUP BY ledger""", "O-92")
def ledger_counts_six(spark, d):
    """Entries of all six ledgers after a run."""
    from corpusflow.operators.reports import ledger_counts
    from corpusflow.sources.ledgers import SCHEMAS
    store = _counted_store(spark, d)
    return ledger_counts({name: store.ledger(name) for name in SCHEMAS})


@query("file_history_six", "WITH " + _RUN_SQL + "," + _EVENTS_SQL + """
SELECT filename, hash, ledger, detail, CAST(row_number() OVER w AS INTEGER) AS seq, lag(ledger) OVER w AS previous_ledger
FROM events WINDOW w AS (PARTITION BY filename, hash ORDER BY ledger, detail)""", "O-104")
def file_history_six(spark, d):
    """All events of every file in all six ledgers; the events of one run are at one time."""
    from corpusflow.operators.reports import file_history
    store = _counted_store(spark, d)
    detail = {"conversion": F.lit("converted"), "upload": F.lit("uploaded"), "failed": F.col("stage"), "skipped": F.col("skip_reason"),
              "embedding": F.col("collection_name"), "qdrant_upload": F.col("collection_name")}
    events = {}
    for name, what in detail.items():
        rows = store.ledger(name)
        events[name] = rows.select("filename", F.col("hash" if "hash" in rows.columns else "md5_hash").alias("hash"),
                                   F.timestamp_seconds("seq").alias("ts"), what.alias("detail"))
    return file_history(events).select("filename", "hash", "ledger", "detail", "seq", "previous_ledger")


@query("retry_failed_texts", """
WITH src AS (SELECT regexp_extract(object_key, '[^/]*$') AS name, min(object_key) AS k FROM fx_files GROUP BY 1),
mds AS (SELECT regexp_replace(regexp_extract(key, '[^/]*$'), '^(.+)\\.[^.]+$', '\\1') AS stem, min(key) AS k FROM fx_markdown GROUP BY 1),
mdn AS (SELECT regexp_extract(key, '[^/]*$') AS name, min(key) AS k FROM fx_markdown GROUP BY 1),
w AS (SELECT DISTINCT src.k AS sk, CASE WHEN src.k IS NULL THEN least(mds.k, mdn.k) END AS mk FROM fx_failed f
  LEFT JOIN src ON src.name = f.filename LEFT JOIN mds ON mds.stem = regexp_replace(f.filename, '^(.+)\\.[^.]+$', '\\1')
  LEFT JOIN mdn ON mdn.name = f.filename),
found AS (
  SELECT regexp_extract(object_key, '[^/]*$') AS filename, text FROM fx_files JOIN w ON sk = object_key
  UNION ALL SELECT CASE WHEN stem LIKE '%.%' THEN stem ELSE stem || '.pdf' END, text FROM (
    SELECT regexp_extract(key, '([^/]+)\\.[^./]+$', 1) AS stem, text FROM fx_markdown JOIN w ON mk = key WHERE lower(key) LIKE '%.md'))
SELECT filename, md5(text) AS file_hash, true AS pages_whole, """ + SQL_SQUEEZED.format(t="text") + """ AS text_md5
FROM found WHERE trim(text, e' \\t\\n\\r\\f') <> ''""", "O-109 O-101")
def retry_failed_texts(spark, d):
    """The file, pages and text behind the points of all failed files that were found again."""
    src = FX.fx_files(spark, d).select(F.col("object_key").alias("key"), "text")
    points, _remaining, _summary = J.retry_failed(FX.fx_failed(spark, d), src, FX.fx_markdown(spark, d), FX.fx_embedding(spark, d), FX.fx_resident(spark, d))
    return per_file(points, "filename", "file_hash")


@query("stream_dedup", "SELECT DISTINCT md5(text) AS hash FROM documents", "O-111 O-46")
def stream_dedup(spark, d):
    """Each content once, from a stream of documents that arrives twice: the second batch repeats the first within the watermark."""
    from corpusflow.streaming.ingest import run_to_files, stream_dedup as dedup
    source = scratch_path(spark, f"dedup-in-{uuid.uuid4().hex[:10]}")
    docs = FX.table(spark, d, "documents").select("doc_id", "text").withColumn("ts", F.expr("timestamp'2025-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, doc_id % 600)"))
    for _ in range(2):  # an arrival is a batch of any number of files: the stream goes on from its checkpoint
        docs.write.mode("append").parquet(source)
        stream = spark.readStream.schema(docs.schema).parquet(source)
        found = run_to_files(dedup(stream, "ts").select("hash"), f"{source}-out", f"{source}-ckpt")
    return found


@query("html_structure", """
SELECT page_id, CAST(len(regexp_extract_all(html, '<a [^>]*href="[^"]+"')) AS BIGINT) AS n_links,
  CAST(len(regexp_extract_all(html, '<li>')) AS BIGINT) AS n_items,
  CAST(len(regexp_extract_all(html, '<h1>')) AS BIGINT) AS n_titles, false AS has_script FROM pages""", "O-15")
def html_structure(spark, d):
    """Links, list items and titles that the structured conversion of every page keeps."""
    from corpusflow.operators.html_structure import convert_structured
    md = convert_structured(FX.table(spark, d, "pages"))
    return md.select("page_id", F.regexp_count("markdown", F.lit(r"\]\(/")).cast("bigint").alias("n_links"),
                     F.regexp_count("markdown", F.lit("(?m)^ *- ")).cast("bigint").alias("n_items"),
                     F.regexp_count("markdown", F.lit("(?m)^# ")).cast("bigint").alias("n_titles"),
                     F.col("markdown").contains("track(0)").alias("has_script"))


@query("batch_embed_buckets", r"""
WITH t AS (SELECT doc_id, lower(unnest(regexp_extract_all(text, '[\p{L}\p{N}]+'))) AS tok FROM documents),
b AS (SELECT doc_id, CAST(CAST('0x' || substr(md5(tok), 1, 8) AS BIGINT) % 64 AS INTEGER) AS bucket, count(*) AS n FROM t GROUP BY ALL)
SELECT d.doc_id, CAST(count(bucket) AS INTEGER) AS n_buckets, first(bucket ORDER BY n DESC, bucket) AS top_bucket
FROM documents d LEFT JOIN b USING (doc_id) GROUP BY d.doc_id""", "O-50 O-58")
def batch_embed_buckets(spark, d):
    """The dimensions that a document's vector uses, and the largest of them."""
    out = EM.batch_embed(FX.table(spark, d, "documents").select("doc_id", "text"), EM.HashingEmbedder(64), keep=("doc_id",))
    used = F.filter("vector", lambda x: x > 0)
    top = F.array_position("vector", F.array_max("vector")) - 1
    return out.select("doc_id", F.size(used).alias("n_buckets"), F.when(F.size(used) > 0, top).cast("int").alias("top_bucket"))


@query("listing_changes", """
SELECT f.object_key AS key,
  CASE WHEN l.doc_id IS NULL THEN 'new' WHEN l.toxic = 1 THEN 'removed' WHEN l.quality = 1 THEN 'changed' ELSE 'same' END AS state,
  CAST(f.size + CASE WHEN l.toxic = 0 AND l.quality = 1 THEN 7 ELSE 0 END AS BIGINT) AS size,
  CASE WHEN l.toxic = 0 AND l.quality = 1 THEN md5(f.text || ' edited') ELSE f.content_md5 END AS etag,
  l.doc_id IS NULL OR l.toxic = 0 AS listed
FROM fx_files f LEFT JOIN labels l USING (doc_id)""", "O-01 O-40")
def listing_changes(spark, d):
    """Two listings recorded one after the other: the labelled files, then all files without the toxic ones and with the good ones edited."""
    from corpusflow.sources import snapshots as SN
    store = _store(spark)
    files = FX.fx_files(spark, d).join(FX.table(spark, d, "labels"), "doc_id", "left")
    entry = [F.col("object_key").alias("key"), F.col("ts").alias("last_modified")]
    SN.record(store, files.where("toxic is not null").select(*entry, "size", F.col("content_md5").alias("etag")))
    edited = F.coalesce(F.col("quality") == 1, F.lit(False))
    text = F.when(edited, F.concat("text", F.lit(" edited"))).otherwise(F.col("text"))
    now = files.where("toxic is null or toxic = 0").select(
        *entry, (F.col("size") + F.when(edited, 7).otherwise(0)).alias("size"), F.md5(text).alias("etag"))
    changed = SN.record(store, now)
    listed = SN.latest(store).select("key", F.lit(True).alias("listed"))
    return changed.join(listed, "key", "left").select("key", "state", "size", "etag", F.coalesce("listed", F.lit(False)).alias("listed"))
