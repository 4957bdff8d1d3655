"""Registered queries, part 2: dedup, embedding, points, filters."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions import hashing as H
from corpusflow.functions import paths as P
from corpusflow.functions import text as TX
from corpusflow.operators import dedup as DD
from corpusflow.operators import embedding as EM
from corpusflow.operators import filters as FL
from corpusflow.operators import points as PT
from corpusflow.plans import fixtures as FX
from corpusflow.plans.catalog import WORD_RE, _SQL_UUID5, query

# ------------------------------------------------------------------ dedup


def _listing(spark, d):
    return FX.fx_files(spark, d).select(F.col("object_key").alias("filename"),
                                        F.col("content_md5").alias("hash"), "size", "doc_id")


@query("processed_hashes", """
SELECT DISTINCT hash FROM (SELECT hash FROM fx_conversion UNION ALL SELECT hash FROM fx_upload)
WHERE hash IS NOT NULL AND hash <> ''""", "O-39")
def processed_hashes(spark, d):
    return DD.processed_hashes(FX.fx_conversion(spark, d), FX.fx_upload(spark, d))


@query("new_files", """
SELECT object_key AS key FROM fx_files f WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT hash FROM fx_conversion UNION SELECT hash FROM fx_upload) p WHERE p.hash = f.content_md5)""",
       "O-40")
def new_files(spark, d):
    listing = FX.fx_files(spark, d).select(F.col("object_key").alias("key"), F.col("content_md5").alias("etag"))
    processed = DD.processed_hashes(FX.fx_conversion(spark, d), FX.fx_upload(spark, d))
    return DD.new_files(listing, processed).select("key")


@query("already_converted_uploaded", """
SELECT object_key AS key,
  content_md5 IN (SELECT hash FROM fx_conversion) AS converted,
  content_md5 IN (SELECT hash FROM fx_upload) AS uploaded
FROM fx_files""", "O-41")
def already_converted_uploaded(spark, d):
    f = _listing(spark, d)
    f = DD.in_ledger(f, FX.fx_conversion(spark, d), flag="converted")
    f = DD.in_ledger(f, FX.fx_upload(spark, d), flag="uploaded")
    return f.select(F.col("filename").alias("key"), "converted", "uploaded")


@query("already_embedded", """
SELECT object_key AS key,
  content_md5 IN (SELECT md5_hash FROM fx_embedding) AS embedded_any,
  content_md5 IN (SELECT md5_hash FROM fx_embedding WHERE collection_name = 'content') AS embedded_content
FROM fx_files""", "O-42")
def already_embedded(spark, d):
    f = _listing(spark, d).withColumn("collection_name", F.lit("content"))
    led = FX.fx_embedding(spark, d)
    f = DD.already_embedded(f, led, flag="embedded_any")
    f = DD.already_embedded(f, led, collection_col="collection_name", flag="embedded_content")
    return f.select(F.col("filename").alias("key"), "embedded_any", "embedded_content")


@query("already_in_collection", """
SELECT object_key AS key, content_md5 IN (SELECT file_hash FROM fx_resident) AS in_collection FROM fx_files""",
       "O-43")
def already_in_collection(spark, d):
    f = DD.already_in_collection(_listing(spark, d), FX.fx_resident(spark, d))
    return f.select(F.col("filename").alias("key"), "in_collection")


_DECISION_SQL = """
WITH base AS (
  SELECT f.object_key AS key, e.first_ts,
    f.content_md5 IN (SELECT file_hash FROM fx_resident WHERE collection_name = 'content') AS in_coll,
    f.object_key = min(f.object_key) OVER (PARTITION BY f.content_md5) AS is_first,
    {forced} AS forced
  FROM fx_files f LEFT JOIN (SELECT md5_hash, min(timestamp) AS first_ts FROM fx_embedding
                             WHERE collection_name = 'content' GROUP BY md5_hash) e ON e.md5_hash = f.content_md5),
r AS (SELECT *, {reason} AS skip_reason, {place} AS found_in FROM base)
SELECT key, CASE WHEN skip_reason IS NULL THEN 'process' ELSE 'skip' END AS action, skip_reason, found_in,
  CAST(first_ts AS VARCHAR) AS original_processing_date FROM r"""


def _decision(spark, d, four: bool):
    f = _listing(spark, d)
    skip = FX.fx_failed(spark, d).where("stage = 'reprocess'").select("hash") if four else None
    dec = DD.dedup_decision(f, FX.fx_embedding(spark, d), FX.fx_resident(spark, d),
                            collection="content", four_reasons=four, skip_list=skip)
    return dec.select(F.col("filename").alias("key"), "action", "skip_reason", "found_in",
                      F.col("original_processing_date").cast("string").alias("original_processing_date"))


@query("dedup_decision", _DECISION_SQL.format(
    forced="false",
    reason="CASE WHEN first_ts IS NOT NULL THEN 'already_embedded' WHEN in_coll THEN 'already_in_qdrant' "
           "WHEN NOT is_first THEN 'already_embedded' END",
    place="CASE WHEN first_ts IS NOT NULL THEN 'log_file' WHEN in_coll THEN 'qdrant_collection' "
          "WHEN NOT is_first THEN 'log_file' END"), "O-44 O-46")
def dedup_decision(spark, d):
    return _decision(spark, d, False)


@query("dedup_decision_four", _DECISION_SQL.format(
    forced="f.content_md5 IN (SELECT hash FROM fx_failed WHERE stage = 'reprocess')",
    reason="CASE WHEN forced THEN 'force_skip' WHEN first_ts IS NOT NULL AND in_coll THEN 'duplicate_detected' "
           "WHEN first_ts IS NOT NULL THEN 'already_embedded' WHEN in_coll THEN 'already_in_qdrant' "
           "WHEN NOT is_first THEN 'already_embedded' END",
    place="CASE WHEN forced THEN 'configuration' WHEN first_ts IS NOT NULL AND in_coll THEN 'both' "
          "WHEN first_ts IS NOT NULL THEN 'log_file' WHEN in_coll THEN 'qdrant_collection' "
          "WHEN NOT is_first THEN 'log_file' END"), "O-45")
def dedup_decision_four(spark, d):
    return _decision(spark, d, True)


@query("in_run_duplicates", """
SELECT object_key AS key, object_key = min(object_key) OVER (PARTITION BY content_md5) AS first_in_run
FROM fx_files""", "O-46")
def in_run_duplicates(spark, d):
    f = DD.first_in_run(_listing(spark, d), "hash", "filename")
    return f.select(F.col("filename").alias("key"), "first_in_run")


@query("force_reprocess", "SELECT object_key AS key, 'process' AS action FROM fx_files", "O-47")
def force_reprocess(spark, d):
    dec = DD.dedup_decision(_listing(spark, d), FX.fx_embedding(spark, d), FX.fx_resident(spark, d),
                            collection="content", force=True)
    return dec.select(F.col("filename").alias("key"), "action")


@query("dedup_lookup_report", """
SELECT hash, hash IN (SELECT md5_hash FROM fx_embedding) AS in_embedding_log,
  hash IN (SELECT file_hash FROM fx_resident) AS in_qdrant,
  hash IN (SELECT md5_hash FROM fx_embedding) OR hash IN (SELECT file_hash FROM fx_resident) AS should_skip
FROM (SELECT DISTINCT content_md5 AS hash FROM fx_files)""", "O-48")
def dedup_lookup_report(spark, d):
    hashes = FX.fx_files(spark, d).select(F.col("content_md5").alias("hash")).distinct()
    return DD.lookup_report(hashes, FX.fx_embedding(spark, d), FX.fx_resident(spark, d))


@query("duplicate_groups", """
SELECT content_md5 AS hash, CAST(count(*) AS BIGINT) AS n_files, min(object_key) AS first_key,
  max(object_key) AS last_key FROM fx_files GROUP BY content_md5 HAVING count(*) > 1""", "O-49")
def duplicate_groups(spark, d):
    return DD.duplicate_groups(_listing(spark, d))


# ------------------------------------------------------------------ embedding

def _docs(spark, d):
    return FX.table(spark, d, "documents")


@query("batch_embed", "SELECT doc_id, 64 AS dim, true AS ok FROM documents", "O-50")
def batch_embed(spark, d):
    from corpusflow.operators.chunking import ensure_parallelism
    docs = ensure_parallelism(_docs(spark, d).select("doc_id", "text"), 8)
    out = EM.batch_embed(docs, EM.HashingEmbedder(64), keep=("doc_id",), batch_size=100)
    return out.select("doc_id", F.size("vector").alias("dim"), F.col("embed_error").isNull().alias("ok"))


class PipeRejectingEmbedder:
    """Test embedder: any call whose texts contain '|' fails (a bad batch)."""

    def __init__(self, dim: int = 16):
        self.inner = EM.HashingEmbedder(dim)

    def __call__(self, texts):
        if any("|" in t for t in texts):
            raise ValueError("rejected input")
        return self.inner(texts)


class ShortResultEmbedder:
    """Test embedder: drops the last vector of slices longer than 50 texts."""

    def __init__(self, dim: int = 16):
        self.inner = EM.HashingEmbedder(dim)

    def __call__(self, texts):
        out = self.inner(texts)
        return out[:-1] if len(texts) > 50 else out


@query("embed_with_fallback", "SELECT doc_id, NOT contains(text, '|') AS has_vector FROM documents", "O-51")
def embed_with_fallback(spark, d):
    out = EM.batch_embed(_docs(spark, d).select("doc_id", "text"), PipeRejectingEmbedder(), keep=("doc_id",),
                         batch_size=100, min_wait=0.0, max_wait=0.0)
    return out.select("doc_id", F.col("vector").isNotNull().alias("has_vector"))


@query("embed_length_check", "SELECT doc_id, true AS has_vector FROM documents", "O-52")
def embed_length_check(spark, d):
    out = EM.batch_embed(_docs(spark, d).select("doc_id", "text"), ShortResultEmbedder(), keep=("doc_id",),
                         batch_size=100, min_wait=0.0, max_wait=0.0)
    return out.select("doc_id", F.col("vector").isNotNull().alias("has_vector"))


@query("two_model_embed", """
SELECT 'filenames' AS collection, 32 AS dim, CAST(count(*) AS BIGINT) AS n_vectors FROM fx_files
UNION ALL SELECT 'content', 64, CAST(count(*) AS BIGINT) FROM documents""", "O-53")
def two_model_embed(spark, d):
    names = FX.fx_files(spark, d).select(F.col("doc_id"), P.basename("object_key").alias("text"))
    nv = EM.batch_embed(names, EM.HashingEmbedder(32), keep=("doc_id",))
    cv = EM.batch_embed(_docs(spark, d).select("doc_id", "text"), EM.HashingEmbedder(64), keep=("doc_id",))
    a = nv.groupBy(F.lit("filenames").alias("collection"), F.size("vector").alias("dim")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_vectors"))
    b = cv.groupBy(F.lit("content").alias("collection"), F.size("vector").alias("dim")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_vectors"))
    return a.unionByName(b)


@query("model_dimensions", """
WITH spec(collection, model, override_dim) AS (VALUES ('content', 'bge-m3', 64), ('filenames', 'granite-embedding:30m', NULL)),
measured AS (SELECT 'content' AS collection, CAST(min(len(embedding)) AS INTEGER) AS actual_dim FROM embeddings
             UNION ALL SELECT 'filenames', 32)
SELECT s.collection, s.model, CAST(coalesce(s.override_dim, CASE WHEN s.model LIKE '%granite-embedding:30m%' THEN 384
  WHEN s.model LIKE '%bge-m3%' THEN 1024 ELSE 768 END) AS INTEGER) AS expected_dim, m.actual_dim,
  coalesce(s.override_dim, CASE WHEN s.model LIKE '%granite-embedding:30m%' THEN 384
  WHEN s.model LIKE '%bge-m3%' THEN 1024 ELSE 768 END) = m.actual_dim AS ok
FROM spec s JOIN measured m USING (collection)""", "O-54")
def model_dimensions(spark, d):
    spec = [("content", "bge-m3", 64), ("filenames", "granite-embedding:30m", None)]
    expected = spark.createDataFrame([(c, m, EM.model_dimension(m, o)) for c, m, o in spec],
                                     "collection string, model string, expected_dim int")
    content = FX.table(spark, d, "embeddings").agg(F.min(F.size("embedding")).cast("int").alias("actual_dim")) \
        .withColumn("collection", F.lit("content"))
    names = FX.fx_files(spark, d).select("doc_id", P.basename("object_key").alias("text"))
    nv = EM.batch_embed(names, EM.HashingEmbedder(32), keep=("doc_id",)).agg(
        F.min(F.size("vector")).cast("int").alias("actual_dim")).withColumn("collection", F.lit("filenames"))
    measured = content.unionByName(nv)
    return expected.join(measured, "collection").withColumn("ok", F.col("expected_dim") == F.col("actual_dim"))


@query("dimension_validation", """
SELECT CAST(count(*) AS BIGINT) AS n_vectors, CAST(count_if(embedding IS NULL OR len(embedding) <> 64) AS BIGINT) AS n_wrong,
  CAST(min(len(embedding)) AS INTEGER) AS min_dim, CAST(max(len(embedding)) AS INTEGER) AS max_dim, 64 AS expected_dim
FROM embeddings""", "O-55")
def dimension_validation(spark, d):
    return EM.dimension_check(FX.table(spark, d, "embeddings"), "embedding", 64)


@query("embedding_ledger_rows", """
SELECT object_key AS filename, content_md5 AS md5_hash, 'content' AS collection_name, 'hashing-64' AS model_name,
  'success' AS status FROM fx_files WHERE length(trim(text)) > 0""", "O-56")
def embedding_ledger_rows(spark, d):
    from corpusflow.operators.chunking import chunk_documents
    f = FX.fx_files(spark, d).select(F.col("object_key").alias("filename"), "text",
                                     F.col("content_md5").alias("file_hash"))
    ch = chunk_documents(f, keep=("file_hash",))
    emb = EM.batch_embed(ch, EM.HashingEmbedder(64), keep=("filename", "file_hash", "chunk_number"))
    rows = EM.embedding_ledger_rows(emb, "filename", "file_hash", "content", "hashing-64")
    return rows.select("filename", "md5_hash", "collection_name", "model_name", "status")


@query("precomputed_vectors", """
SELECT doc_id, CAST(len(e.embedding) AS INTEGER) AS dim FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id""",
       "O-57")
def precomputed_vectors(spark, d):
    vec = FX.table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"))
    out = EM.attach_precomputed(_docs(spark, d).select("doc_id"), vec, "doc_id")
    return out.select("doc_id", F.size("vector").alias("dim")).select(
        "doc_id", F.when(F.col("dim") >= 0, F.col("dim")).alias("dim"))


@query("hashing_embedder", f"""
WITH t AS (SELECT doc_id, lower(unnest(regexp_extract_all(text, '{WORD_RE}'))) AS tok FROM documents),
b AS (SELECT doc_id, CAST(CAST('0x' || substr(md5(tok), 1, 8) AS BIGINT) % 64 AS INTEGER) AS bucket,
             CAST(count(*) AS DOUBLE) AS cnt FROM t GROUP BY doc_id, bucket)
SELECT doc_id, bucket, round(cnt / sqrt(sum(cnt * cnt) OVER (PARTITION BY doc_id)), 6) AS weight FROM b""", "O-58")
def hashing_embedder(spark, d):
    b = EM.hashing_buckets(_docs(spark, d), ["doc_id"], "text", 64)
    return b.select("doc_id", "bucket", F.round("weight", 6).alias("weight"))


# ------------------------------------------------------------------ points

@query("filename_points", f"""
SELECT {_SQL_UUID5.format(h='h')} AS id, name AS pagecontent, object_key AS source, content_md5 AS file_hash
FROM (SELECT object_key, content_md5, regexp_extract(object_key, '[^/]*$') AS name,
  sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(regexp_extract(object_key, '[^/]*$'))) AS h FROM fx_files)""",
       "O-59")
def filename_points(spark, d):
    return PT.filename_points(FX.fx_files(spark, d), "object_key", hash_col="content_md5")


def _chunks_from_points(spark, d):
    p = FX.fx_points(spark, d)
    return p.select("filename", F.col("page_number").alias("chunk_number"), F.col("pagecontent").alias("text"),
                    "element_type", H.text_md5("pagecontent").alias("md5_hash"), "vector")


@query("content_points", f"""
SELECT {_SQL_UUID5.format(h='h')} AS id, filename, page_number, element_type, md5(pagecontent) AS md5_hash
FROM (SELECT *, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(filename || '_' || CAST(page_number AS VARCHAR))) AS h
      FROM fx_points WHERE vector IS NOT NULL)""", "O-60")
def content_points(spark, d):
    pts = PT.content_points(_chunks_from_points(spark, d), file_hash_col=None)
    return pts.select("id", "filename", "page_number", "element_type", "md5_hash")


@query("length_agreement", """
WITH c AS (SELECT source AS filename, CAST(count(*) AS BIGINT) AS n_chunks FROM documents GROUP BY source),
v AS (SELECT d.source AS filename, CAST(count(*) AS BIGINT) AS n_vectors FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id GROUP BY d.source)
SELECT coalesce(c.filename, v.filename) AS filename, coalesce(n_chunks, 0) AS n_chunks, coalesce(n_vectors, 0) AS n_vectors,
  coalesce(n_chunks, 0) = coalesce(n_vectors, 0) AS lengths_agree FROM c FULL OUTER JOIN v ON c.filename = v.filename""",
       "O-61")
def length_agreement(spark, d):
    docs = _docs(spark, d).select("doc_id", F.col("source").alias("filename"))
    vec = FX.table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"))
    return PT.length_agreement(docs, docs.join(vec, "doc_id"))


@query("upsert_points", """
WITH u AS (SELECT id, pagecontent, 1 AS version FROM fx_points
           UNION ALL SELECT id, pagecontent || ' (re-embedded)', 2 FROM fx_points WHERE label = 0)
SELECT id, pagecontent, version FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC) AS rn FROM u) WHERE rn = 1""", "O-62")
def upsert_points(spark, d):
    from corpusflow.sources.collections import upsert
    p = FX.fx_points(spark, d)
    old = p.select("id", "pagecontent", F.lit(1).alias("version"))
    new = p.where("label = 0").select("id", F.concat("pagecontent", F.lit(" (re-embedded)")).alias("pagecontent"),
                                      F.lit(2).alias("version"))
    return upsert(old, new)


@query("write_batches", """
SELECT id, filename, CAST(floor((row_number() OVER (PARTITION BY filename ORDER BY page_number, id) - 1) / 4) + 1 AS INTEGER) AS batch_number,
  CAST(ceil(count(*) OVER (PARTITION BY filename) / 4) AS INTEGER) AS batch_count FROM fx_points""", "O-63")
def write_batches(spark, d):
    return PT.write_batches(FX.fx_points(spark, d), 4).select("id", "filename", "batch_number", "batch_count")


@query("upload_ledger_rows", """
SELECT filename, CAST(count(*) AS INTEGER) AS points_uploaded, 100 AS batch_size FROM fx_points GROUP BY filename""", "O-64")
def upload_ledger_rows(spark, d):
    pts = PT.content_points(_chunks_from_points(spark, d))
    return PT.upload_ledger_rows(pts, 100, "content").select("filename", "points_uploaded", "batch_size")


@query("upload_point_ids", f"""
SELECT filename, page_number, {_SQL_UUID5.format(h='h')} AS point_id FROM (
  SELECT *, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(filename || '_' || CAST(page_number AS VARCHAR))) AS h FROM fx_points)""", "O-64")
def upload_point_ids(spark, d):
    """All ids of every file, not its first few."""
    return PT.upload_point_ids(PT.content_points(_chunks_from_points(spark, d)))


@query("collection_info", """
SELECT 'content' AS name, CAST(count(*) AS BIGINT) AS points_count, CAST(count(vector) AS BIGINT) AS vectors_count,
  'green' AS status FROM fx_points""", "O-66")
def collection_info(spark, d):
    return PT.collection_info(FX.fx_points(spark, d), "content")


@query("scroll_page", """
SELECT id, filename, page_number FROM fx_points WHERE element_type = 'Text' AND id > 100 ORDER BY id LIMIT 64""", "O-67")
def scroll_page(spark, d):
    return PT.scroll(FX.fx_points(spark, d), 64, after_id=100, condition=FL.match("element_type", "Text"),
                     payload=("filename", "page_number"))


@query("sample_view", """
SELECT doc_id AS id, CAST(len(v) AS INTEGER) AS dim, round(CAST(v[1] AS DOUBLE), 6) AS v0, round(CAST(v[2] AS DOUBLE), 6) AS v1,
  round(CAST(v[3] AS DOUBLE), 6) AS v2, round(CAST(v[4] AS DOUBLE), 6) AS v3, round(CAST(v[5] AS DOUBLE), 6) AS v4,
  CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE text END AS preview
FROM (SELECT d.doc_id, d.text, e.embedding AS v FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id)
ORDER BY doc_id LIMIT 10""", "O-68")
def sample_view(spark, d):
    docs = _docs(spark, d).select(F.col("doc_id").alias("id"), F.col("text").alias("pagecontent"))
    vec = FX.table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return PT.sample_view(docs.join(vec, "id"), 10)


@query("vector_profile", """
SELECT CAST(len(embedding) AS INTEGER) AS dim, CAST(count(*) AS BIGINT) AS n_points FROM embeddings GROUP BY 1""", "O-69")
def vector_profile(spark, d):
    return PT.vector_profile(FX.table(spark, d, "embeddings"), "embedding")


_EXPECTED_FIELDS = ("pagecontent", "filename", "page_number", "element_type", "md5_hash", "vector")


@query("payload_presence", """
WITH n AS (SELECT count(*) AS n, count(pagecontent) AS c0, count(filename) AS c1, count(page_number) AS c2,
  count(element_type) AS c3, 0 AS c4, count(vector) AS c5 FROM fx_points)
SELECT field, CAST(present AS BIGINT) AS present, present = n AS in_all FROM (
  SELECT 'pagecontent' AS field, c0 AS present, n FROM n UNION ALL SELECT 'filename', c1, n FROM n
  UNION ALL SELECT 'page_number', c2, n FROM n UNION ALL SELECT 'element_type', c3, n FROM n
  UNION ALL SELECT 'md5_hash', c4, n FROM n UNION ALL SELECT 'vector', c5, n FROM n)""", "O-70")
def payload_presence(spark, d):
    return PT.payload_presence(FX.fx_points(spark, d), _EXPECTED_FIELDS)


# ------------------------------------------------------------------ filters

@query("filter_exact", "SELECT id FROM fx_points WHERE element_type = 'Table'", "O-72")
def filter_exact(spark, d):
    return FX.fx_points(spark, d).where(FL.match("element_type", "Table")).select("id")


@query("filter_any", """
SELECT id FROM fx_points WHERE filename IN ('doc_1.pdf', 'doc_7.pdf', 'doc_42.pdf')""", "O-73")
def filter_any(spark, d):
    return FX.fx_points(spark, d).where(FL.match_any("filename", ["doc_1.pdf", "doc_7.pdf", "doc_42.pdf"])).select("id")


@query("filter_any_table", """
SELECT object_key AS key FROM fx_files WHERE content_md5 IN (SELECT hash FROM fx_failed)""", "O-73")
def filter_any_table(spark, d):
    f = FX.fx_files(spark, d).select(F.col("object_key").alias("key"), F.col("content_md5").alias("hash"))
    return FL.match_any_table(f, "hash", FX.fx_failed(spark, d), "hash").select("key")


@query("filter_text", f"""
SELECT doc_id FROM (SELECT doc_id, list_transform(regexp_extract_all(text, '{WORD_RE}'), lambda w: lower(w)) AS t FROM documents)
WHERE list_contains(t, 'the') AND list_contains(t, 'and')""", "O-74")
def filter_text(spark, d):
    return _docs(spark, d).where(FL.match_text("text", "The AND")).select("doc_id")


@query("filter_phrase", f"""
SELECT doc_id FROM documents
WHERE (' ' || array_to_string(list_transform(regexp_extract_all(text, '{WORD_RE}'), lambda w: lower(w)), ' ') || ' ')
  LIKE '% of the %'""", "O-75")
def filter_phrase(spark, d):
    return FL.phrase_match(_docs(spark, d), "text", "of the", "doc_id").select("doc_id")


@query("filter_range", """
SELECT id, page_number FROM fx_points WHERE page_number >= 3 AND page_number <= 7 AND id > 100""", "O-76")
def filter_range(spark, d):
    return FX.fx_points(spark, d).where(FL.range_filter("page_number", gte=3, lte=7) & FL.range_filter("id", gt=100)) \
        .select("id", "page_number").orderBy("page_number", "id")


@query("filter_range_time", """
SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-11 00:00:00'""",
       "O-76")
def filter_range_time(spark, d):
    lo = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    hi = F.lit("2024-01-11 00:00:00").cast("timestamp_ntz")
    return FX.table(spark, d, "events").where(FL.range_filter("ts", gte=lo, lt=hi)).select("event_id")


_HAV = ("2 * 6371008.8 * asin(least(1.0, sqrt(pow(sin((radians(lat) - radians(0.0)) / 2), 2) + "
        "cos(radians(0.0)) * cos(radians(lat)) * pow(sin((radians(lon) - radians(0.0)) / 2), 2))))")


@query("geo_radius", f"""
SELECT s_suppkey, round({_HAV} / 1000, 3) AS distance_km FROM fx_geo
WHERE lat BETWEEN -{2000000 / 6371008.8 * 57.29577951308232!r} AND {2000000 / 6371008.8 * 57.29577951308232!r}
  AND {_HAV} <= 2000000""", "O-77")
def geo_radius(spark, d):
    g = FX.fx_geo(spark, d)
    return g.where(FL.geo_radius("lon", "lat", 0.0, 0.0, 2_000_000)).select(
        "s_suppkey", F.round(FL.haversine_m(F.lit(0.0), F.lit(0.0), "lon", "lat") / 1000, 3).alias("distance_km"))


@query("geo_bbox", """
SELECT s_suppkey FROM fx_geo WHERE lon BETWEEN -30 AND 60 AND lat BETWEEN -20 AND 45""", "O-77")
def geo_bbox(spark, d):
    return FX.fx_geo(spark, d).where(FL.geo_bbox("lon", "lat", (-30, 45), (60, -20))).select("s_suppkey")


def _payload_table(spark, d):
    p = FX.fx_points(spark, d)
    name = F.concat("filename", F.lit("_"), F.col("page_number").cast("string"))
    created = F.date_format(F.expr("timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(0, 0, CAST(id AS INT), 0)"),
                            "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return p.select(
        "id", "vector",
        F.col("pagecontent"),
        F.struct(F.col("filename"), F.col("page_number"), F.col("element_type"),
                 H.uuid5(name).alias("point_uuid"), created.alias("created_at"),
                 (F.col("label") % 2 == 0).alias("is_even_label"),
                 (F.col("id") / 8.0).alias("weight")).alias("metadata"),
        F.struct(((F.col("id") * 37) % 360 - 180).cast("double").alias("lon"),
                 ((F.col("id") * 17) % 180 - 90).cast("double").alias("lat")).alias("location"))


_PAYLOAD_SQL = f"""
WITH p AS (SELECT id, pagecontent, filename, page_number, element_type,
  {_SQL_UUID5.format(h='h')} AS point_uuid,
  strftime(TIMESTAMP '2025-01-01 00:00:00' + id * INTERVAL '1 minute', '%Y-%m-%dT%H:%M:%SZ') AS created_at,
  label % 2 = 0 AS is_even_label, id / 8.0 AS weight,
  CAST(to_json({{'lon': CAST((id * 37) % 360 - 180 AS DOUBLE), 'lat': CAST((id * 17) % 180 - 90 AS DOUBLE)}}) AS VARCHAR) AS location
  FROM (SELECT *, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(filename || '_' || CAST(page_number AS VARCHAR))) AS h FROM fx_points)),
leaves AS (
  SELECT 'id' AS path, 'int' AS type, 'integer' AS kind, CAST(id AS VARCHAR) AS sval FROM p
  UNION ALL SELECT 'pagecontent', 'str', 'keyword', pagecontent FROM p
  UNION ALL SELECT 'metadata.filename', 'str', 'keyword', filename FROM p
  UNION ALL SELECT 'metadata.page_number', 'int', 'integer', CAST(page_number AS VARCHAR) FROM p
  UNION ALL SELECT 'metadata.element_type', 'str', 'keyword', element_type FROM p
  UNION ALL SELECT 'metadata.point_uuid', 'str', 'uuid', point_uuid FROM p
  UNION ALL SELECT 'metadata.created_at', 'str', 'datetime', created_at FROM p
  UNION ALL SELECT 'metadata.is_even_label', 'bool', 'bool', CAST(is_even_label AS VARCHAR) FROM p
  UNION ALL SELECT 'metadata.weight', 'float', 'float', CAST(weight AS VARCHAR) FROM p
  UNION ALL SELECT 'location', 'dict', 'geo', location FROM p)"""


@query("payload_profile", _PAYLOAD_SQL + """
SELECT path, type, min(kind) AS suggested_index, CAST(count(*) AS BIGINT) AS non_null,
  CASE WHEN length(min(sval)) > 50 THEN substr(min(sval), 1, 50) || '...' ELSE min(sval) END AS sample
FROM leaves WHERE path <> 'metadata.weight' GROUP BY path, type""", "O-78")
def payload_profile(spark, d):
    prof = FL.payload_profile(_payload_table(spark, d))
    return prof.where(F.col("path") != "metadata.weight")


@query("payload_types", _PAYLOAD_SQL + """
SELECT path, kind, CAST(count(*) AS BIGINT) AS n_values FROM leaves GROUP BY path, kind""", "O-79")
def payload_types(spark, d):
    from corpusflow.operators.filters import leaf_paths, value_type
    t = _payload_table(spark, d)
    leaves = [(p, dt) for p, dt in leaf_paths(t.schema) if p != "vector"]
    rows = [F.struct(F.lit(p).alias("path"), value_type(F.col(p), dt).alias("kind")) for p, dt in leaves]
    ex = t.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return ex.groupBy("path", "kind").agg(F.count(F.lit(1)).cast("bigint").alias("n_values"))


@query("index_kinds", _PAYLOAD_SQL + """,
kinds(index_kind, python_type, options) AS (VALUES ('keyword', 'str', 'is_tenant,on_disk'), ('integer', 'int', 'is_principal,on_disk'),
  ('float', 'float', 'is_principal,on_disk'), ('bool', 'bool', 'on_disk'), ('geo', 'dict', 'on_disk'), ('datetime', 'str', 'on_disk'),
  ('uuid', 'str', 'on_disk'), ('text', 'str', 'tokenizer,min_token_len,max_token_len,lowercase,phrase_matching,on_disk')),
prof AS (SELECT path, type, min(kind) AS suggested_index FROM leaves GROUP BY path, type)
SELECT path, index_kind, index_kind = suggested_index AS is_suggested FROM prof JOIN kinds ON kinds.python_type = prof.type""",
       "O-80")
def index_kinds(spark, d):
    prof = FL.payload_profile(_payload_table(spark, d))
    return FL.compatible_indexes(prof).select("path", "index_kind", "is_suggested")
