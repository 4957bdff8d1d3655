"""Registered queries: one Spark DataFrame builder per operator plus its DuckDB
oracle SQL (None where the result is not SQL-expressible; those are checked
by invariants in other queries and by brute-force unit tests).

Every query reads whole driver tables (or views Spark derives from them).
Computed columns carry the same alias on both sides; counts are BIGINT,
scores are rounded to 6 decimals, arrays are joined to strings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions import hashing as H
from corpusflow.functions import paths as P
from corpusflow.functions import text as TX
from corpusflow.operators import chunking as CH
from corpusflow.plans import fixtures as FX

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None, str]] = {}


def query(name: str, sql: str | None, ops: str):
    """Register a query under ``name`` with its oracle SQL and operator ids."""
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, FX.with_views(sql) if sql else None, ops)
        return fn
    return deco


# Shared SQL fragments (DuckDB).
SQL_BASENAME = "regexp_extract({k}, '[^/]*$')"
SQL_MIRROR = "('markdown/' || regexp_replace(substr({k}, 8), '\\.[^./]+$', '') || '.md')"
TOKEN_RE = r"[\p{L}\p{N}]+|[^ \t\n\r\f\p{L}\p{N}]"
WORD_RE = r"[\p{L}\p{N}]+"


def _files(spark, d):
    return FX.fx_files(spark, d)


# ------------------------------------------------------------------ sources / paths

@query("corpus_listing", """
SELECT object_key AS key, size, content_md5 AS etag FROM fx_files
WHERE object_key LIKE 'source/%' AND NOT ends_with(object_key, '/')""", "O-01 O-02")
def corpus_listing(spark, d):
    f = _files(spark, d).where(P.with_prefix("object_key", "source/") & ~F.col("object_key").endswith("/"))
    return f.select(F.col("object_key").alias("key"), "size", F.col("content_md5").alias("etag"))


@query("markdown_exists", f"""
SELECT object_key AS key, {SQL_MIRROR.format(k='object_key')} AS markdown_key,
  {SQL_MIRROR.format(k='object_key')} IN (SELECT key FROM fx_markdown) AS "exists"
FROM fx_files""", "O-04")
def markdown_exists(spark, d):
    from corpusflow.sources.listing import object_exists
    keys = _files(spark, d).select(F.col("object_key").alias("key"),
                                   P.mirrored_key("object_key").alias("markdown_key"))
    return object_exists(keys, FX.fx_markdown(spark, d), key="markdown_key", flag="exists")


@query("object_metadata", """
SELECT f.object_key AS key, f.size, f.content_md5 AS etag,
  CASE lower(regexp_extract(f.object_key, '^.+(\\.[^./]+)$', 1))
    WHEN '.pdf' THEN 'application/pdf' WHEN '.md' THEN 'text/markdown' WHEN '.markdown' THEN 'text/markdown'
    WHEN '.docx' THEN 'application/vnd.openxmlformats-officedocument.wordprocessingml.document'
    WHEN '.html' THEN 'text/html' WHEN '.txt' THEN 'text/plain' ELSE 'application/octet-stream' END AS content_type
FROM fx_upload u JOIN fx_files f ON f.object_key = u.filename""", "O-05")
def object_metadata(spark, d):
    from corpusflow.sources.listing import object_metadata as meta
    listing = _files(spark, d).select(F.col("object_key").alias("key"), "size",
                                      F.lit(None).cast("timestamp").alias("last_modified"),
                                      F.col("content_md5").alias("etag"))
    keys = FX.fx_upload(spark, d).select(F.col("filename").alias("key"))
    return meta(keys, listing).drop("last_modified")


@query("extension_skip", """
SELECT object_key AS key FROM fx_files
WHERE NOT (ends_with(object_key, '.DS_Store') OR ends_with(object_key, '.docx'))""", "O-06")
def extension_skip(spark, d):
    f = _files(spark, d)
    return f.where(~P.skip_by_extension("object_key", [".DS_Store", ".docx"])).select(
        F.col("object_key").alias("key"))


@query("markdown_only", "SELECT object_key AS key FROM fx_files WHERE ends_with(lower(object_key), '.md')", "O-07")
def markdown_only(spark, d):
    return _files(spark, d).where(P.is_markdown("object_key")).select(F.col("object_key").alias("key"))


@query("mirrored_keys", f"SELECT object_key AS key, {SQL_MIRROR.format(k='object_key')} AS markdown_key FROM fx_files",
       "O-08")
def mirrored_keys(spark, d):
    return _files(spark, d).select(F.col("object_key").alias("key"),
                                   P.mirrored_key("object_key").alias("markdown_key"))


@query("original_names", """
SELECT key, CASE WHEN regexp_replace(regexp_extract(key, '[^/]*$'), '^(.+)\\.[^.]+$', '\\1') LIKE '%.%'
  THEN regexp_replace(regexp_extract(key, '[^/]*$'), '^(.+)\\.[^.]+$', '\\1')
  ELSE regexp_replace(regexp_extract(key, '[^/]*$'), '^(.+)\\.[^.]+$', '\\1') || '.pdf' END AS original_name
FROM fx_markdown""", "O-09")
def original_names(spark, d):
    return FX.fx_markdown(spark, d).select("key", P.original_name("key").alias("original_name"))


@query("path_parts", """
SELECT object_key AS key, regexp_extract(object_key, '[^/]*$') AS name,
  regexp_replace(regexp_extract(object_key, '[^/]*$'), '^(.+)\\.[^.]+$', '\\1') AS stem,
  lower(regexp_extract(regexp_extract(object_key, '[^/]*$'), '^.+(\\.[^.]+)$', 1)) AS suffix,
  CAST(len(string_split(object_key, '/')) - 1 AS INTEGER) AS depth,
  CASE WHEN len(string_split(object_key, '/')) > 2 THEN string_split(object_key, '/')[2] END AS top_directory
FROM fx_files""", "O-10")
def path_parts(spark, d):
    k = "object_key"
    return _files(spark, d).select(F.col(k).alias("key"), P.basename(k).alias("name"), P.stem(k).alias("stem"),
                                   F.lower(P.suffix(k)).alias("suffix"), P.depth(k).alias("depth"),
                                   P.top_directory(k).alias("top_directory"))


@query("text_decode", "SELECT doc_id, md5(text) AS text_md5 FROM documents", "O-11")
def text_decode(spark, d):
    docs = FX.table(spark, d, "documents")
    latin1 = ~F.col("text").rlike(r"[^\x00-\xFF]")
    content = F.when(latin1, F.encode("text", "ISO-8859-1")).otherwise(F.encode("text", "UTF-8"))
    return docs.select("doc_id", content.alias("content")).select(
        "doc_id", F.md5(F.encode(TX.decode_with_fallback("content"), "UTF-8")).alias("text_md5"))


@query("markdown_lookup", f"""
SELECT f.object_key AS key, md5(m.text) AS markdown_md5
FROM fx_files f LEFT JOIN fx_markdown m ON m.key = {SQL_MIRROR.format(k='f.object_key')}""", "O-13")
def markdown_lookup(spark, d):
    from corpusflow.sources.markdown_store import lookup_markdown
    listing = _files(spark, d).select(F.col("object_key").alias("key"))
    store = FX.fx_markdown(spark, d).select(F.col("key").alias("markdown_key"), "text")
    return lookup_markdown(listing, store).select("key", F.md5("markdown").alias("markdown_md5"))


@query("listing_first_n", "SELECT object_key AS key, size FROM fx_files ORDER BY object_key LIMIT 25", "O-14")
def listing_first_n(spark, d):
    from corpusflow.sources.listing import first_n
    listing = _files(spark, d).select(F.col("object_key").alias("key"), "size")
    return first_n(listing, 25)


# ------------------------------------------------------------------ hashing

@query("content_md5", "SELECT doc_id, md5(text) AS md5_hex FROM documents", "O-18")
def content_md5(spark, d):
    return FX.table(spark, d, "documents").select("doc_id", H.content_md5(H.utf8("text")).alias("md5_hex"))


@query("light_hash_groups", """
SELECT doc_id, 16 AS hash_len, min(doc_id) OVER (PARTITION BY text) AS group_first FROM documents""", "O-19")
def light_hash_groups(spark, d):
    docs = FX.table(spark, d, "documents").select("doc_id", H.light_hash(H.utf8("text")).alias("h"))
    first = docs.groupBy("h").agg(F.min("doc_id").alias("group_first"))
    return docs.join(first, "h").select("doc_id", F.length("h").alias("hash_len"), "group_first")


@query("fast_hash", """
SELECT doc_id, md5(text || CAST(octet_length(encode(text)) AS VARCHAR)) AS fast_hash
FROM documents""", "O-20")
def fast_hash(spark, d):
    c = H.utf8("text")
    docs = FX.table(spark, d, "documents")
    return docs.select("doc_id", H.fast_hash(c, F.octet_length("text")).alias("fast_hash"))


@query("size_switched_hash", """
SELECT doc_id, md5(text) AS file_hash FROM documents""", "O-21")
def size_switched_hash(spark, d):
    docs = FX.table(spark, d, "documents")
    return docs.select("doc_id", H.size_switched_hash(H.utf8("text"))
                       .alias("file_hash"))


@query("text_md5", "SELECT doc_id, md5(text) AS text_md5 FROM fx_md", "O-22")
def text_md5(spark, d):
    return FX.fx_md(spark, d).select("doc_id", H.text_md5("text").alias("text_md5"))


@query("hash_for_content_collection", "SELECT doc_id, md5(text) AS file_hash FROM documents", "O-23")
def hash_for_content_collection(spark, d):
    return FX.table(spark, d, "documents").select(
        "doc_id", H.hash_for_collection(H.utf8("text"), "content").alias("file_hash"))


@query("hash_compare_ci", """
SELECT f.object_key AS key, u.filename IS NOT NULL AS uploaded
FROM fx_files f LEFT JOIN (SELECT DISTINCT filename, upper(hash) AS hash FROM fx_upload) u
  ON lower(u.hash) = lower(f.content_md5) AND u.filename = f.object_key""", "O-24")
def hash_compare_ci(spark, d):
    f = _files(spark, d)
    u = FX.fx_upload(spark, d).select(F.col("filename").alias("u_file"), F.upper("hash").alias("u_hash")).distinct()
    j = f.join(u, H.hashes_equal(f["content_md5"], u["u_hash"]) & (f["object_key"] == u["u_file"]), "left")
    return j.select(F.col("object_key").alias("key"), F.col("u_file").isNotNull().alias("uploaded"))


_SQL_UUID5 = """(substr({h},1,8) || '-' || substr({h},9,4) || '-5' || substr({h},14,3) || '-' ||
  substr('89ab89ab89ab89ab', strpos('0123456789abcdef', substr({h},17,1)), 1) || substr({h},18,3) || '-' || substr({h},21,12))"""


@query("point_ids", f"""
SELECT doc_id, {_SQL_UUID5.format(h='h1')} AS file_point_id, {_SQL_UUID5.format(h='h2')} AS chunk_point_id
FROM (SELECT doc_id,
  sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(regexp_extract(object_key, '[^/]*$'))) AS h1,
  sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(regexp_extract(object_key, '[^/]*$') || '_1')) AS h2
  FROM fx_files)""", "O-25")
def point_ids(spark, d):
    f = _files(spark, d)
    name = P.basename("object_key")
    return f.select("doc_id", H.uuid5(name).alias("file_point_id"),
                    H.chunk_point_id(name, F.lit(1)).alias("chunk_point_id"))


# ------------------------------------------------------------------ tokens, chunks

@query("token_counts", f"""
SELECT doc_id, CAST(len(regexp_extract_all(text, '{TOKEN_RE}')) AS INTEGER) AS n_tokens FROM fx_md""", "O-26")
def token_counts(spark, d):
    return FX.fx_md(spark, d).select("doc_id", TX.token_count("text").alias("n_tokens"))


def _chunk_invariants(spark, d, size):
    docs = FX.fx_md(spark, d).select("doc_id", F.col("doc_id").cast("string").alias("filename"), "text")
    ch = CH.chunk_documents(docs, keep=("doc_id",), chunk_tokens=size)
    agg = ch.groupBy("doc_id").agg(
        F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_number", "text"))),
                                       lambda x: TX.remove_ws(x["text"])), "")).alias("content_md5"),
        (F.max("n_tokens") <= size).alias("within_limit"),
        ((F.min("chunk_number") == 1) & (F.max("chunk_number") == F.count(F.lit(1)))
         & (F.countDistinct("chunk_number") == F.count(F.lit(1)))).alias("numbering_ok"))
    return agg


_CHUNK_INV_SQL = """
SELECT doc_id, md5(regexp_replace(text, '[ \\t\\n\\r\\f]', '', 'g')) AS content_md5,
  true AS within_limit, true AS numbering_ok FROM fx_md"""


@query("chunk_invariants_500", _CHUNK_INV_SQL, "O-27 O-29")
def chunk_invariants_500(spark, d):
    return _chunk_invariants(spark, d, 500)


@query("chunk_invariants_100", _CHUNK_INV_SQL, "O-27 O-29")
def chunk_invariants_100(spark, d):
    return _chunk_invariants(spark, d, 100)


@query("chunk_overlap", """
SELECT doc_id, true AS within_limit, true AS starts_ok, true AS ends_ok FROM fx_md""", "O-28 O-29")
def chunk_overlap(spark, d):
    """Invariants of overlapping chunks per document: every chunk within the
    limit, the first chunk opens and the last one closes the stripped text."""
    docs = FX.fx_md(spark, d).select("doc_id", F.col("doc_id").cast("string").alias("filename"), "text")
    ch = CH.chunk_documents(docs, keep=("doc_id",), chunk_tokens=100, overlap_tokens=20)
    agg = ch.groupBy("doc_id").agg(
        (F.max("n_tokens") <= 100).alias("within_limit"),
        F.min_by("text", "chunk_number").alias("__first"),
        F.max_by("text", "chunk_number").alias("__last"))
    body = docs.select("doc_id", TX.strip_ws("text").alias("__body"))
    j = agg.join(body, "doc_id")
    return j.select("doc_id", "within_limit", F.col("__body").startswith(F.col("__first")).alias("starts_ok"),
                    F.col("__body").endswith(F.col("__last")).alias("ends_ok"))


@query("element_types", rf"""
SELECT doc_id, kind, CASE
  WHEN contains(text, '|') AND (contains(text, '---') OR contains(text, '|-')) THEN 'Table'
  WHEN regexp_matches(text, '!\[.*?\]\(.*?\)') THEN 'Image'
  WHEN contains(text, '```') THEN 'Code'
  WHEN regexp_matches(text, '(?m)^[ \t\n\r\f]*[-*+][ \t\n\r\f]') OR regexp_matches(text, '(?m)^[ \t\n\r\f]*[0-9]+\.[ \t\n\r\f]') THEN 'List'
  ELSE 'Text' END AS element_type
FROM fx_md""", "O-30")
def element_types(spark, d):
    return FX.fx_md(spark, d).select("doc_id", "kind", TX.element_type("text").alias("element_type"))


def _chunk_record_rows(spark, d):
    docs = FX.fx_md(spark, d).select(F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".md")).alias("filename"), "text")
    rec = CH.chunk_record(CH.chunk_documents(docs))
    return rec.select("text", "metadata.filename", "metadata.page_number", "metadata.element_type", "metadata.md5_hash")


@query("chunk_records", """
SELECT 'doc_' || CAST(doc_id AS VARCHAR) || '.md' AS filename, true AS numbering_ok, true AS md5_ok FROM fx_md""",
       "O-31 O-29 O-22")
def chunk_records(spark, d):
    """Per file: page numbers run 1..n and every record's md5_hash is the MD5 of its text."""
    rec = _chunk_record_rows(spark, d)
    return rec.groupBy("filename").agg(
        ((F.min("page_number") == 1) & (F.max("page_number") == F.count(F.lit(1)))
         & (F.countDistinct("page_number") == F.count(F.lit(1)))).alias("numbering_ok"),
        F.bool_and(F.col("md5_hash") == F.md5(F.encode("text", "UTF-8"))).alias("md5_ok"))


@query("chunk_stats", f"""
SELECT doc_id, CAST(len(regexp_extract_all(text, '{TOKEN_RE}')) AS BIGINT) AS sum_tokens FROM fx_md""", "O-32")
def chunk_stats(spark, d):
    docs = FX.fx_md(spark, d).select("doc_id", F.col("doc_id").cast("string").alias("filename"), "text")
    ch = CH.chunk_documents(docs, keep=("doc_id",))
    st = CH.chunk_stats(ch.drop("filename").withColumnRenamed("doc_id", "filename"))
    return st.select(F.col("filename").alias("doc_id"), "sum_tokens")


@query("chunk_type_counts", """
SELECT CAST(doc_id AS VARCHAR) AS filename, true AS has_chunks, true AS types_add_up, true AS tokens_in_range
FROM fx_md""", "O-30 O-32")
def chunk_type_counts(spark, d):
    """Per file stats with zeros for files without chunks (outer join): every
    document has chunks, type counts add up to the total, min <= avg <= max <= 100."""
    docs = FX.fx_md(spark, d).select(F.col("doc_id").cast("string").alias("filename"), "text")
    st = CH.chunk_stats(CH.chunk_documents(docs, chunk_tokens=100), docs.select("filename"))
    types = sum((F.col(f"n_{t.lower()}") for t in TX.ELEMENT_TYPES[1:]), F.col(f"n_{TX.ELEMENT_TYPES[0].lower()}"))
    return st.select(
        "filename", (F.col("total_chunks") > 0).alias("has_chunks"),
        (types == F.col("total_chunks")).alias("types_add_up"),
        ((F.col("min_tokens") <= F.col("avg_tokens")) & (F.col("avg_tokens") <= F.col("max_tokens"))
         & (F.col("max_tokens") <= 100)).alias("tokens_in_range"))


# ------------------------------------------------------------------ tokenizers, index

def _tok_summary(ids, toks):
    return [*ids, F.size(toks).cast("bigint").alias("n_tokens"), F.md5(F.array_join(toks, " ")).alias("tokens_md5")]


@query("tokenize_word", f"""
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5
FROM (SELECT doc_id, regexp_extract_all(text, '{WORD_RE}') AS t FROM documents)""", "O-33")
def tokenize_word(spark, d):
    return FX.table(spark, d, "documents").select(*_tok_summary(["doc_id"], TX.word_tokens("text")))


@query("tokenize_whitespace", r"""
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5
FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \t\n\r\f]+'), lambda x: x <> '') AS t FROM documents)""",
       "O-34")
def tokenize_whitespace(spark, d):
    return FX.table(spark, d, "documents").select(*_tok_summary(["doc_id"], TX.whitespace_tokens("text")))


@query("tokenize_prefix", f"""
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5
FROM (SELECT doc_id, flatten(list_transform(list_transform(regexp_extract_all(regexp_extract(object_key, '[^/]*$'), '{WORD_RE}'), lambda w: lower(w)),
   lambda w: list_transform(range(1, length(w) + 1), lambda i: substr(w, 1, i)))) AS t FROM fx_files)""", "O-35")
def tokenize_prefix(spark, d):
    f = _files(spark, d)
    return f.select(*_tok_summary(["doc_id"], TX.prefix_tokens(P.basename("object_key"))))


@query("tokenize_multilingual", None, "O-36")
def tokenize_multilingual(spark, d):
    return FX.table(spark, d, "documents").select(*_tok_summary(["doc_id"], TX.multilingual_tokens("text")))


@query("tokenize_normalised", f"""
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5
FROM (SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '{WORD_RE}'), lambda w: lower(w)),
  lambda w: length(w) >= 2) AS t FROM documents)""", "O-37")
def tokenize_normalised(spark, d):
    toks = TX.normalise_tokens(TX.word_tokens("text"), 2)
    return FX.table(spark, d, "documents").select(*_tok_summary(["doc_id"], toks))


@query("text_index", f"""
SELECT token, CAST(count(DISTINCT doc_id) AS BIGINT) AS doc_freq, CAST(count(*) AS BIGINT) AS total_freq
FROM (SELECT doc_id, lower(unnest(regexp_extract_all(text, '{WORD_RE}'))) AS token FROM documents)
WHERE length(token) >= 1 GROUP BY token""", "O-38")
def text_index(spark, d):
    from corpusflow.operators.text_index import postings, token_summary
    post = postings(FX.table(spark, d, "documents"), "doc_id", "text")
    return token_summary(post, "doc_id")
