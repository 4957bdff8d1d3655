"""Registered queries, part 3: search, reports, whole jobs and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.functions import paths as P
from corpusflow.functions import text as TX
from corpusflow.operators import convert as CV
from corpusflow.operators import dedup as DD
from corpusflow.operators import embedding as EM
from corpusflow.operators import reports as RP
from corpusflow.operators import search as S
from corpusflow.operators import text_index as TI
from corpusflow.operators import vector_index as VI
from corpusflow.plans import fixtures as FX
from corpusflow.plans import jobs as J
from corpusflow.plans.catalog import REGISTRY, WORD_RE, query

# ------------------------------------------------------------------ search

_SCORE_SQL = {
    "cosine": "list_cosine_similarity(p.vector, q.vector)",
    "dot": "list_dot_product(p.vector, q.vector)",
    "euclid": "list_distance(p.vector, q.vector)",
    "manhattan": "list_sum(list_transform(range(1, len(p.vector) + 1), lambda i: abs(p.vector[i] - q.vector[i])))",
}


def _topk_sql(metric: str, k: int, where: str = "") -> str:
    order = "DESC" if metric in ("cosine", "dot") else "ASC"
    return f"""
SELECT query_id, id, round(score, 6) AS score, CAST(rn AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) {order}, id) AS rn FROM (
    SELECT q.query_id, p.id, {_SCORE_SQL[metric]} AS score FROM fx_queries q, fx_points p {where}))
WHERE rn <= {k}"""


def _topk(metric):
    def fn(spark, d):
        return S.topk(FX.fx_points(spark, d), FX.fx_queries(spark, d), 10, metric).select(
            "query_id", "id", "score", "rank")
    return fn


query("search_cosine", _topk_sql("cosine", 10), "O-81 O-85")(_topk("cosine"))
query("search_dot", _topk_sql("dot", 10), "O-82")(_topk("dot"))
query("search_euclid", _topk_sql("euclid", 10), "O-83")(_topk("euclid"))
query("search_manhattan", _topk_sql("manhattan", 10), "O-84")(_topk("manhattan"))


@query("search_filtered", _topk_sql("cosine", 10, "WHERE p.element_type = 'Table'"), "O-86")
def search_filtered(spark, d):
    pts = FX.fx_points(spark, d)
    return S.filtered_topk(pts, FX.fx_queries(spark, d), F.col("element_type") == "Table", k=10).select(
        "query_id", "id", "score", "rank")


@query("search_multi_query", f"""
WITH dt AS (SELECT doc_id, lower(unnest(regexp_extract_all(text, '{WORD_RE}'))) AS tok FROM documents),
db AS (SELECT doc_id, CAST(CAST('0x' || substr(md5(tok), 1, 8) AS BIGINT) % 64 AS INTEGER) AS b, CAST(count(*) AS DOUBLE) AS c FROM dt GROUP BY ALL),
dw AS (SELECT doc_id, b, c / sqrt(sum(c * c) OVER (PARTITION BY doc_id)) AS w FROM db),
qt AS (SELECT item_id, lower(unnest(regexp_extract_all(text, '{WORD_RE}'))) AS tok FROM benchmark),
qb AS (SELECT item_id, CAST(CAST('0x' || substr(md5(tok), 1, 8) AS BIGINT) % 64 AS INTEGER) AS b, CAST(count(*) AS DOUBLE) AS c FROM qt GROUP BY ALL),
qw AS (SELECT item_id, b, c / sqrt(sum(c * c) OVER (PARTITION BY item_id)) AS w FROM qb),
s AS (SELECT CAST(qw.item_id AS VARCHAR) AS query_id, dw.doc_id AS id, sum(qw.w * dw.w) AS score
      FROM qw JOIN dw USING (b) GROUP BY qw.item_id, dw.doc_id)
SELECT query_id, id, round(score, 6) AS score, CAST(rn AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, id) AS rn FROM s) WHERE rn <= 5""",
       "O-85 O-58")
def search_multi_query(spark, d):
    docs = EM.hashing_vectors(FX.table(spark, d, "documents"), ["doc_id"], "text", 64)
    qs = EM.hashing_vectors(FX.table(spark, d, "benchmark"), ["item_id"], "text", 64).select(
        F.col("item_id").cast("string").alias("query_id"), "vector")
    return S.topk(docs.withColumnRenamed("doc_id", "id"), qs, 5, "cosine").select("query_id", "id", "score", "rank")


def _approximate(spark, d):
    points, path = FX.fx_points(spark, d), _scratch(spark, "inverted-file")
    VI.build(points, path, "cosine")
    return VI.search(spark, path, FX.fx_queries(spark, d), 10)


@query("search_approx", None, "O-87")
def search_approx(spark, d):
    return _approximate(spark, d).select("query_id", "id", "score", "rank", "scored")


@query("search_approx_recall", """
SELECT CAST((SELECT count(*) FROM fx_queries) AS BIGINT) AS n_queries, CAST(10 * (SELECT count(*) FROM fx_queries) AS BIGINT) AS n_hits,
  true AS recall_at_least_90_percent, true AS under_half_of_all_points_scored""", "O-87")
def search_approx_recall(spark, d):
    """Recall at 10 of the inverted file against the exact search, and how much of the table it scores."""
    found = _approximate(spark, d)
    exact = S.topk(FX.fx_points(spark, d), FX.fx_queries(spark, d), 10, "cosine")
    scored = found.groupBy("query_id").agg(F.max("scored").alias("scored"), F.count("*").alias("hits")).agg(
        F.count("*").alias("n_queries"), F.sum("hits").alias("n_hits"), F.avg("scored").alias("scored"))
    n = FX.fx_points(spark, d).agg(F.count("*").alias("n"))
    told = scored.unionByName(n, allowMissingColumns=True).unionByName(VI.recall(exact, found), allowMissingColumns=True)
    whole = told.agg(*[F.max(c).alias(c) for c in told.columns])
    return whole.select("n_queries", "n_hits", (F.col("recall") >= 0.9).alias("recall_at_least_90_percent"),
                        (F.col("scored") < F.col("n") / 2).alias("under_half_of_all_points_scored"))


_PREFIX_SQL = ("flatten(list_transform(list_transform(regexp_extract_all({x}, '" + WORD_RE + "'), lambda w: lower(w)), "
               "lambda w: list_transform(range(1, length(w) + 1), lambda i: substr(w, 1, i))))")
_QTOK_SQL = ("list_distinct(list_filter(list_transform(regexp_extract_all({x}, '" + WORD_RE + "'), lambda w: lower(w)), "
             "lambda w: length(w) >= 1))")


@query("search_keyword_filenames", f"""
WITH q AS (SELECT DISTINCT filename AS query_id, {_QTOK_SQL.replace('{x}', 'filename')} AS qt FROM fx_failed),
f AS (SELECT object_key AS id, {_PREFIX_SQL.replace('{x}', "regexp_extract(object_key, '[^/]*$')")} AS ft FROM fx_files)
SELECT query_id, id FROM q, f WHERE len(qt) > 0 AND list_has_all(ft, qt)""", "O-88 O-74")
def search_keyword_filenames(spark, d):
    files = FX.fx_files(spark, d).select(F.col("object_key").alias("id"), P.basename("object_key").alias("name"))
    qs = FX.fx_failed(spark, d).select(F.col("filename").alias("query_id"), F.col("filename").alias("text")).distinct()
    return S.keyword_search(files, qs, "name", id_col="id", mode="prefix")


@query("search_stored_words", f"""
WITH q AS (SELECT item_id, {_QTOK_SQL.replace('{x}', 'text')} AS qt FROM (SELECT item_id, array_to_string(regexp_extract_all(text, '{WORD_RE}')[1:3], ' ') AS text FROM benchmark)),
f AS (SELECT doc_id, list_distinct(list_transform(regexp_extract_all(text, '{WORD_RE}'), lambda w: lower(w))) AS ft FROM documents)
SELECT item_id AS query_id, doc_id FROM q, f WHERE len(qt) > 0 AND list_has_all(ft, qt)""", "O-38 O-74 O-88")
def search_stored_words(spark, d):
    """The documents that hold the first three words of a benchmark item, from an index of all documents' words."""
    path = _scratch(spark, "words")
    TI.write_index(TI.token_rows(FX.table(spark, d, "documents"), "doc_id", "text", "word"), path)
    first = F.array_join(F.slice(TX.word_tokens("text"), 1, 3), " ")
    return TI.token_search(spark, path, FX.table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), first.alias("text")), "doc_id")


@query("search_stored_phrases", f"""
WITH q AS (SELECT item_id, ' ' || array_to_string(list_transform(regexp_extract_all(text, '{WORD_RE}')[1:3], lambda w: lower(w)), ' ') || ' ' AS p FROM benchmark),
f AS (SELECT doc_id, ' ' || array_to_string(list_transform(regexp_extract_all(text, '{WORD_RE}'), lambda w: lower(w)), ' ') || ' ' AS t FROM documents)
SELECT item_id AS phrase_id, doc_id FROM q, f WHERE trim(p) <> '' AND contains(t, p)""", "O-38 O-75")
def search_stored_phrases(spark, d):
    """The documents that hold the first three words of a benchmark item in sequence, from an index of all words' places."""
    path = _scratch(spark, "places")
    TI.write_index(TI.position_rows(FX.table(spark, d, "documents"), "doc_id", "text"), path)
    first = F.array_join(F.slice(TX.word_tokens("text"), 1, 3), " ")
    return TI.phrase_search(spark, path, FX.table(spark, d, "benchmark").select(F.col("item_id").alias("phrase_id"), first.alias("phrase")), "doc_id")


@query("search_hybrid", f"""
WITH q AS (SELECT query_id, vector, {_QTOK_SQL.replace('{x}', "'doc ' || substr(query_id, 1, 1)")} AS qt FROM fx_queries),
c AS (SELECT q.query_id, p.id, list_cosine_similarity(p.vector, q.vector) AS score
      FROM q, fx_filename_points p WHERE list_has_all({_PREFIX_SQL.replace('{x}', 'p.pagecontent')}, q.qt))
SELECT query_id, id, round(score, 6) AS score, CAST(rn AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, id) AS rn FROM c) WHERE rn <= 5""",
       "O-89")
def search_hybrid(spark, d):
    qs = FX.fx_queries(spark, d).withColumn("text", F.concat(F.lit("doc "), F.substring("query_id", 1, 1)))
    return S.hybrid_search(FX.fx_filename_points(spark, d), qs, "pagecontent", k=5).select(
        "query_id", "id", "score", "rank")


_TWO_STAGE_SQL = """
WITH s1 AS (SELECT query_id, filename FROM (
    SELECT q.query_id, p.filename, row_number() OVER (PARTITION BY q.query_id
      ORDER BY round(list_cosine_similarity(p.vector, q.vector), 6) DESC, p.id) AS rn
    FROM fx_queries q, fx_filename_points p) WHERE rn <= 3),
s2 AS (SELECT s1.query_id, c.id, c.filename, c.page_number, list_cosine_similarity(c.vector, q.vector) AS score
       FROM s1 JOIN fx_points c USING (filename) JOIN fx_queries q USING (query_id)),
hits AS (SELECT query_id, CAST(rn AS INTEGER) AS rank, id, filename, page_number, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, id) AS rn FROM s2) WHERE rn <= 5)"""


def _two_stage(spark, d):
    return S.two_stage(FX.fx_filename_points(spark, d), FX.fx_points(spark, d), FX.fx_queries(spark, d),
                       k_files=3, k_chunks=5)


@query("search_two_stage", _TWO_STAGE_SQL + "\nSELECT * FROM hits", "O-90")
def search_two_stage(spark, d):
    return _two_stage(spark, d).select("query_id", "rank", "id", "filename", "page_number", "score")


@query("search_context_window", _TWO_STAGE_SQL + """
SELECT h.query_id, h.rank, h.filename, h.page_number AS center_page, h.score,
  string_agg(c.pagecontent, chr(10) || chr(10) ORDER BY c.page_number) AS combined_page,
  string_agg(CAST(c.page_number AS VARCHAR), ',' ORDER BY c.page_number) AS page_numbers
FROM hits h JOIN fx_points c ON c.filename = h.filename AND c.page_number BETWEEN h.page_number - 2 AND h.page_number + 2
GROUP BY h.query_id, h.rank, h.filename, h.page_number, h.score""", "O-91")
def search_context_window(spark, d):
    hits = _two_stage(spark, d)
    ctx = S.context_window(hits, FX.fx_points(spark, d), 2)
    return ctx.select("query_id", "rank", "filename", "center_page", "score", "combined_page",
                      F.array_join(F.transform("page_numbers", lambda x: x.cast("string")), ",").alias("page_numbers"))


# ------------------------------------------------------------------ reports

@query("ledger_counts", """
SELECT 'conversion' AS ledger, CAST(count(*) AS BIGINT) AS n_entries FROM fx_conversion
UNION ALL SELECT 'upload', count(*) FROM fx_upload UNION ALL SELECT 'failed', count(*) FROM fx_failed
UNION ALL SELECT 'embedding', count(*) FROM fx_embedding""", "O-92")
def ledger_counts(spark, d):
    return RP.ledger_counts({"conversion": FX.fx_conversion(spark, d), "upload": FX.fx_upload(spark, d),
                             "failed": FX.fx_failed(spark, d), "embedding": FX.fx_embedding(spark, d)})


@query("avg_embedding_time", """
SELECT collection_name, CAST(count(*) AS BIGINT) AS n_files, round(avg(embedding_time_seconds), 6) AS avg_embedding_seconds
FROM fx_embedding GROUP BY collection_name""", "O-93")
def avg_embedding_time(spark, d):
    return RP.avg_embedding_time(FX.fx_embedding(spark, d), by_collection=True)


@query("failures_by_stage", "SELECT stage, CAST(count(*) AS BIGINT) AS n_failed FROM fx_failed GROUP BY stage", "O-94")
def failures_by_stage(spark, d):
    return RP.failures_by_stage(FX.fx_failed(spark, d))


_DECIDE_SQL = """
{name} AS (
  SELECT key, '{coll}' AS collection_name, CASE WHEN first_ts IS NOT NULL THEN 'already_embedded' WHEN in_coll THEN 'already_in_qdrant'
    WHEN NOT is_first THEN 'already_embedded' END AS skip_reason,
    CASE WHEN first_ts IS NOT NULL THEN 'log_file' WHEN in_coll THEN 'qdrant_collection' WHEN NOT is_first THEN 'log_file' END AS found_in
  FROM (SELECT f.object_key AS key, e.first_ts,
      f.content_md5 IN (SELECT file_hash FROM fx_resident WHERE collection_name = '{coll}') AS in_coll,
      f.object_key = min(f.object_key) OVER (PARTITION BY f.content_md5) AS is_first
    FROM {src} f LEFT JOIN (SELECT md5_hash, min(timestamp) AS first_ts FROM fx_embedding
                             WHERE collection_name = '{coll}' GROUP BY md5_hash) e ON e.md5_hash = f.content_md5))"""


def _decisions(spark, d, files=None):
    f = files if files is not None else FX.fx_files(spark, d)
    f = f.select(F.col("object_key").alias("filename"), F.col("content_md5").alias("hash"))
    res = FX.fx_resident(spark, d)
    a = DD.dedup_decision(f, FX.fx_embedding(spark, d), res, collection="content")
    b = DD.dedup_decision(f, FX.fx_embedding(spark, d), res, collection="filenames")
    return a.unionByName(b)


@query("skip_breakdown", "WITH " + _DECIDE_SQL.format(name="dc", coll="content", src="fx_files") + ",\n"
       + _DECIDE_SQL.format(name="dn", coll="filenames", src="fx_files") + """,
skipped AS (SELECT * FROM dc WHERE skip_reason IS NOT NULL UNION ALL SELECT * FROM dn WHERE skip_reason IS NOT NULL)
SELECT CASE WHEN GROUPING(skip_reason) = 0 THEN 'by_reason' WHEN GROUPING(found_in) = 0 THEN 'by_source'
            WHEN GROUPING(collection_name) = 0 THEN 'by_collection' ELSE 'total' END AS breakdown,
  coalesce(skip_reason, found_in, collection_name, 'all') AS value, CAST(count(*) AS BIGINT) AS n_skipped
FROM skipped GROUP BY GROUPING SETS ((skip_reason), (found_in), (collection_name), ())""", "O-95")
def skip_breakdown(spark, d):
    skipped = DD.skip_rows(_decisions(spark, d))
    return RP.skip_breakdown(skipped)


@query("run_summary", """
WITH newf AS (SELECT * FROM fx_files WHERE content_md5 NOT IN (SELECT hash FROM fx_conversion UNION SELECT hash FROM fx_upload)),
""" + _DECIDE_SQL.format(name="dc", coll="content", src="newf") + """,
o AS (SELECT dc.key, CASE WHEN skip_reason IS NOT NULL THEN 'skipped'
        WHEN f.content_md5 IN (SELECT hash FROM fx_failed) THEN 'failed' ELSE 'processed' END AS outcome
      FROM dc JOIN fx_files f ON f.object_key = dc.key)
SELECT (SELECT CAST(count(*) AS BIGINT) FROM fx_files) AS total_files, CAST(count(*) AS BIGINT) AS new_files,
  CAST(count_if(outcome = 'processed') AS BIGINT) AS processed, CAST(count_if(outcome = 'failed') AS BIGINT) AS failed,
  CAST(count_if(outcome = 'skipped') AS BIGINT) AS skipped, CAST(0 AS DOUBLE) AS seconds, CAST(0 AS DOUBLE) AS files_per_second FROM o""", "O-96")
def run_summary(spark, d):
    files = FX.fx_files(spark, d)
    processed = DD.processed_hashes(FX.fx_conversion(spark, d), FX.fx_upload(spark, d))
    new = files.join(processed, files["content_md5"] == processed["hash"], "left_anti")
    dec = DD.dedup_decision(new.select(F.col("object_key").alias("filename"), F.col("content_md5").alias("hash")),
                            FX.fx_embedding(spark, d), FX.fx_resident(spark, d), collection="content")
    dec = DD.in_ledger(dec, FX.fx_failed(spark, d), flag="failed_before")
    out = dec.select(F.when(F.col("action") == "skip", "skipped").when(F.col("failed_before"), "failed")
                     .otherwise("processed").alias("outcome"))
    return RP.run_summary(out, 0.0, listed=files).select(
        "total_files", "new_files", "processed", "failed", "skipped", "seconds", "files_per_second")


_ALL_KEYS_SQL = "(SELECT object_key AS key FROM fx_files UNION ALL SELECT key FROM fx_markdown)"


def _all_keys(spark, d):
    return FX.fx_files(spark, d).select(F.col("object_key").alias("key")).unionByName(
        FX.fx_markdown(spark, d).select("key"))


@query("directory_distribution", """
SELECT coalesce(CASE WHEN len(string_split(key, '/')) > 2 THEN string_split(key, '/')[2] END, '(root)') AS directory,
  CAST(count(*) AS BIGINT) AS n_files FROM fx_markdown GROUP BY 1""", "O-97")
def directory_distribution(spark, d):
    return RP.directory_distribution(FX.fx_markdown(spark, d).select("key"))


@query("corpus_diagnosis", f"""
WITH k AS (SELECT CASE WHEN ends_with(lower(key), '.md') THEN 'markdown' ELSE 'other' END AS kind,
  coalesce(nullif(lower(regexp_extract(regexp_extract(key, '[^/]*$'), '^.+(\\.[^.]+)$', 1)), ''), '(no extension)') AS extension,
  CASE WHEN len(string_split(key, '/')) > 2 THEN string_split(key, '/')[2] END AS directory,
  CAST(len(string_split(key, '/')) - 1 AS VARCHAR) AS depth FROM {_ALL_KEYS_SQL}),
g AS (SELECT CASE WHEN GROUPING(kind) = 0 THEN 'kind' WHEN GROUPING(extension) = 0 THEN 'by_extension'
                  WHEN GROUPING(directory) = 0 THEN 'by_directory' ELSE 'by_depth' END AS dimension,
        coalesce(kind, extension, directory, depth) AS value, CAST(count(*) AS BIGINT) AS n_files
      FROM k GROUP BY GROUPING SETS ((kind), (extension), (directory), (depth)))
SELECT * FROM g WHERE NOT (dimension = 'by_directory' AND value IS NULL)""", "O-98")
def corpus_diagnosis(spark, d):
    return RP.corpus_diagnosis(_all_keys(spark, d))


@query("sample_per_group", """
WITH l AS (SELECT object_key AS key, size FROM fx_files),
m AS (SELECT 'markdown' AS sample, string_split(key, '/')[2] AS directory, key, round(size / 1024, 1) AS size_kb,
        CAST(row_number() OVER (PARTITION BY string_split(key, '/')[2] ORDER BY key) AS INTEGER) AS rank
      FROM l WHERE ends_with(lower(key), '.md')),
o AS (SELECT 'other' AS sample, CAST(NULL AS VARCHAR) AS directory, key, round(size / 1024, 1) AS size_kb,
        CAST(row_number() OVER (ORDER BY key) AS INTEGER) AS rank FROM l WHERE NOT ends_with(lower(key), '.md'))
SELECT * FROM m WHERE rank <= 3 UNION ALL SELECT * FROM o WHERE rank <= 10""", "O-99")
def sample_per_group(spark, d):
    listing = FX.fx_files(spark, d).select(F.col("object_key").alias("key"), "size")
    return RP.sample_per_group(listing, 3, 10)


@query("corpus_issues", f"""
SELECT CAST(count_if(lower(sfx) = '.md') AS BIGINT) AS n_markdown,
  CAST(count_if(lower(sfx) = '.md' AND sfx <> '.md') AS BIGINT) AS n_uppercase_md,
  CAST(count_if(ends_with(lower(key), '.markdown')) AS BIGINT) AS n_dot_markdown,
  CAST(count_if(len(string_split(key, '/')) <= 2) AS BIGINT) AS n_without_subdir
FROM (SELECT key, regexp_extract(regexp_extract(key, '[^/]*$'), '^.+(\\.[^.]+)$', 1) AS sfx FROM {_ALL_KEYS_SQL})""",
       "O-100")
def corpus_issues(spark, d):
    return RP.corpus_issues(_all_keys(spark, d))


_WORKLIST_SQL = """
WITH src AS (SELECT regexp_extract(object_key, '[^/]*$') AS name, min(object_key) AS source_key FROM fx_files GROUP BY 1),
mds AS (SELECT regexp_replace(regexp_extract(key, '[^/]*$'), '^(.+)\\.[^.]+$', '\\1') AS stem, min(key) AS k1 FROM fx_markdown GROUP BY 1),
mdn AS (SELECT regexp_extract(key, '[^/]*$') AS name, min(key) AS k2 FROM fx_markdown GROUP BY 1),
w AS (SELECT f.filename, f.hash, f.stage, coalesce(src.source_key, least(mds.k1, mdn.k2)) AS found_key,
  CASE WHEN src.source_key IS NOT NULL THEN 'source' WHEN coalesce(mds.k1, mdn.k2) IS NOT NULL THEN 'markdown'
       ELSE 'not_found' END AS type
  FROM fx_failed f LEFT JOIN src ON src.name = f.filename
  LEFT JOIN mds ON mds.stem = regexp_replace(f.filename, '^(.+)\\.[^.]+$', '\\1')
  LEFT JOIN mdn ON mdn.name = f.filename)"""


def _worklist(spark, d):
    failed = FX.fx_failed(spark, d).select("filename", "hash", "stage")
    src = FX.fx_files(spark, d).select(F.col("object_key").alias("key"))
    return RP.retry_worklist(failed, src, FX.fx_markdown(spark, d).select("key"))


@query("retry_worklist", _WORKLIST_SQL + "\nSELECT * FROM w", "O-101")
def retry_worklist(spark, d):
    return _worklist(spark, d)


@query("clear_resolved_failures", """
SELECT filename, hash, stage FROM fx_failed WHERE hash NOT IN (SELECT hash FROM fx_upload WHERE hash IS NOT NULL)""",
       "O-102")
def clear_resolved_failures(spark, d):
    return RP.clear_resolved(FX.fx_failed(spark, d), FX.fx_upload(spark, d)).select("filename", "hash", "stage")


@query("retry_summary", _WORKLIST_SQL + """
SELECT CAST(count(*) AS BIGINT) AS total_files,
  CAST(count_if(type <> 'not_found' AND hash IN (SELECT hash FROM fx_upload)) AS BIGINT) AS processed,
  CAST(count_if(type <> 'not_found' AND hash NOT IN (SELECT hash FROM fx_upload)) AS BIGINT) AS still_failed,
  CAST(count_if(type = 'not_found') AS BIGINT) AS not_found FROM w""", "O-103")
def retry_summary(spark, d):
    return RP.retry_summary(_worklist(spark, d), FX.fx_upload(spark, d))


@query("retry_dry_run", _WORKLIST_SQL + """
SELECT CAST(count(*) AS BIGINT) AS total_files, CAST(0 AS BIGINT) AS processed,
  CAST(count_if(type <> 'not_found') AS BIGINT) AS still_failed, CAST(count_if(type = 'not_found') AS BIGINT) AS not_found FROM w""",
       "O-103")
def retry_dry_run(spark, d):
    return RP.retry_summary(_worklist(spark, d))


@query("file_history", """
WITH u AS (
  SELECT filename, hash, datetime AS ts, 'converted' AS detail, 'conversion' AS ledger FROM fx_conversion
  UNION ALL SELECT filename, hash, datetime, 'uploaded', 'upload' FROM fx_upload
  UNION ALL SELECT filename, md5_hash, timestamp, collection_name, 'embedding' FROM fx_embedding
  UNION ALL SELECT filename, hash, datetime, stage, 'failed' FROM fx_failed)
SELECT filename, hash, CAST(ts AS VARCHAR) AS ts, ledger, detail,
  CAST(row_number() OVER w AS INTEGER) AS seq, lag(ledger) OVER w AS previous_ledger
FROM u WINDOW w AS (PARTITION BY filename, hash ORDER BY ts, ledger, detail)""", "O-104")
def file_history(spark, d):
    ev = {
        "conversion": FX.fx_conversion(spark, d).select("filename", "hash", F.col("datetime").alias("ts"),
                                                        F.lit("converted").alias("detail")),
        "upload": FX.fx_upload(spark, d).select("filename", "hash", F.col("datetime").alias("ts"),
                                                F.lit("uploaded").alias("detail")),
        "embedding": FX.fx_embedding(spark, d).select("filename", F.col("md5_hash").alias("hash"),
                                                      F.col("timestamp").alias("ts"), F.col("collection_name").alias("detail")),
        "failed": FX.fx_failed(spark, d).select("filename", "hash", F.col("datetime").alias("ts"),
                                                F.col("stage").alias("detail")),
    }
    h = RP.file_history(ev)
    return h.select("filename", "hash", F.col("ts").cast("string").alias("ts"), "ledger", "detail", "seq",
                    "previous_ledger")


@query("monitoring_rates", """
SELECT CAST(date_trunc('hour', ts) AS VARCHAR) AS window_start, CAST(count(*) AS BIGINT) AS n_files,
  CAST(count_if(event_type = 'error') AS BIGINT) AS n_failed,
  round(count_if(event_type = 'error') * 100.0 / count(*), 6) AS failed_pct FROM events GROUP BY 1""", "O-105")
def monitoring_rates(spark, d):
    ev = FX.table(spark, d, "events")
    return RP.monitoring_rates(ev, "ts", failed=F.col("event_type") == "error")


# ------------------------------------------------------------------ whole jobs

def _ingest(spark, d, force=False):
    files = FX.fx_files(spark, d).select(F.col("object_key").alias("key"), "text")
    return J.full_ingest(files, FX.fx_upload(spark, d), FX.fx_embedding(spark, d), FX.fx_resident(spark, d),
                         force=force)


def flagship(spark, d):
    """Full ingest -> content points (no vector column in the result for display)."""
    out = _ingest(spark, d)
    return out.content_points.select("id", "filename", "page_number", "element_type", "md5_hash", "file_hash",
                                     F.size("vector").alias("dim"))


@query("full_ingest", None, "O-106")
def full_ingest(spark, d):
    return flagship(spark, d)


@query("full_ingest_decisions", """
WITH newf AS (SELECT * FROM fx_files WHERE content_md5 NOT IN (SELECT hash FROM fx_upload)),
""" + _DECIDE_SQL.format(name="dc", coll="content", src="newf") + """
SELECT key, CASE WHEN skip_reason IS NULL THEN 'process' ELSE 'skip' END AS action, skip_reason, found_in FROM dc""",
       "O-106 O-44")
def full_ingest_decisions(spark, d):
    return _ingest(spark, d).decisions.select("key", "action", "skip_reason", "found_in")


@query("html_convert", None, "O-15 O-107")
def html_convert(spark, d):
    pages = FX.table(spark, d, "pages")
    return CV.convert_pages(pages).select("page_id", F.md5("markdown").alias("markdown_md5"),
                                          F.length("markdown").cast("bigint").alias("n_chars"), "error")


def _html_sql() -> str:
    expr = "html"
    for pat, rep in CV.HTML_STEPS:
        p = pat.replace("'", "''")
        r = rep.replace("'", "''").replace("\\", "\\\\").replace("\n", "' || chr(10) || '")
        expr = f"regexp_replace({expr}, '{p}', '{r}', 'g')"
    return expr


REGISTRY_HTML_SQL = f"""
SELECT page_id, CASE WHEN md <> '' THEN md5(md) END AS markdown_md5, CASE WHEN md <> '' THEN CAST(length(md) AS BIGINT) END AS n_chars,
  CASE WHEN md = '' THEN 'empty conversion' END AS error FROM (SELECT page_id, {_html_sql()} AS md FROM pages)"""
REGISTRY["html_convert"] = (html_convert, REGISTRY_HTML_SQL, "O-15 O-107")


@query("convert_only", None, "O-107 O-08 O-12")
def convert_only(spark, d):
    pages = FX.table(spark, d, "pages").select(
        F.concat(F.lit("source/web/page_"), F.col("page_id").cast("string"), F.lit(".html")).alias("key"), "html")
    ok, _failed = J.convert_only(pages)
    return ok.select("markdown_key", "source_key", F.md5("text").alias("markdown_md5"))


@query("markdown_to_points", None, "O-108 O-71")
def markdown_to_points(spark, d):
    out = J.markdown_to_points(FX.fx_markdown(spark, d), FX.fx_embedding(spark, d), FX.fx_resident(spark, d),
                               min_partitions=8)
    return out.content_points.select("id", "filename", "page_number", "element_type", "file_hash")


@query("retry_failed", None, "O-109")
def retry_failed(spark, d):
    src = FX.fx_files(spark, d).select(F.col("object_key").alias("key"), "text")
    pts, _remaining, _summary = J.retry_failed(FX.fx_failed(spark, d), src, FX.fx_markdown(spark, d),
                                               FX.fx_embedding(spark, d), FX.fx_resident(spark, d))
    return pts.select("id", "filename", "page_number", "file_hash")


# ------------------------------------------------------------------ streams

@query("stream_ingest", None, "O-110")
def stream_ingest(spark, d):
    from corpusflow.session import scratch_path
    from corpusflow.streaming.ingest import stream_ingest as run
    import uuid
    tag = uuid.uuid4().hex[:10]
    schema = FX.table(spark, d, "documents").schema
    out = scratch_path(spark, f"stream-points-{tag}")
    run(spark, FX.table_pattern(d, "documents"), schema, out, scratch_path(spark, f"stream-ckpt-{tag}"), FX.fx_upload(spark, d),
        FX.fx_embedding(spark, d), FX.fx_resident(spark, d))
    return spark.read.parquet(out).select("id", "filename", "page_number", "file_hash", "epoch")


@query("stream_monitoring", """
SELECT CAST(date_trunc('hour', ts) AS VARCHAR) AS window_start, event_type, CAST(count(*) AS BIGINT) AS n_files,
  CAST(count_if(event_type = 'error') AS BIGINT) AS n_failed FROM events GROUP BY 1, 2""", "O-111")
def stream_monitoring(spark, d):
    return _streamed_rates(spark, d, "complete")


@query("stream_monitoring_append", """
SELECT CAST(date_trunc('hour', ts) AS VARCHAR) AS window_start, event_type, CAST(count(*) AS BIGINT) AS n_files,
  CAST(count_if(event_type = 'error') AS BIGINT) AS n_failed FROM events
WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL 10 MINUTE
GROUP BY 1, 2""", "O-111")
def stream_monitoring_append(spark, d):
    """Append mode: the windows that the watermark (10 minutes behind the newest event) has closed."""
    return _streamed_rates(spark, d, "append")


def _streamed_rates(spark, d, mode):
    from corpusflow.streaming.ingest import run_to_files, stream_rates
    rates = stream_rates(FX.table_stream(spark, d, "events"), "ts", failed=F.col("event_type") == "error", group_col="event_type")
    tab = run_to_files(rates, _scratch(spark, "monitor"), _scratch(spark, "monitor-ckpt"), mode)
    return tab.select(F.col("w.start").cast("string").alias("window_start"), "event_type",
                      F.col("n_files").cast("bigint").alias("n_files"), F.col("n_failed").cast("bigint").alias("n_failed"))


# ------------------------------------------------------------------ storage round trips

def _scratch(spark, name):
    import uuid
    from corpusflow.session import scratch_path
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:10]}")


@query("object_listing_content", None, "O-01 O-03 O-18")
def object_listing_content(spark, d):
    """binaryFile listing of the table folder with bytes read for every object, in blocks."""
    from corpusflow.sources.listing import content_md5, list_objects, read_content
    listing = list_objects(spark, d, glob="*.parquet")
    files = read_content(spark, d, listing.select("key", "size"), blocks=True, glob="*.parquet")
    return content_md5(files).select("key", "size", "etag")


@query("ledger_roundtrip", "SELECT filename, hash, stage, error FROM fx_failed", "O-16 O-17")
def ledger_roundtrip(spark, d):
    from corpusflow.sources import ledgers as L
    root = _scratch(spark, "ledgers")
    L.append_ledger(FX.fx_failed(spark, d), root, "failed")
    return L.read_ledger(spark, root, "failed").select("filename", "hash", "stage", "error")


@query("collection_roundtrip", """
SELECT 'content' AS name, CAST(count(*) AS BIGINT) AS points_count, CAST(count(vector) AS BIGINT) AS vectors_count,
  'green' AS status FROM fx_points""", "O-65 O-62 O-66")
def collection_roundtrip(spark, d):
    from corpusflow.operators.points import collection_info
    from corpusflow.sources import collections as C
    root = _scratch(spark, "collections")
    C.create_collection(spark, root, "content", 64, "Cosine")
    pts = FX.fx_points(spark, d).select(F.col("id").cast("string").alias("id"), "filename", "page_number", "vector")
    C.write_points(spark, root, "content", pts)
    C.write_points(spark, root, "content", pts)  # an upsert of the same ids changes nothing
    assert C.collection_exists(spark, root, "content") and C.list_collections(spark, root) == ["content"]
    return collection_info(C.read_points(spark, root, "content"), "content")


@query("markdown_store_roundtrip", None, "O-12 O-13")
def markdown_store_roundtrip(spark, d):
    from corpusflow.sources.markdown_store import read_markdown, write_markdown
    pages = FX.table(spark, d, "pages").select(
        F.concat(F.lit("source/web/page_"), F.col("page_id").cast("string"), F.lit(".html")).alias("key"), "html")
    ok, _failed = J.convert_only(pages)
    root = _scratch(spark, "markdown")
    write_markdown(ok, root)
    back = read_markdown(spark, root)
    return back.select("markdown_key", "source_key", F.md5("text").alias("markdown_md5"))


REGISTRY["markdown_store_roundtrip"] = (markdown_store_roundtrip, f"""
SELECT 'markdown/web/page_' || CAST(page_id AS VARCHAR) || '.md' AS markdown_key,
  'source/web/page_' || CAST(page_id AS VARCHAR) || '.html' AS source_key, md5(md) AS markdown_md5
FROM (SELECT page_id, {_html_sql()} AS md FROM pages) WHERE md <> ''""", "O-12 O-13")
REGISTRY["convert_only"] = (convert_only, REGISTRY["markdown_store_roundtrip"][1], "O-107 O-08")
