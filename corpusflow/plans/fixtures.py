"""Derived views over the driver tables, in Spark and as DuckDB SQL.

Every view reads whole driver tables. The object listing gives each document
an object key with a mixed extension; ledger membership comes from the
``labels`` table (labelled documents were converted; quality 1 uploaded and
embedded into the file-name collection and resident in the content
collection; toxic 0 embedded into the content collection; toxic 1 failed),
so all four dedup outcomes occur without any id arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions import paths as P

T0 = "2025-01-01 00:00:00"
PAGES_T0 = "2025-02-01 00:00:00"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def table_stream(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A table as a file stream, whether it is one file or a folder of files: a stream takes either for a path with a pattern."""
    return spark.readStream.schema(table(spark, d, name).schema).parquet(table_pattern(d, name))


def table_pattern(d: str, name: str) -> str:
    return f"{d.rstrip('/')}/{{{name}.parquet}}"


def _minutes_after(t0: str, minutes) -> F.Column:
    return F.expr(f"timestamp_ntz'{t0}' + make_dt_interval(0, 0, CAST({minutes} AS INT), 0)")


def _ext():
    return (F.when(F.col("doc_id") % 10 == 0, ".docx").when(F.col("doc_id") % 10 == 6, ".md")
            .when(F.col("doc_id") % 10 == 7, ".MD").when(F.col("doc_id") % 10 == 8, ".DS_Store")
            .when(F.col("doc_id") % 10 == 9, ".markdown").otherwise(".pdf"))


def fx_files(spark: SparkSession, d: str) -> DataFrame:
    """Object listing: doc_id, text, lang, source, content_md5, size, object_key, ts."""
    docs = table(spark, d, "documents")
    return docs.select(
        "doc_id", "text", "lang", "source", F.md5(F.col("text")).alias("content_md5"),
        F.col("n_chars").alias("size"),
        F.concat(F.lit("source/"), "source", F.lit("/"), "lang", F.lit("/doc_"),
                 F.col("doc_id").cast("string"), _ext()).alias("object_key"),
        _minutes_after(T0, "doc_id").alias("ts"))


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    return fx_files(spark, d).join(table(spark, d, "labels"), "doc_id")


def fx_conversion(spark, d):
    return _labelled(spark, d).select(F.col("object_key").alias("filename"), F.col("content_md5").alias("hash"),
                                      F.col("ts").alias("datetime"), F.lit(None).cast("string").alias("error"))


def fx_upload(spark, d):
    return _labelled(spark, d).where("quality = 1").select(
        F.col("object_key").alias("filename"), F.col("content_md5").alias("hash"),
        F.col("ts").alias("datetime"), F.lit(None).cast("string").alias("error"))


def fx_embedding(spark, d):
    lab = _labelled(spark, d)
    content = lab.where("toxic = 0").select(
        F.col("ts").alias("timestamp"), F.col("object_key").alias("filename"),
        F.col("content_md5").alias("md5_hash"), F.lit("content").alias("collection_name"),
        (F.floor(F.col("size") / 2000) + 1).cast("int").alias("chunks_created"),
        F.round(F.col("size").cast("double") / 1000, 3).alias("embedding_time_seconds"),
        F.lit("bge-m3").alias("model_name"), F.lit("success").alias("status"))
    names = lab.where("quality = 1").select(
        F.col("ts").alias("timestamp"), F.col("object_key").alias("filename"),
        F.col("content_md5").alias("md5_hash"), F.lit("filenames").alias("collection_name"),
        F.lit(1).cast("int").alias("chunks_created"),
        F.round(F.length("object_key").cast("double") / 1000, 3).alias("embedding_time_seconds"),
        F.lit("granite-embedding:30m").alias("model_name"), F.lit("success").alias("status"))
    return content.unionByName(names)


def fx_resident(spark, d):
    """File hashes already present in the content collection."""
    return _labelled(spark, d).where("quality = 1").select(
        F.col("content_md5").alias("file_hash"), F.lit("content").alias("collection_name"))


# The failure stage names the reference's failed ledger uses.
FAILURE_STAGES = ("docling", "r2", "chunker", "ollama", "qdrant")


def _stage():
    n = F.substring("source", 4, 10).cast("int") % len(FAILURE_STAGES)
    out = F.lit(FAILURE_STAGES[-1])
    for i in range(len(FAILURE_STAGES) - 2, -1, -1):
        out = F.when(n == i, FAILURE_STAGES[i]).otherwise(out)
    return out


def fx_failed(spark, d):
    lab = _labelled(spark, d).where("toxic = 1")
    main = lab.select(P.basename("object_key").alias("filename"), F.col("content_md5").alias("hash"),
                      F.col("ts").alias("datetime"), F.lit("conversion failed").alias("error"),
                      _stage().alias("stage"))
    reproc = lab.where("quality = 0").select(
        P.original_name(P.mirrored_key("object_key")).alias("filename"), F.col("content_md5").alias("hash"),
        F.col("ts").alias("datetime"), F.lit("reprocess failed").alias("error"), F.lit("reprocess").alias("stage"))
    pages = table(spark, d, "pages").select(
        F.concat(F.lit("page_"), F.col("page_id").cast("string"), F.lit(".html")).alias("filename"),
        F.md5("html").alias("hash"), _minutes_after(PAGES_T0, "page_id").alias("datetime"),
        F.lit("unsupported format").alias("error"), F.lit(FAILURE_STAGES[0]).alias("stage"))
    return main.unionByName(reproc).unionByName(pages)


def fx_markdown(spark, d):
    """Markdown store: mirrored keys of converted documents."""
    lab = _labelled(spark, d)
    return lab.select(P.mirrored_key("object_key").alias("key"), F.col("size"),
                      F.col("object_key").alias("source_key"), "text")


def fx_md(spark, d):
    docs = table(spark, d, "documents")
    nl = "\n"
    k = F.col("doc_id") % 6
    text = (F.when(k == 1, F.concat(F.lit(f"| a | b |{nl}|---|---|{nl}| 1 | 2 |{nl}"), "text"))
            .when(k == 2, F.concat(F.lit(f"![fig](f.png){nl}{nl}"), "text"))
            .when(k == 3, F.concat(F.lit(f"```{nl}x = 1{nl}```{nl}"), "text"))
            .when(k == 4, F.concat(F.lit(f"- one{nl}- two{nl}{nl}{nl}"), "text"))
            .when(k == 5, F.concat(F.lit(f"1. one{nl}2. two{nl}{nl}"), "text"))
            .otherwise(F.col("text")))
    return docs.select("doc_id", "source", k.cast("int").alias("kind"), text.alias("text"))


def _etype():
    return (F.when(F.col("label") % 5 == 0, "Text").when(F.col("label") % 5 == 1, "Table")
          .when(F.col("label") % 5 == 2, "List").when(F.col("label") % 5 == 3, "Code").otherwise("Image"))


def fx_points(spark, d):
    e = table(spark, d, "embeddings")
    return e.select(
        F.col("vec_id").alias("id"),
        F.concat(F.lit("doc_"), F.floor(F.col("vec_id") / 10).cast("string"), F.lit(".pdf")).alias("filename"),
        (F.col("vec_id") % 10 + 1).cast("int").alias("page_number"),
        _etype().alias("element_type"),
        F.concat(F.lit("chunk "), F.col("vec_id").cast("string")).alias("pagecontent"),
        F.col("embedding").alias("vector"), "label")


def fx_filename_points(spark, d):
    """Stage-1 points: each file's page-1 row stands for its name vector."""
    return fx_points(spark, d).where("page_number = 1").select(
        "id", "filename", F.col("filename").alias("pagecontent"), "vector")


def fx_queries(spark, d):
    """Query vectors: the rows whose id is divisible by 100, asked against all rows."""
    return table(spark, d, "embeddings").where("vec_id % 100 = 0").select(
        F.col("vec_id").cast("string").alias("query_id"), F.col("embedding").alias("vector"))


def fx_geo(spark, d):
    s = table(spark, d, "supplier")
    return s.select("s_suppkey", "s_name",
                    ((F.col("s_suppkey") * 37) % 360 - 180).cast("double").alias("lon"),
                    ((F.col("s_suppkey") * 17) % 180 - 90).cast("double").alias("lat"))


# ---------------------------------------------------------------- DuckDB SQL
# The same views for the oracle (tables are pre-registered views there).

SQL = {
    "fx_files": """SELECT doc_id, text, lang, source, md5(text) AS content_md5, n_chars AS size,
  concat('source/', source, '/', lang, '/doc_', CAST(doc_id AS VARCHAR),
    CASE doc_id % 10 WHEN 0 THEN '.docx' WHEN 6 THEN '.md' WHEN 7 THEN '.MD'
      WHEN 8 THEN '.DS_Store' WHEN 9 THEN '.markdown' ELSE '.pdf' END) AS object_key,
  TIMESTAMP '2025-01-01 00:00:00' + doc_id * INTERVAL '1 minute' AS ts
FROM documents""",
    "fx_labelled": "SELECT f.*, l.quality, l.toxic FROM fx_files f JOIN labels l USING (doc_id)",
    "fx_conversion": "SELECT object_key AS filename, content_md5 AS hash, ts AS datetime, CAST(NULL AS VARCHAR) AS error FROM fx_labelled",
    "fx_upload": "SELECT object_key AS filename, content_md5 AS hash, ts AS datetime, CAST(NULL AS VARCHAR) AS error FROM fx_labelled WHERE quality = 1",
    "fx_embedding": """SELECT ts AS timestamp, object_key AS filename, content_md5 AS md5_hash, 'content' AS collection_name,
  CAST(floor(size / 2000) + 1 AS INTEGER) AS chunks_created, round(CAST(size AS DOUBLE) / 1000, 3) AS embedding_time_seconds,
  'bge-m3' AS model_name, 'success' AS status FROM fx_labelled WHERE toxic = 0
UNION ALL
SELECT ts, object_key, content_md5, 'filenames', 1, round(CAST(length(object_key) AS DOUBLE) / 1000, 3),
  'granite-embedding:30m', 'success' FROM fx_labelled WHERE quality = 1""",
    "fx_resident": "SELECT content_md5 AS file_hash, 'content' AS collection_name FROM fx_labelled WHERE quality = 1",
    "fx_failed": """SELECT regexp_extract(object_key, '[^/]*$') AS filename, content_md5 AS hash, ts AS datetime,
  'conversion failed' AS error,
  CASE CAST(substr(source, 4) AS INTEGER) % 5 WHEN 0 THEN 'docling' WHEN 1 THEN 'r2' WHEN 2 THEN 'chunker'
    WHEN 3 THEN 'ollama' ELSE 'qdrant' END AS stage
FROM fx_labelled WHERE toxic = 1
UNION ALL
SELECT CASE WHEN regexp_extract(object_key, '([^/]+)\\.[^./]+$', 1) LIKE '%.%'
            THEN regexp_extract(object_key, '([^/]+)\\.[^./]+$', 1)
            ELSE regexp_extract(object_key, '([^/]+)\\.[^./]+$', 1) || '.pdf' END,
  content_md5, ts, 'reprocess failed', 'reprocess' FROM fx_labelled WHERE toxic = 1 AND quality = 0
UNION ALL
SELECT 'page_' || CAST(page_id AS VARCHAR) || '.html', md5(html), TIMESTAMP '2025-02-01 00:00:00' + page_id * INTERVAL '1 minute',
  'unsupported format', 'docling' FROM pages""",
    "fx_markdown": """SELECT 'markdown/' || regexp_replace(substr(object_key, 8), '\\.[^./]+$', '') || '.md' AS key,
  size, object_key AS source_key, text FROM fx_labelled""",
    "fx_md": """SELECT doc_id, source, CAST(doc_id % 6 AS INTEGER) AS kind,
  CASE doc_id % 6
    WHEN 1 THEN concat('| a | b |', chr(10), '|---|---|', chr(10), '| 1 | 2 |', chr(10), text)
    WHEN 2 THEN concat('![fig](f.png)', chr(10), chr(10), text)
    WHEN 3 THEN concat(repeat('`', 3), chr(10), 'x = 1', chr(10), repeat('`', 3), chr(10), text)
    WHEN 4 THEN concat('- one', chr(10), '- two', chr(10), chr(10), chr(10), text)
    WHEN 5 THEN concat('1. one', chr(10), '2. two', chr(10), chr(10), text)
    ELSE text END AS text
FROM documents""",
    "fx_points": """SELECT vec_id AS id, concat('doc_', CAST(vec_id // 10 AS VARCHAR), '.pdf') AS filename,
  CAST(vec_id % 10 + 1 AS INTEGER) AS page_number,
  CASE label % 5 WHEN 0 THEN 'Text' WHEN 1 THEN 'Table' WHEN 2 THEN 'List' WHEN 3 THEN 'Code' ELSE 'Image' END AS element_type,
  concat('chunk ', CAST(vec_id AS VARCHAR)) AS pagecontent, CAST(embedding AS DOUBLE[]) AS vector, label
FROM embeddings""",
    "fx_filename_points": "SELECT id, filename, filename AS pagecontent, vector FROM fx_points WHERE page_number = 1",
    "fx_queries": """SELECT CAST(vec_id AS VARCHAR) AS query_id, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings WHERE vec_id % 100 = 0""",
    "fx_geo": """SELECT s_suppkey, s_name, CAST((s_suppkey * 37) % 360 - 180 AS DOUBLE) AS lon,
  CAST((s_suppkey * 17) % 180 - 90 AS DOUBLE) AS lat FROM supplier""",
}

# Dependencies between the SQL views, so an oracle query only carries what it uses.
_DEPS = {
    "fx_labelled": ["fx_files"],
    "fx_conversion": ["fx_labelled"], "fx_upload": ["fx_labelled"], "fx_embedding": ["fx_labelled"],
    "fx_resident": ["fx_labelled"], "fx_failed": ["fx_labelled"], "fx_markdown": ["fx_labelled"],
    "fx_filename_points": ["fx_points"],
}


def with_views(sql: str) -> str:
    """Prefix a query with the CTEs of the fixture views it names."""
    import re
    need: list[str] = []

    def add(name: str) -> None:
        for dep in _DEPS.get(name, []):
            add(dep)
        if name not in need:
            need.append(name)

    for name in SQL:
        if re.search(rf"\b{name}\b", sql):
            add(name)
    if not need:
        return sql
    ctes = ",\n".join(f"{n} AS (\n{SQL[n]}\n)" for n in need)
    head = re.match(r"\s*WITH\s", sql, re.IGNORECASE)
    if head:
        return f"WITH {ctes},\n{sql[head.end():]}"
    return f"WITH {ctes}\n{sql}"
