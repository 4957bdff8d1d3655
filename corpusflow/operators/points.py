"""Point tables and collection inspection (O-59 … O-71).

Points are rows ``id, vector, pagecontent, filename, page_number,
element_type, md5_hash, file_hash`` (content) or ``id, vector, pagecontent,
source, file_hash`` (file names). Ids are uuid5 of the name (and chunk
number), so writes are idempotent and a retried task rewrites the same ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions import hashing as H
from corpusflow.functions import paths as P

# Fixed value: failure stage name for files whose points could not be written.
UPLOAD_STAGE = "qdrant"


def filename_points(files: DataFrame, key_col: str = "key", hash_col: str | None = None,
                    content_col: str | None = None, vector_col: str | None = None,
                    id_scope: str = "name") -> DataFrame:
    """One point per file (O-59): id = uuid5(basename) (or of the key with
    ``id_scope='key'``), pagecontent = basename, source = key, file_hash."""
    name = P.basename(key_col)
    ident = H.uuid5(name if id_scope == "name" else F.col(key_col))
    if hash_col:
        fh = F.col(hash_col)
    elif content_col:
        fh = H.light_hash(content_col)
    else:
        fh = F.lit(None).cast("string")
    cols = [ident.alias("id"), name.alias("pagecontent"), F.col(key_col).alias("source"), fh.alias("file_hash")]
    if vector_col:
        cols.append(F.col(vector_col).alias("vector"))
    return files.select(*cols)


def content_points(chunks: DataFrame, vectors: DataFrame | None = None,
                   vector_col: str = "vector", file_hash_col: str | None = "file_hash",
                   id_scope: str = "name", key_col: str = "key", keep: tuple[str, ...] = ()) -> DataFrame:
    """One point per chunk with a vector (O-60); chunks without one are dropped. ``keep`` names further columns.

    ``chunks`` has filename, chunk_number, text, element_type, md5_hash (and
    optionally the vector already); ``vectors`` is joined on
    (filename, chunk_number) when given. Ids are uuid5 of
    '<base name>_<chunk number>'; ``id_scope='key'`` uses the full object key
    instead, so equal base names in two directories do not collide.
    """
    df = chunks
    if vectors is not None:
        df = df.join(vectors.select("filename", "chunk_number", vector_col), ["filename", "chunk_number"], "left")
    name = F.col(key_col) if id_scope == "key" else F.col("filename")
    out = df.where(F.col(vector_col).isNotNull()).select(
        H.chunk_point_id(name, "chunk_number").alias("id"),
        F.col(vector_col).alias("vector"),
        F.col("text").alias("pagecontent"),
        "filename",
        F.col("chunk_number").alias("page_number"),
        "element_type",
        "md5_hash",
        (F.col(file_hash_col) if file_hash_col and file_hash_col in df.columns else F.lit(None).cast("string")).alias("file_hash"),
        *keep,
    )
    return out


def files_without_points(chunks: DataFrame, points: DataFrame) -> DataFrame:
    """Files that had chunks but no valid point: failures of the upload stage."""
    return (chunks.select("filename").distinct()
            .join(points.select("filename").distinct(), "filename", "left_anti")
            .withColumn("error", F.lit("no valid embeddings")).withColumn("stage", F.lit(UPLOAD_STAGE)))


def length_agreement(chunks: DataFrame, vectors: DataFrame, file_col: str = "filename") -> DataFrame:
    """Per file: chunk count vs vector count, full outer join (O-61)."""
    c = chunks.groupBy(file_col).agg(F.count(F.lit(1)).cast("bigint").alias("n_chunks"))
    v = vectors.groupBy(file_col).agg(F.count(F.lit(1)).cast("bigint").alias("n_vectors"))
    j = c.join(v, file_col, "full_outer").fillna(0, ["n_chunks", "n_vectors"])
    return j.withColumn("lengths_agree", F.col("n_chunks") == F.col("n_vectors"))


PAGES_AT_ONCE = 4096


def write_batches(points: DataFrame, batch_size: int, file_col: str = "filename", order_col: str = "page_number") -> DataFrame:
    """Batch number (1-based) and batch count per file for slices of ``batch_size`` of the points there are (O-63).

    Rows are numbered inside blocks of page numbers and shifted by the counts of
    the file's earlier blocks, so no window has to hold a whole file and pages
    that were dropped leave no holes.
    """
    block = F.floor((F.col(order_col) - 1) / PAGES_AT_ONCE)
    rows = points.withColumn("__block", block)
    by_block = Window.partitionBy(file_col).orderBy("__block")
    shifts = rows.groupBy(file_col, "__block").agg(F.count(F.lit(1)).alias("__n")).select(
        file_col, "__block", (F.sum("__n").over(by_block) - F.col("__n")).alias("__before"),
        F.sum("__n").over(Window.partitionBy(file_col)).alias("__all"))
    inside = Window.partitionBy(file_col, "__block").orderBy(order_col, "id")
    return (rows.withColumn("__rn", F.row_number().over(inside)).join(shifts, [file_col, "__block"])
            .withColumn("batch_number", (F.floor((F.col("__before") + F.col("__rn") - 1) / batch_size) + 1).cast("int"))
            .withColumn("batch_count", F.ceil(F.col("__all") / batch_size).cast("int"))
            .drop("__block", "__rn", "__before", "__all"))


def upload_point_ids(points: DataFrame, file_col: str = "filename") -> DataFrame:
    """Every uploaded point of every file, one row each: what the ledger's id list is a view of (O-64)."""
    return points.select(file_col, "page_number", F.col("id").alias("point_id"))


def upload_ledger_rows(points: DataFrame, batch_size: int, collection: str,
                       file_col: str = "filename", hash_col: str = "file_hash") -> DataFrame:
    """Per file: points uploaded and batch size (O-64); the ids are the rows of ``upload_point_ids``."""
    agg = points.groupBy(file_col).agg(
        F.count(F.lit(1)).cast("int").alias("points_uploaded"),
        F.min(hash_col).alias("md5_hash"))
    return agg.select(
        F.current_timestamp().alias("timestamp"), F.col(file_col).alias("filename"), "md5_hash",
        F.lit(collection).alias("collection_name"), "points_uploaded",
        F.lit(batch_size).cast("int").alias("batch_size"),
        F.lit(None).cast("double").alias("upload_time_seconds"), F.lit("success").alias("status"))


def collection_info(points: DataFrame, name: str) -> DataFrame:
    """name, points_count, vectors_count, status (O-66)."""
    return points.agg(
        F.lit(name).alias("name"),
        F.count(F.lit(1)).cast("bigint").alias("points_count"),
        F.count("vector").cast("bigint").alias("vectors_count"),
        F.lit("green").alias("status"))


def scroll(points: DataFrame, limit: int, after_id: str | None = None, condition=None,
           with_vector: bool = False, payload: tuple[str, ...] | None = None) -> DataFrame:
    """One keyset page: ids greater than the cursor, in id order (O-67).

    The next page starts after the last id returned. The limit is the page
    size — the feature itself; a filter and the cursor reach the scan.
    """
    df = points
    if condition is not None:
        df = df.where(condition)
    if after_id is not None:
        df = df.where(F.col("id") > after_id)
    cols = ["id"] + (list(payload) if payload is not None else [c for c in df.columns if c not in ("id", "vector")])
    if with_vector:
        cols.append("vector")
    return df.select(*cols).orderBy("id").limit(limit)


def sample_view(points: DataFrame, n: int = 10, head: int = 5, text_len: int = 100,
                text_col: str = "pagecontent") -> DataFrame:
    """n points with the first vector values and text cut to ``text_len`` + '...' (O-68)."""
    t = F.col(text_col)
    return points.orderBy("id").limit(n).select(
        "id", F.size("vector").alias("dim"),
        *[F.round(F.col("vector")[i].cast("double"), 6).alias(f"v{i}") for i in range(head)],
        F.when(F.length(t) > text_len, F.concat(F.substring(t, 1, text_len), F.lit("...")))
        .otherwise(t).alias("preview"))


def vector_profile(points: DataFrame, vector_col: str = "vector") -> DataFrame:
    """Count of points per stored vector size (O-69)."""
    return points.groupBy(F.size(vector_col).cast("int").alias("dim")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_points"))


def payload_presence(points: DataFrame, expected: tuple[str, ...]) -> DataFrame:
    """For each expected field: how many points carry it (O-70), one pass."""
    cols = set(points.columns)
    aggs = [(F.count(F.col(f)) if f.split(".")[0] in cols else F.lit(0)).cast("bigint").alias(f"c{i}")
            for i, f in enumerate(expected)]
    one = points.agg(F.count(F.lit(1)).cast("bigint").alias("n"), *aggs)
    stack = ", ".join(f"'{f}', c{i}" for i, f in enumerate(expected))
    return one.selectExpr("n", f"stack({len(expected)}, {stack}) as (field, present)").select(
        "field", "present", (F.col("present") == F.col("n")).alias("in_all"))
