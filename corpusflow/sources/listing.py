"""Corpus listing and object access (O-01 … O-05, O-14).

A listing is a DataFrame ``key, size, last_modified, etag`` (plus ``content``
when bytes are needed). ``list_objects`` reads any Hadoop file system with the
``binaryFile`` source; selecting only metadata columns prunes ``content`` from
the scan, so listing never reads file bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions import paths as P

LISTING_COLUMNS = ("key", "size", "last_modified", "etag")
#: paths named in a filter of one scan
PATHS_AT_ONCE = 10_000


def list_objects(spark: SparkSession, root: str, prefix: str = "", glob: str | None = None,
                 with_content: bool = False, relative_to: str | None = None) -> DataFrame:
    """Recursive listing under ``root/prefix`` (O-01, O-02).

    ``key`` is the path relative to ``relative_to`` (default ``root``). Keys
    ending in '/' (folder markers) are dropped. ``etag`` is the MD5 of the
    bytes when ``with_content`` is set (object stores report it for simple
    uploads), else null: computing it needs the bytes.
    """
    base = root.rstrip("/")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(base + "/" + prefix.lstrip("/") if prefix else base)
    cols = [_key((relative_to or base).rstrip("/")).alias("key"), F.col("length").alias("size"),
            F.col("modificationTime").alias("last_modified")]
    if with_content:
        cols += [F.md5(F.col("content")).alias("etag"), F.col("content")]
    else:
        cols += [F.lit(None).cast("string").alias("etag")]
    return df.select(*cols).where(~F.col("key").endswith("/"))


def _key(root: str):
    """An object's path relative to ``root``."""
    return F.regexp_replace(F.col("path"), r"^(file:)?/*" + _regex_quote(root.lstrip("/")) + "/", "")


def _regex_quote(s: str) -> str:
    return "".join("\\" + c if c in r".[]{}()\*+-?^$|" else c for c in s)


def with_prefix(listing: DataFrame, prefix: str, key: str = "key") -> DataFrame:
    """Restrict a listing to keys under a prefix (O-02); pushed to the scan for Parquet."""
    return listing.where(P.with_prefix(key, prefix))


def content_of(spark: SparkSession, root: str, wanted: DataFrame, key: str = "key", glob: str | None = None,
               paths_at_once: int = PATHS_AT_ONCE) -> DataFrame:
    """``key, content`` of the objects under ``root`` with a wanted key.

    Up to ``paths_at_once`` objects are named in a filter on the file path, which drops all
    others when the scan is planned, so that no other byte is read. More are found by a
    semi-join with a scan of the root.
    """
    base = root.rstrip("/")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    objects = (reader.option("pathGlobFilter", glob) if glob else reader).load(base)
    own = _key(base).alias(key)
    keys = wanted.select(key).distinct()
    uris = (objects.select(own, F.col("_metadata.file_path").alias("uri")).join(keys, key, "left_semi")
            .select("uri").limit(paths_at_once + 1).collect())
    if len(uris) > paths_at_once:
        return objects.select(own, "content").join(keys, key, "left_semi")
    return objects.where(F.col("_metadata.file_path").isin([r["uri"] for r in uris])).select(own, "content")


def read_content(spark: SparkSession, root: str, listing: DataFrame, key: str = "key", blocks: bool = False,
                 glob: str | None = None, paths_at_once: int = PATHS_AT_ONCE) -> DataFrame:
    """Attach bytes to listed keys (O-03); keys that cannot be read get null.

    A left join of the listing with the bytes of the listed keys (``content_of``), one row
    a key. With ``blocks`` an object of any size comes as rows ``object_size, split, block, content``
    of about a megabyte, in the order of split and block (``read_blocks``), and only
    listing rows are joined; ``content_md5`` takes these rows.
    """
    if not blocks:
        return listing.join(content_of(spark, root, listing, key, glob, paths_at_once), key, "left")
    read, few = read_blocks(spark, root, listing, key, glob, paths_at_once)
    found = list_objects(spark, root, glob=glob).select(F.col("key").alias(key))
    gone = listing.join(found, key, "left_anti")
    held = read.join(F.broadcast(listing) if few else listing, key)
    return held.unionByName(gone, allowMissingColumns=True).select(*listing.columns, *_BLOCK)


_BLOCK = ("object_size", "split", "block", "content")
BLOCK_BYTES = 1 << 20
#: names whose content the line reader would decompress
_PACKED = r"(?i)\.(gz|bz2|deflate|snappy|lz4|zst|zstd|passthrough)$"


def read_blocks(spark: SparkSession, root: str, wanted: DataFrame, key: str = "key", glob: str | None = None,
                paths_at_once: int = PATHS_AT_ONCE) -> tuple[DataFrame, bool]:
    """``key, object_size, split, block, content`` of the wanted objects, and whether there are ``paths_at_once`` at most.

    Objects are read split by split as lines of raw bytes, and neighbouring lines joined to
    blocks: an object is its blocks in the order of split and block, joined by one newline,
    with perhaps a byte order mark before and a newline after them. Objects named like
    compressed files are read as a whole, or the reader would decompress them.
    """
    base = root.rstrip("/")
    own = _key(base)

    def scan(kind: str):
        reader = spark.read.format(kind).option("recursiveFileLookup", "true").option("lineSep", "\n")
        return (reader.option("pathGlobFilter", glob) if glob else reader).load(base)

    path = F.col("_metadata.file_path")
    listed = scan("binaryFile").select(F.col("path"), path.alias("uri"))
    keys = wanted.select(key).distinct()
    uris = [r["uri"] for r in listed.select(own.alias(key), "uri").join(keys, key, "left_semi").select("uri").limit(paths_at_once + 1).collect()]
    few = len(uris) <= paths_at_once

    def chosen(df: DataFrame) -> DataFrame:
        return df.where(path.isin(uris)) if few else df

    # by the metadata alone, so that no other object is opened; one of three bytes may be a mark without a line
    whole = path.rlike(_PACKED) | (F.col("_metadata.file_size") <= 3)
    lines = chosen(scan("text")).where(~whole).select(
        path.alias("uri"), F.col("_metadata.file_size").alias("object_size"), F.col("_metadata.file_block_start").alias("split"),
        F.col("value").cast("binary").alias("content"))
    text = lines.mapInArrow(_joined, "uri string, object_size long, split long, block int, content binary")
    packed = chosen(scan("binaryFile")).where(whole).select(
        path.alias("uri"), F.col("length").alias("object_size"), F.lit(0).cast("long").alias("split"), F.lit(0).alias("block"), "content")
    named = listed.select("uri", own.alias(key)).join(keys, key, "left_semi")
    return text.unionByName(packed).join(F.broadcast(named) if few else named, "uri").drop("uri"), few


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring lines of a split as blocks of about ``BLOCK_BYTES``, numbered within the split."""
    last, number = None, 0
    for batch in batches:
        uri, size, split, content = batch.columns
        where = list(zip(uri.to_pylist(), split.to_pylist()))
        ends = np.cumsum(pc.binary_length(content).to_numpy(zero_copy_only=False).astype(np.int64) + 1) // BLOCK_BYTES
        cuts = [0, *(i for i in range(1, len(where)) if where[i] != where[i - 1] or ends[i] != ends[i - 1]), len(where)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            number = number + 1 if where[a] == last else 0
            last = where[a]
            yield pa.RecordBatch.from_arrays(
                [uri.slice(a, 1), size.slice(a, 1), split.slice(a, 1), pa.array([number], pa.int32()),
                 pa.array([b"\n".join(content.slice(a, b - a).to_pylist())], pa.binary())], names=["uri", "object_size", "split", "block", "content"])


def content_md5(blocks: DataFrame, key: str = "key") -> DataFrame:
    """``key``, the listing's other columns and ``etag``, the MD5 of the bytes, from ``read_content(..., blocks=True)``; keys are distinct.

    An object's blocks meet in one task in their order, where they pass through the digest one by one.
    """
    carry = [c for c in blocks.columns if c not in _BLOCK]
    rows = blocks.repartition(key).sortWithinPartitions(key, "split", "block").select(*carry, *_BLOCK)
    schema = T.StructType([*rows.select(*carry).schema.fields, T.StructField("etag", T.StringType())])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, row, size, held, found = None, None, None, 0, []

        def told() -> pa.RecordBatch:
            etag = None
            if found:
                # what the line reader leaves out: a newline at the end, a byte order mark
                missing = size - held
                if missing not in (0, 1, 3, 4):
                    raise ValueError(f"{at!r}: {held} bytes read of {size}")
                if missing % 3 == 1:
                    for d in found:
                        d.update(b"\n")
                etag = found[missing >= 3].hexdigest()
            return pa.RecordBatch.from_arrays([*row, pa.array([etag], pa.string())], names=schema.names)

        for batch in batches:
            names = batch.column(carry.index(key))
            for i in range(batch.num_rows):
                name, content = names[i].as_py(), batch.column(batch.num_columns - 1)[i]
                if row is None or name != at:
                    if row is not None:
                        yield told()
                    at, held, found = name, 0, []
                    # not slices: these would hold the batch's blocks
                    row = [batch.column(k).take(pa.array([i])) for k in range(len(carry))]
                    size = batch.column(len(carry))[i].as_py()
                if not content.is_valid:
                    continue
                first = not found
                if first:
                    found = [hashlib.md5(usedforsecurity=False), hashlib.md5(b"\xef\xbb\xbf", usedforsecurity=False)]
                body = content.as_buffer()
                for d in found:
                    if not first:
                        d.update(b"\n")
                    d.update(body)
                held += body.size + (not first)
        if row is not None:
            yield told()

    return rows.mapInArrow(digests, schema)


def object_exists(keys: DataFrame, listing: DataFrame, key: str = "key",
                  listing_key: str = "key", flag: str = "exists") -> DataFrame:
    """Add a boolean membership column (O-04); one left join on distinct keys."""
    present = listing.select(F.col(listing_key).alias("__k")).distinct().withColumn("__hit", F.lit(True))
    out = keys.join(present, keys[key] == present["__k"], "left")
    return out.withColumn(flag, F.coalesce(F.col("__hit"), F.lit(False))).drop("__k", "__hit")


def object_metadata(keys: DataFrame, listing: DataFrame, key: str = "key") -> DataFrame:
    """size, last_modified, etag and a content type for each requested key (O-05)."""
    meta = listing.select(
        F.col("key").alias(key), "size", "last_modified", "etag",
        content_type(F.col("key")).alias("content_type"))
    return keys.join(meta, key, "inner")


# Content types by extension for metadata lookups.
CONTENT_TYPES = {
    ".pdf": "application/pdf",
    ".md": "text/markdown",
    ".markdown": "text/markdown",
    ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    ".html": "text/html",
    ".txt": "text/plain",
}


def content_type(key) -> F.Column:
    ext = F.lower(P.suffix(key))
    expr = F.lit("application/octet-stream")
    for e, t in reversed(list(CONTENT_TYPES.items())):
        expr = F.when(ext == e, F.lit(t)).otherwise(expr)
    return expr


def first_n(listing: DataFrame, n: int, key: str = "key") -> DataFrame:
    """First N files in key order (O-14): a global top-N, partial per partition."""
    return listing.orderBy(key).limit(n)
