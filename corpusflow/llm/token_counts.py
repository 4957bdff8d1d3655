"""Token counts of flat, unindexed token files by a separator scan.

A file is a stream of little-endian unsigned 16-bit ids; a document ends with the
end-of-document id, and nothing else says where it starts. Files are read in
byte ranges (splits), each by its own task, by Spark's text reader. The line end
it is given is one byte, the end id's second, so lines say nothing yet about ids (and
none is longer than a document): each task lays its lines end to end again, which gives its block's bytes, and
searches these for the end id's two bytes, a batch of lines at a time in NumPy. A
task does not know if its block begins at an even byte of the file. A prefix
scan over the blocks' byte counts tells, drops matches across two ids, and adds an
end id that is cut by a block's start. A document that began in an earlier block is
stitched by two more prefix scans: the running maximum of the last end id's
position, and the running sum of their counts. One row per block and one per match
are shuffled, no ids.

Files are streams of their own: a document does not reach into the next file.
``write_token_files`` writes through Spark's text writer, whose line separator is
the end-of-document id's two bytes, so it reaches any file system Spark can.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusflow.llm import tokens
from corpusflow.llm.common import stage

END_ID = 50256
LEAST_SPLIT = 2048
_SPLITS = "spark.sql.files.minPartitionNum"
_SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Write each partition of ``docs(text)`` as one flat token file, not compressed so that it can be split, in row order; a null text is an empty document.

    Ids must be below 65536 and differ from ``end_id``, which holds for texts of
    the 50k byte-level vocabulary (special tokens' strings are ordinary text).
    """
    vocabulary = tokenizer or tokens.default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(vocabulary).ids
        for batch in batches:
            out = [np.frombuffer(encode(t.as_py() or ""), "<u4").astype("<u2").tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["ids"])

    flat = docs.select(F.col("text").cast("string")).mapInArrow(run, "ids binary").select(F.col("ids").cast("string").alias("value"))
    flat.write.option("lineSep", separator(end_id)).option("encoding", "ISO-8859-1").option("compression", "none").text(path)


def separator(end_id: int) -> str:
    """The end id's two bytes, as the text writer takes them."""
    if not 0 <= end_id < 1 << 16:
        raise ValueError("an end-of-document id has 16 bits")
    return int(end_id).to_bytes(2, "little").decode("latin-1")


def _lines(spark: SparkSession, path: str, end_id: int) -> DataFrame:
    """``file, size, block, value``: the bytes between the end id's second bytes, by split (``block`` is where it starts)."""
    # the encoding is that of the separator; the reader takes a line's bytes as they are
    text = (spark.read.option("lineSep", separator(end_id)[1]).option("encoding", "ISO-8859-1").option("pathGlobFilter", "part-*")
            .schema("value string").text(path))
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


def _search(end_id: int):
    """Matches of the end id's bytes in each block (``at``, from its first byte on), and the bytes of each part of a block.

    A part also has the block's first byte, if it begins it. Lines of a block come in order.
    """
    low, high = separator(end_id).encode("latin-1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, done = None, 0
        for batch in batches:
            files, sizes, blocks = (batch.column(c) for c in ("file", "size", "block"))
            lines = batch.column("value").cast(pa.large_binary())
            numbers, names = blocks.to_numpy(), files.dictionary_encode()
            names, codes = names.dictionary, names.indices.to_numpy()
            edge = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(codes) != 0)) + 1 if len(batch) else []
            for a, b in zip([0, *edge] if len(batch) else [], [*edge, len(batch)]):
                this = (names[int(codes[a])].as_py(), int(numbers[a]))
                if this != block:
                    block, done = this, 0
                part = lines.slice(a, b - a)
                offsets = np.frombuffer(part.buffers()[1], "<i8")[part.offset:part.offset + len(part) + 1]
                raw = np.frombuffer(part.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
                # the bytes as they stand in the file: the line end after each line, the byte before the part (a line end) in front
                stream = np.full(len(raw) + len(part) + 1, high, np.uint8)
                inner = np.ones(len(stream), bool)
                inner[0] = False
                inner[np.cumsum(np.diff(offsets) + 1)] = False
                stream[inner] = raw
                at = np.flatnonzero((stream[:-1] == low) & (stream[1:] == high)) - 1 + done
                at = at[at >= 0]
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([this[0]] * (n + 1), pa.string()), pa.array(np.full(n + 1, this[1])),
                     pa.array(np.full(n + 1, sizes[int(a)].as_py())), pa.array([*at, None], pa.int64()),
                     pa.array([None] * n + [len(stream) - 1], pa.int64()),
                     pa.array([None] * n + [None if done else int(stream[1])], pa.int32())],
                    names=["file", "block", "size", "at", "bytes", "first"])
                done += len(stream) - 1
    return run


def scan_token_files(spark: SparkSession, path: str, end_id: int = END_ID, block_tokens: int | None = None) -> DataFrame:
    """``file, ordinal, start, n_tokens, ended`` per document of the token files below ``path``.

    ``start`` and ``n_tokens`` (separator not counted) are in ids; ``ordinal``
    counts a file's documents from 0. Ids after the last separator are a document
    with ``ended`` false. An empty file has no documents; the last byte of a file of
    odd size is no id, and a file of just the three bytes of a byte order mark has no
    documents. ``block_tokens`` is the largest split, of ``LEAST_SPLIT`` bytes at
    least; by default the session's. ``end_id`` may be any id of 16 bits.
    """
    low, high = separator(end_id).encode("latin-1")
    before_ = spark.conf.get(_SPLIT_BYTES)
    if block_tokens:
        spark.conf.set(_SPLIT_BYTES, str(max(2 * block_tokens, LEAST_SPLIT)))
    try:
        found, _ = stage(_lines(spark, path, end_id).mapInArrow(
            _search(end_id), "file string, block long, size long, at long, bytes long, first int"), "token-matches")
    finally:
        spark.conf.set(_SPLIT_BYTES, before_)
    splits = found.where("at is null").groupBy("file", "block").agg(
        F.max("size").alias("size"), F.sum("bytes").alias("bytes"), F.max("first").alias("first"))
    earlier = F.coalesce(F.sum("bytes").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("bytes").over(Window.partitionBy("file"))
    # the reader leaves out three bytes at a file's start that look like a byte order mark; only then the lines are too short
    mark = F.when(total < F.col("size"), 3).otherwise(0)
    placed = splits.select("file", "block", "size", "first", mark.alias("lost"), earlier.alias("before"))
    at0 = placed.select("file", "block", "size", "first", "lost", "before", (F.col("before") + F.col("lost")).alias("at0"))
    inner = found.where("at is not null").select("file", "block", "at").join(at0.select("file", "block", "size", "at0"), ["file", "block"]).select(
        "file", "block", "size", (F.col("at0") + F.col("at")).alias("byte"))
    # the byte before a block is a line end, or the last of the mark, or there is none
    previous = F.when(F.col("before") > 0, high).when(F.col("lost") > 0, 0xBF)
    cut_by_start = at0.where((previous == low) & (F.col("first") == high)).select("file", "block", "size", (F.col("at0") - 1).alias("byte"))
    in_mark = at0.where((F.col("before") == 0) & (F.col("lost") > 0) & F.lit(end_id == 0xBBEF)).select(
        "file", "block", "size", F.lit(0).cast("long").alias("byte"))
    by_byte = Window.partitionBy("file", "block").orderBy("byte")
    marks = (inner.unionByName(cut_by_start).unionByName(in_mark).where("byte % 2 = 0 and byte + 2 <= size")
             .select("file", "block", F.shiftright("byte", 1).alias("at"), (F.row_number().over(by_byte) - 1).alias("k"),
                     F.shiftright(F.lag("byte").over(by_byte), 1).alias("previous")))
    last = marks.groupBy("file", "block").agg(F.max("at").alias("last"), F.count("*").alias("n"))
    blocks = placed.select("file", "block", F.shiftright("size", 1).alias("end")).join(last, ["file", "block"], "left")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    scan = blocks.select("file", "block", F.coalesce(F.max("last").over(before), F.lit(-1)).alias("carry"),
                         F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    whole = marks.join(scan, ["file", "block"]).withColumn("start", F.coalesce("previous", "carry") + 1).select(
        "file", (F.col("base") + F.col("k")).alias("ordinal"), "start", (F.col("at") - F.col("start")).alias("n_tokens"),
        F.lit(True).alias("ended"))
    of_file = blocks.groupBy("file").agg(F.max("end").alias("end"), F.coalesce(F.max("last"), F.lit(-1)).alias("last"),
                                         F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    cut = of_file.where("end > last + 1").select(
        "file", F.col("n").alias("ordinal"), (F.col("last") + 1).alias("start"), (F.col("end") - F.col("last") - 1).alias("n_tokens"),
        F.lit(False).alias("ended"))
    return whole.unionByName(cut)


def file_number(path: Column) -> Column:
    """Number of the partition that wrote a file."""
    return F.regexp_extract(path, r"part-(\d+)", 1).cast("long")


def document_counts(spark: SparkSession, docs: DataFrame, path: str) -> DataFrame:
    """Write ``docs`` as token files below ``path``, scan these, and name the documents again.

    ``doc_id, file_no, ordinal, start, n_tokens``. ``docs`` must be a table as it
    was read, so that both passes see the same partitions in the same order; the
    number of splits is held over both, as it else follows the executors that
    happen to be there, and the rows' numbers are staged. A null text is an empty document; repeated rows are documents of their own;
    null doc_ids stay null; an empty table gives an empty result.
    """
    spark_splits, cores = spark.conf.get(_SPLITS, None), spark.sparkContext.defaultParallelism
    spark.conf.set(_SPLITS, spark_splits or cores)
    try:
        write_token_files(docs, path)
        low = F.monotonically_increasing_id()
        named, _ = stage(docs.select("doc_id", F.shiftright(low, 33).alias("file_no"), low.bitwiseAND((1 << 33) - 1).alias("ordinal")),
                         "token-rows")
    finally:
        spark.conf.unset(_SPLITS) if spark_splits is None else spark.conf.set(_SPLITS, spark_splits)
    counted = scan_token_files(spark, path).select(file_number(F.col("file")).alias("file_no"), "ordinal", "start", "n_tokens")
    both = named.withColumn("row", F.lit(1)).join(counted, ["file_no", "ordinal"], "full")
    lost = F.col("row").isNull() | F.col("n_tokens").isNull()
    n_tokens = F.when(lost, F.raise_error(F.lit("token files and rows differ in their documents")).cast("long")).otherwise(F.col("n_tokens"))
    return both.select("doc_id", "file_no", "ordinal", "start", n_tokens.alias("n_tokens"))
