"""Exact deduplication by counting quotient filters.

A text's fingerprint is a 64-bit hash of its normalised form. A counting quotient
filter splits a fingerprint into a quotient (high bits) and a remainder: a bitmap
marks the quotients that occur, a second one the last slot of each quotient's run,
and a run holds its remainders in ascending order, each with a counter. Nothing is
lost, so filters merge exactly, by merging the sorted remainders and adding their
counters, whatever number of quotient bits either has.

Every partition builds filters of its own rows, cut into blocks of the fingerprint
range; blocks of the same range are merged in one task. A fingerprint counted once
belongs to a unique text. One counted more often routes its rows to byte
verification: their texts are grouped by all their bytes, so texts that only share
a fingerprint come apart again. The filters' counters also say which fingerprints
are frequent; rows of those are dealt over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import WORD_BREAK, ensure_parallel, stage, text_or_empty, unstage

#: entries a merged block should have at most, and fingerprints that one filter of a partition takes up
BLOCK_ENTRIES, FILTER_ROWS = 1 << 17, 1 << 20
#: a fingerprint with more than 1 / HOT_SHARE of all rows is dealt over several tasks; there are fewer than HOT_SHARE of them
HOT_SHARE = 2048
_FILTER = "block long, bits int, occupied binary, run_ends binary, remainders binary, counts binary"
_U = np.uint64


def normalised(text: Column) -> Column:
    """The text with each run of ``\\x20`` and ``\\x09-\\x0D`` as one space; null is empty."""
    return F.regexp_replace(text_or_empty(text), WORD_BREAK, " ")


def encode(fingerprints: np.ndarray, counts: np.ndarray, width: int) -> tuple[int, bytes, bytes, bytes, bytes]:
    """A filter of sorted distinct ``width``-bit fingerprints: quotient bits, occupied and run-end bitmaps, remainders, counters."""
    n = len(fingerprints)
    bits = min(max(0, n - 1).bit_length(), width)
    quotient = (fingerprints >> _U(width - bits)).astype(np.int64) if bits else np.zeros(n, np.int64)
    occupied = np.zeros(1 << bits, bool)
    occupied[quotient] = True
    run_end = np.append(quotient[1:] != quotient[:-1], True) if n else np.zeros(0, bool)
    remainder = fingerprints & _U((1 << (width - bits)) - 1)
    return (bits, np.packbits(occupied).tobytes(), np.packbits(run_end).tobytes(),
            remainder.astype("<u8").tobytes(), counts.astype("<i8").tobytes())


def decode(bits: int, occupied: bytes, run_ends: bytes, remainders: bytes, counts: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct fingerprints of a filter and their counters."""
    remainder = np.frombuffer(remainders, "<u8").astype(_U)
    n = len(remainder)
    ends = np.unpackbits(np.frombuffer(run_ends, np.uint8), count=n).astype(bool)
    run = np.cumsum(ends) - ends  # the slot's run, which is the rank of its quotient among the occupied ones
    quotient = np.flatnonzero(np.unpackbits(np.frombuffer(occupied, np.uint8), count=1 << bits))[run].astype(_U)
    high = quotient << _U(width - bits) if bits else np.zeros(n, _U)
    return high | remainder, np.frombuffer(counts, "<i8").astype(np.int64)


def merge(filters: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct fingerprints of several decoded filters, counters of equal ones added."""
    prints, counts = np.concatenate([f for f, _ in filters]), np.concatenate([c for _, c in filters])
    order = np.argsort(prints, kind="stable")  # runs are sorted already, so this merges them
    prints, counts = prints[order], counts[order]
    first = np.flatnonzero(np.append(True, prints[1:] != prints[:-1])) if len(prints) else np.zeros(0, np.int64)
    return prints[first], np.add.reduceat(counts, first) if len(first) else counts


def _blocks(prints: np.ndarray, counts: np.ndarray, width: int, block_bits: int) -> Iterator[tuple]:
    """``(block, *filter)`` for each block with entries; a block's filter leaves out the block's own bits."""
    rest = width - block_bits
    block = (prints >> _U(rest)).astype(np.int64) if block_bits else np.zeros(len(prints), np.int64)
    inner = prints & _U((1 << rest) - 1)
    cuts = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else []
    for a, b in zip(cuts, [*cuts[1:], len(block)]):
        yield (int(block[a]), *encode(inner[a:b], counts[a:b], rest))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 6
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      names=["block", "bits", "occupied", "run_ends", "remainders", "counts"])


def _build(width: int, block_bits: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            prints, counts = np.unique(np.concatenate(held), return_counts=True)
            rows = list(_blocks(prints, counts, width, block_bits))
            for i in range(0, len(rows), 4096):
                yield _batch(rows[i:i + 4096])

        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).view(_U))
            n += len(batch)
            if n >= FILTER_ROWS:
                yield from flush()
                held, n = [], 0
        if n:
            yield from flush()
    return run


def _merge_blocks(rest: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        rows = zip(*[table.column(c).to_pylist() for c in ("bits", "occupied", "run_ends", "remainders", "counts")])
        prints, counts = merge([decode(*r, rest) for r in rows])
        return pa.Table.from_batches([_batch([(table.column("block")[0].as_py(), *encode(prints, counts, rest))])])
    return run


def _repeated(rest: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, *parts in zip(*[c.to_pylist() for c in batch.columns]):
                prints, counts = decode(*parts, rest)
                more = counts > 1
                high = _U(block) << _U(rest) if rest < 64 else _U(0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((prints[more] | high).view(np.int64)), pa.array(counts[more])], names=["fp", "n"])
    return run


def filter_blocks(rows: DataFrame, n_rows: int, width: int = 64) -> tuple[DataFrame, int]:
    """The merged filter of ``rows(fp)``, one row a block, and the number of remainder and quotient bits in a block."""
    block_bits = min(width, max(0, ceil(log2(max(1, n_rows) / BLOCK_ENTRIES))))
    local = rows.select("fp").mapInArrow(_build(width, block_bits), _FILTER)
    return local.groupBy("block").applyInArrow(_merge_blocks(width - block_bits), _FILTER), width - block_bits


def counted_twice(rows: DataFrame, n_rows: int, width: int = 64) -> DataFrame:
    """``fp, n`` of the fingerprints of ``rows(fp)`` that the merged filters count more than once."""
    blocks, rest = filter_blocks(rows, n_rows, width)
    return blocks.mapInArrow(_repeated(rest), "fp long, n long")


def spread_join(rows: DataFrame, table: DataFrame, on: list[str], hot: DataFrame, how: str, *deal: str) -> DataFrame:
    """``rows`` joined to ``table(*on, parts, ...)``, rows of a frequent fingerprint dealt over ``parts`` tasks by ``deal``.

    ``hot(fp, parts)`` has the fingerprints of more than one part, fewer than
    ``HOT_SHARE``, so it may be broadcast. A row of the table is copied to each of its parts.
    """
    left = (rows.join(F.broadcast(hot), "fp", "left")
            .withColumn("__part", F.coalesce(F.pmod(F.xxhash64(*deal), F.col("parts")), F.lit(0).cast("long"))).drop("parts"))
    right = table.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
    return left.join(right, [*on, "__part"], how).drop("__part")


def exact_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 64) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their normalised forms are (each run of ``\\x20`` and
    ``\\x09-\\x0D`` read as one space). Of equal texts the row with the smallest
    doc_id stays; ``keep_id`` is its doc_id, ``group_size`` counts the rows.
    ``width`` is the number of fingerprint bits; fewer only route more texts to
    verification.

    A null text is empty, and all empty texts are one group. A null doc_id comes
    after all others; a group of null ids only has a null ``keep_id``. Of rows
    with equal text and doc_id exactly one is kept, whichever. Other columns are
    ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    raw = docs.select(F.col(doc_id).cast("long").alias("doc_id"), normalised(F.col(text)).alias("norm"))
    fp = F.shiftrightunsigned(F.xxhash64("norm"), 64 - width).alias("fp")
    rows, rows_path = stage(ensure_parallel(raw).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", fp, F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha")), "prints")
    total = rows.count()
    limit = max(1, total // HOT_SHARE)
    more, _ = stage(counted_twice(rows, total, width).withColumn("parts", F.ceil(F.col("n") / limit)), "repeated")
    hot = more.where(F.col("n") > limit).select("fp", "parts")

    # byte verification: only texts whose fingerprint is counted twice, grouped by all their bytes
    suspects = spread_join(raw.select("doc_id", "norm", fp), more.select("fp", "parts"), ["fp"], hot, "left_semi", "norm", "doc_id")
    verified, verified_path = stage(suspects.groupBy("fp", "norm").agg(F.count("*").alias("group_size"))
                                    .select("fp", F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha"), "group_size"), "verified")

    marked, _ = stage(spread_join(rows, more.withColumn("of", F.col("parts")), ["fp"], hot, "left", "row"), "marked")
    unstage(spark, rows_path)
    again = marked.where("n is not null").select("row", "doc_id", "fp", "sha", "of")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("first")
    groups, _ = stage(again.groupBy("fp", "sha", F.col("of").alias("parts")).agg(first).join(verified, ["fp", "sha"])
                      .select("fp", "sha", "parts", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"),
                              "group_size"), "groups")
    unstage(spark, verified_path)
    sha = F.lower(F.hex("sha")).alias("text_sha256")
    copies = spread_join(again.drop("of"), groups, ["fp", "sha"], hot, "inner", "row").select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), sha)
    alone = marked.where("n is null").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), sha)
    return alone.union(copies)
