"""Best-fit packing of token pieces into fixed-length sequences by a grouping genetic algorithm.

Documents are tokenised where they lie; only (length, id) of the pieces is
shuffled. Pieces that fill a sequence on their own are done. The others are
dealt at random into blocks of about ``BLOCK`` pieces, and each block is packed
by ``ISLANDS`` islands. An island evolves a few packings: crossover injects whole
well-filled bins of one parent into the other, drops the bins that would hold a
piece twice, and best-fits the displaced pieces. After each epoch every island
sends its elite packing to the next island of its block (a join on block and
island). An island stops at the lower bound ceil(sum / capacity). Each block
leaves a few ill-filled bins; their pieces from all blocks are packed once more
in blocks of their own, so the loss does not add up over the blocks.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from math import ceil
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import tokens
from corpusflow.llm.common import ensure_parallel, stage, unstage

CAPACITY, BLOCK, ISLANDS, EPOCHS = 1024, 3000, 2, 2
POPULATION, GENERATIONS = 4, 4
#: share of the capacity from which a bin is passed on whole, and below which its pieces go to the second packing
WELL_FILLED, ILL_FILLED = 0.995, 0.98

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenise(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2, capacity: int = CAPACITY,
             keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents: ``doc_id, piece, start, length, ids_crc32`` (and ``ids`` if asked for).

    Ids are the library's; an added token's string is that token. A document's ids end with ``end_id``. More than ``capacity`` ids are cut into
    full pieces, the first of which is shorter unless the capacity divides them.
    A null text is an empty one: its piece is ``end_id`` alone.
    """
    path, end = tokenizer or tokens.default_path(), int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(path).many
        for batch in batches:
            out: list[list] = [[] for _ in range(6 if keep_ids else 5)]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text"))):
                ids += end
                n = len(ids) // 4
                a, b, piece = 0, n % capacity or capacity, 0
                if n <= capacity:
                    b = n
                while a < n:
                    part = ids[4 * a:4 * b]
                    for column, value in zip(out, (doc_id, piece, a, b - a, zlib.crc32(part), part)):
                        column.append(value)
                    a, b, piece = b, b + capacity, piece + 1
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names[:len(out)])

    rows = ensure_parallel(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    return rows.mapInArrow(run, PIECES + (", ids binary" if keep_ids else ""))


# --- one block -------------------------------------------------------------------------------------------------------


def best_fit(order, sizes, capacity: int, bins: list[list[int]], room: list[int]) -> None:
    """Put the pieces of ``order`` each into the fullest bin that has room; opens bins as needed."""
    free = sorted((r, b) for b, r in enumerate(room))
    for i in order:
        s = sizes[i]
        at = bisect_left(free, (s, -1))
        if at < len(free):
            r, b = free.pop(at)
            bins[b].append(i)
            room[b] = r - s
        else:
            b = len(bins)
            bins.append([i])
            room.append(capacity - s)
        if room[b]:
            insort(free, (room[b], b))


def _by_size(items, sizes) -> list[int]:
    return sorted(items, key=lambda i: (-sizes[i], i))


def _fills(bins, sizes) -> list[int]:
    return [sum(map(sizes.__getitem__, b)) for b in bins]


def _score(bins, sizes, capacity) -> tuple[int, float]:
    """Fewer bins first, then fuller ones."""
    return len(bins), -sum(f * f for f in _fills(bins, sizes))


def crossover(mine, theirs, sizes, capacity: int, rng) -> list[list[int]]:
    """Inject some of their well-filled bins whole, drop my bins they clash with, best-fit what that displaced."""
    well = [b for b, f in zip(theirs, _fills(theirs, sizes)) if f >= WELL_FILLED * capacity]
    taken = [b for b in well if rng.random() < 0.5]
    inside = {i for b in taken for i in b}
    kept = [b for b in mine if inside.isdisjoint(b)]
    displaced = [i for b in mine if not inside.isdisjoint(b) for i in b if i not in inside]
    # the worst bins are opened as well, or nothing but the injected bins could change
    fills = _fills(kept, sizes)
    order = sorted(range(len(kept)), key=fills.__getitem__)
    loose = min(len(kept), 2 + len(kept) // 50)
    displaced += [i for b in order[:loose] for i in kept[b]]
    bins = [list(kept[b]) for b in order[loose:]] + [list(b) for b in taken]
    room = [capacity - f for f in [*(fills[b] for b in order[loose:]), *_fills(taken, sizes)]]
    best_fit(_by_size(displaced, sizes), sizes, capacity, bins, room)
    return bins


def evolve(sizes, capacity: int, seeds: list[list[list[int]]], seed: int, population: int = POPULATION,
           generations: int = GENERATIONS) -> list[list[int]]:
    """The best packing an island finds, starting from ``seeds`` and best-fit packings of perturbed orders."""
    rng = np.random.default_rng(seed)
    bound = ceil(sum(sizes) / capacity)
    people = [[list(b) for b in s] for s in seeds]
    noise = 0.0
    while len(people) < population:
        bins: list[list[int]] = []
        shift = rng.random(len(sizes)) * noise * capacity
        best_fit(sorted(range(len(sizes)), key=lambda i: (-sizes[i] - shift[i], i)), sizes, capacity, bins, [])
        people.append(bins)
        noise += 0.05
        if len(bins) <= bound:
            return bins
    # each packing is scored once, when it is made
    scored = sorted(((_score(p, sizes, capacity), p) for p in people), key=itemgetter(0))
    for _ in range(generations):
        if len(scored[0][1]) <= bound:
            break
        a, b = (scored[x][1] for x in rng.choice(len(scored), 2, replace=False))
        children = [crossover(a, b, sizes, capacity, rng), crossover(b, a, sizes, capacity, rng)]
        scored += [(_score(p, sizes, capacity), p) for p in children]
        scored = sorted(scored, key=itemgetter(0))[:population]
    return scored[0][1]


def _labels(bins, n: int) -> list[int]:
    out = [0] * n
    for k, b in enumerate(bins):
        for i in b:
            out[i] = k
    return out


def _bins(labels) -> list[list[int]]:
    out: list[list[int]] = [[] for _ in range(max(labels, default=-1) + 1)]
    for i, k in enumerate(labels):
        out[k].append(i)
    return out


ISLAND = "block long, island int, ids array<long>, sizes array<int>, elite array<int>, n_bins int, filled double"


def _epoch(capacity: int, epoch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                sizes = r["sizes"]
                seeds = [_bins(x) for x in (r["elite"], r["migrant"]) if x]
                best = evolve(sizes, capacity, seeds, (r["block"] * 31 + r["island"]) * 31 + epoch)
                n, filled = _score(best, sizes, capacity)
                yield pa.RecordBatch.from_pylist([{
                    "block": r["block"], "island": r["island"], "ids": r["ids"], "sizes": sizes,
                    "elite": _labels(best, len(sizes)), "n_bins": n, "filled": float(-filled)}], schema=pa.schema([
                        ("block", pa.int64()), ("island", pa.int32()), ("ids", pa.list_(pa.int64())),
                        ("sizes", pa.list_(pa.int32())), ("elite", pa.list_(pa.int32())), ("n_bins", pa.int32()),
                        ("filled", pa.float64())]))
    return run


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``id, length, block, bin, offset, fill`` of finished blocks."""
    for batch in batches:
        for r in batch.to_pylist():
            label, size = np.array(r["elite"], np.int64), np.array(r["sizes"], np.int64)
            order = np.lexsort((-size, label))
            upto = np.cumsum(size[order])
            fill = np.bincount(label, size).astype(np.int64)
            offset = upto - size[order] - (np.cumsum(fill) - fill)[label[order]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(r["ids"], np.int64)[order]), pa.array(size[order]),
                 pa.array(np.full(len(order), r["block"])), pa.array(label[order]), pa.array(offset),
                 pa.array(fill[label[order]])], names=["id", "length", "block", "bin", "offset", "fill"])


def pack_blocks(items: DataFrame, capacity: int, n_items: int, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """Pack ``items(id, length)``: ``id, length, block, bin, offset, fill``."""
    blocks = max(1, ceil(n_items / BLOCK))
    state = (items.groupBy(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"))
             .agg(F.sort_array(F.collect_list(F.struct("id", F.col("length").cast("int").alias("length")))).alias("x"))
             .select("block", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
                     F.col("x.id").alias("ids"), F.col("x.length").alias("sizes"),
                     F.array().cast("array<int>").alias("elite"), F.array().cast("array<int>").alias("migrant")))
    spread = min(max(blocks * islands, 1), 4 * items.sparkSession.sparkContext.defaultParallelism)
    paths = []
    for epoch in range(epochs):
        state, path = stage(state.repartition(spread).mapInArrow(_epoch(capacity, epoch), ISLAND), "islands")
        paths.append(path)
        elite = state.select("block", F.pmod(F.col("island") + 1, F.lit(islands)).cast("int").alias("island"), F.col("elite").alias("migrant"))
        if epoch + 1 < epochs:
            state = state.drop("n_bins", "filled").join(elite, ["block", "island"])
    best = state.groupBy("block").agg(F.min_by("island", F.struct("n_bins", -F.col("filled"), "island")).alias("island"))
    done = state.join(best, ["block", "island"])
    out, _ = stage(done.mapInArrow(_places, "id long, length long, block long, bin long, offset long, fill long"), "places")
    unstage(items.sparkSession, *paths)
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to ``pieces(length, ...)``, every length from 1 to ``capacity``.

    Offsets of a sequence are gapless from 0. Repeated rows are packed one by
    one; columns besides ``length`` are carried. An empty table gives an empty
    result.
    """
    pieces, _ = stage(pieces.withColumn("__id", F.monotonically_increasing_id()), "pieces")
    full = pieces.where(F.col("length") >= capacity).withColumn("sequence_id", F.col("__id") * 4).withColumn("offset", F.lit(0).cast("long"))
    items = pieces.where(F.col("length") < capacity).select(F.col("__id").alias("id"), "length")
    first = pack_blocks(items, capacity, items.count())
    again = first.where(F.col("fill") < ILL_FILLED * capacity)
    second = pack_blocks(again.select("id", "length"), capacity, again.count())
    at = (first.where(F.col("fill") >= ILL_FILLED * capacity).select("id", (_number(0)).alias("sequence_id"), "offset")
          .union(second.select("id", (_number(1)).alias("sequence_id"), "offset")))
    rest = pieces.where(F.col("length") < capacity).join(at, F.col("__id") == F.col("id")).drop("id")
    return full.unionByName(rest).drop("__id")


def _number(level: int):
    """A number for a block's bin: bins stay far below 2**20 in a block of about ``BLOCK`` pieces."""
    return (F.col("block") * (1 << 20) + F.col("bin")) * 4 + 1 + level


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` (little-endian 32-bit) of pieces that carry ``ids``; a sequence is ``capacity`` ids at most."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: F.hex(x["ids"]))
    return packed.groupBy("sequence_id").agg(F.unhex(F.array_join(parts, "")).alias("ids"))


def packed_documents(docs: DataFrame, **options) -> DataFrame:
    """All pieces of ``docs`` with their places: the columns of ``tokenise`` and ``sequence_id, offset``."""
    capacity = options.get("capacity", CAPACITY)
    return pack(tokenise(docs, **options), capacity)
