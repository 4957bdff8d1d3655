"""MinHash near-duplicate detection.

One hash per shingle: the 64-bit range is cut into ``BANDS * ROWS`` bins and a
bin's value is its smallest shingle hash (one-permutation hashing). An empty
bin copies the value of the first filled bin in a fixed random order of its own
(optimal densification), so all bins stay comparable whatever a set's size.
``ROWS`` bins make a band; two sets with similarity 0.75 agree on none of the
40 bands with probability 2e-5.

Equal sets are collapsed to one class first. Each bucket (equal band values)
then gives a star, every class to one centre, never all pairs. The centre is the
class whose bands lie in the largest buckets, the most typical member: where many
texts derive from one, it is that one. Star links are confirmed on the full sets.

A star can hide a link between two leaves that its centre is not linked to. So
members of buckets that still hold more than one component are matched once more,
by exact prefix filtering: two sets that overlap enough must share a shingle
among the rarest seventh of the smaller and the rarest quarter of the larger.
Only pairs of different components are formed. The outcome equals checking every
pair of every bucket, while a bucket of true copies costs one edge per member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm import texthash as H
from corpusflow.llm.common import ensure_parallel, rows_repeat, stage, unstage
from corpusflow.llm.components import connected_components

BANDS, ROWS, SHINGLE = 40, 5, 5
MIN_PERCENT = 75
_BINS = BANDS * ROWS
_EDGES = np.array([(i << 64) // _BINS for i in range(_BINS)], np.uint64)
#: _ORDER[i, j]: place of bin j in empty bin i's random order of donors
_ORDER = np.argsort(np.argsort(H.mix(
    np.arange(_BINS * _BINS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(7)).reshape(_BINS, _BINS), axis=1),
    axis=1).astype(np.int16)
_BAND_SALT = H.mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def shingle_set(word_hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle as a whole."""
    n = len(word_hashes)
    return np.unique(H.windows(word_hashes, min(size, n))) if n else np.zeros(0, np.uint64)


def band_values(shingles: np.ndarray) -> np.ndarray:
    """The ``BANDS`` band hashes of a non-empty sorted shingle set."""
    at = np.searchsorted(shingles, _EDGES)
    filled = np.append(at[1:], len(shingles)) > at
    value = shingles[np.minimum(at, len(shingles) - 1)]
    if not filled.all():
        donors, empty = np.flatnonzero(filled), np.flatnonzero(~filled)
        value[empty] = value[donors[np.argmin(_ORDER[np.ix_(empty, donors)], axis=1)]]
    rows = H.mix(value).reshape(BANDS, ROWS)
    total = _BAND_SALT.copy()
    for r in range(ROWS):
        total = H.mix(total + rows[:, r])
    return total


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = len(batch)
        count, lo, hi, bands = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64), [None] * n
        for row, h in H.texts(batch.column("text"), fold_case=True):
            if len(h):
                s = shingle_set(h)
                count[row], lo[row], hi[row] = len(s), s.sum(dtype=np.uint64), H.mix(s).sum(dtype=np.uint64)
                bands[row] = H.signed(band_values(s))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(count), pa.array(H.signed(lo)), pa.array(H.signed(hi)),
             pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "text_hash", "n_shingles", "lo", "hi", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Full sets of the candidate classes; a row whose text is not its class's is left out."""
    for batch in batches:
        lo, hi = (batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("lo", "hi"))
        keep, sets = [], []
        for row, h in H.texts(batch.column("text"), fold_case=True):
            s = shingle_set(h)
            if s.sum(dtype=np.uint64) == lo[row] and H.mix(s).sum(dtype=np.uint64) == hi[row]:
                keep.append(row)
                sets.append(H.signed(s))
        yield pa.RecordBatch.from_arrays(
            [batch.column("class").take(pa.array(keep, pa.int64())), pa.array(sets, pa.list_(pa.int64()))],
            names=["class", "shingles"])


def _confirmed(edges: DataFrame, sets: DataFrame, min_percent: int) -> DataFrame:
    """The ``edges(a, b)`` whose full sets overlap enough."""
    a = sets.select(F.col("class").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("class").alias("b"), F.col("shingles").alias("sb"))
    na, nb = F.size("sa"), F.size("sb")
    common = F.size(F.array_intersect("sa", "sb"))
    return (edges.join(a, "a").join(b, "b")
            .where(100 * F.least(na, nb) >= min_percent * F.greatest(na, nb))
            .where(100 * common >= min_percent * (na + nb - common))
            .select("a", "b"))


def near_duplicates(docs: DataFrame, text: str | Column = "text", doc_id: str | Column = "doc_id",
                    min_percent: int = MIN_PERCENT) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when 100 * intersection >= ``min_percent`` * union of
    their sets of lower-cased 5-word shingles. ``component_id`` is the smallest
    doc_id reachable over links, ``kept`` marks ``doc_id = component_id``.

    Null, empty and blank texts have an empty set, are linked with nothing and
    kept (component_id = doc_id). Shorter texts are one shingle. Repeated rows
    are exact copies; each row appears in the result. A null doc_id takes part,
    but a component is named by its smallest non-null id (null only if it has
    none, and then ``kept`` is true). Other columns are ignored; an empty table
    gives an empty result.
    """
    return grouped_rows(docs, text, doc_id, min_percent).select("doc_id", "n_shingles", "component_id", "kept")


def text_hash(text: str | Column) -> Column:
    return F.xxhash64((F.col(text) if isinstance(text, str) else text).cast("string"))


def grouped_rows(docs: DataFrame, text: str | Column = "text", doc_id: str | Column = "doc_id",
                 min_percent: int = MIN_PERCENT) -> DataFrame:
    """``near_duplicates`` with each row's ``text_hash``, and ``stays``: whether it is its component's first row.

    First is the smallest (doc_id, text_hash), null ids last. Rows with equal
    values of both are true copies and marked alike. A row without shingles is a
    component of its own.
    """
    spark = docs.sparkSession
    text, doc_id = (F.col(c) if isinstance(c, str) else c for c in (text, doc_id))
    rows = docs.select(doc_id.cast("long").alias("doc_id"), text.cast("string").alias("text"))
    hashed = rows.withColumn("text_hash", text_hash("text"))
    sig, sig_path = stage(ensure_parallel(hashed).mapInArrow(
        _signatures, "doc_id long, text_hash long, n_shingles long, lo long, hi long, bands array<long>"), "minhash")

    # equal sets become one class; bands of the class are those of any member
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    classes, _ = stage(
        sig.where("n_shingles > 0").groupBy("lo", "hi")
        .agg(F.min("doc_id").alias("rep"), F.min(first).alias("first"), F.first("bands").alias("bands"))
        .withColumn("class", F.monotonically_increasing_id()), "classes")
    member = classes.select("class", F.explode("bands").alias("bucket"))
    shared = (member.groupBy("bucket").agg(F.min("class").alias("first"), F.max("class").alias("last"), F.count("*").alias("size"))
              .where("first <> last").select("bucket", "size"))
    crowd, crowd_path = stage(member.join(shared, "bucket"), "buckets")
    score = crowd.groupBy("class").agg(F.sum("size").alias("score"))
    center = (crowd.select("bucket", "class").join(score, "class").groupBy("bucket")
              .agg(F.max_by("class", F.struct("score", -F.col("class"))).alias("center")))

    # a class's text is found by row: two rows of one id and text hash are true copies
    wanted = (crowd.select("class").distinct().join(classes.select("class", "first", "lo", "hi"), "class")
              .select("class", "lo", "hi", F.col("first.doc_id").alias("of"), F.col("first.text_hash").alias("of_hash")))
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("of_hash"))
    found = (hashed.join(wanted, same).select("class", "lo", "hi", "text")
             .mapInArrow(_sets, "class long, shingles array<long>"))
    sets, sets_path = stage(found.dropDuplicates(["class"]) if rows_repeat(sig, "doc_id", "text_hash") else found, "sets")

    edges = (crowd.select("bucket", "class").join(center.select("bucket", "center"), "bucket").where("class <> center")
             .select(F.greatest("class", "center").alias("a"), F.least("class", "center").alias("b")).distinct())
    links, _ = stage(_confirmed(edges, sets, min_percent), "links")
    labels, _ = stage(connected_components(links), "components")
    open_, open_path = stage(_open_members(crowd, labels), "open")
    if open_.limit(1).count():
        more, more_path = stage(_confirmed(_rare_pairs(open_, sets, min_percent), sets, min_percent), "links")
        if more.limit(1).count():
            labels, _ = stage(_joined(labels, more), "components")
        unstage(spark, more_path)
    unstage(spark, crowd_path, sets_path, open_path)

    named = (classes.select("class", "rep", "first", "lo", "hi")
             .join(labels.withColumnRenamed("node", "class"), "class", "left")
             .withColumn("component", F.coalesce("component", "class")))
    names = named.groupBy("component").agg(F.min("rep").alias("component_id"), F.min("first").alias("of"))
    of_class = named.select("component", "lo", "hi").join(names, "component").select("lo", "hi", "component_id", "of")
    stays = F.col("doc_id").eqNullSafe(F.col("of.doc_id")) & (F.col("text_hash") == F.col("of.text_hash"))
    out = (sig.select("doc_id", "text_hash", "n_shingles", "lo", "hi").where("n_shingles > 0").join(of_class, ["lo", "hi"])
           .select("doc_id", "n_shingles", "component_id", "text_hash", stays.alias("stays"))
           .union(sig.where("n_shingles = 0").select(
               "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "text_hash", F.lit(True))))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after more links: only the components that these join are worked on."""
    def named(df: DataFrame, end: str) -> DataFrame:
        of = labels.select(F.col("node").alias(end), F.col("component").alias("c"))
        return df.join(of, end, "left").withColumn(end, F.coalesce("c", end)).drop("c")

    merged = connected_components(named(named(links, "a"), "b").where("a <> b"))
    new = merged.select(F.col("node").alias("component"), F.col("component").alias("to"))
    return (labels.join(new, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
            .union(merged.join(labels, "node", "left_anti").select("node", "component")))


def _open_members(crowd: DataFrame, labels: DataFrame) -> DataFrame:
    """``class, component`` of the members of buckets that still hold more than one component."""
    now = (crowd.select("bucket", "class").join(labels.withColumnRenamed("node", "class"), "class", "left")
           .withColumn("component", F.coalesce("component", "class")))
    mixed = now.groupBy("bucket").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 <> c1")
    return now.join(mixed.select("bucket"), "bucket", "left_semi").select("class", "component").distinct()


def _rare_pairs(members: DataFrame, sets: DataFrame, min_percent: int) -> DataFrame:
    """Pairs of different components that prefix filtering cannot rule out.

    Shingles are ordered by how many members have them, rarest first. Of two
    linked sets of sizes n <= m the smaller shares one of its first
    n - ceil(2tn / (1 + t)) + 1 shingles with the first m - ceil(tm) + 1 of the
    larger, t being the least similarity; and from the first shared one on, both
    must have enough left (positional filter).
    """
    rows = members.join(sets, "class").select("class", "component", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    often = rows.groupBy("shingle").agg(F.count("*").alias("often"))
    rank = F.row_number().over(Window.partitionBy("class").orderBy("often", "shingle"))
    far = F.expr(f"n - ({min_percent} * n + 99) div 100 + 1")
    near = F.expr(f"n - ({2 * min_percent} * n + {99 + min_percent}) div {100 + min_percent} + 1")
    prefix = (rows.join(often, "shingle").withColumn("rank", rank).where((F.col("rank") <= far) & (F.col("often") > 1))
              .withColumn("near", F.col("rank") <= near).select("class", "component", "n", "shingle", "rank", "near"))
    prefix, _ = stage(prefix, "prefixes")
    mixed = prefix.groupBy("shingle").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 <> c1")
    prefix = prefix.join(mixed.select("shingle"), "shingle", "left_semi")
    small = prefix.where("near").select("shingle", F.col("class").alias("a"), F.col("component").alias("ca"), F.col("n").alias("na"), F.col("rank").alias("ra"))
    large = prefix.select("shingle", F.col("class").alias("b"), F.col("component").alias("cb"), F.col("n").alias("nb"), F.col("rank").alias("rb"))
    # nothing before the first common shingle is shared, so the rest must suffice
    enough = f"least(na - ra, nb - rb) + 1 >= ({min_percent} * (na + nb) + {99 + min_percent}) div {100 + min_percent}"
    return (small.join(large, "shingle").where(f"ca <> cb and nb >= na and 100 * na >= {min_percent} * nb and {enough}")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
