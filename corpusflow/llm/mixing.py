"""Mixing sources to target weights (native).

Targets come from capped water-filling: every source gets its weight's share of
the budget; a source whose share exceeds ``max_epochs`` times its size is
clamped there and the excess is shared among the others by weight, until none is
above. Each round is one aggregate over the per-source table that returns three
scalars. With every source clamped the budget is not reached, and the targets
are the caps.

Sampling: a source whose target is r times its size takes every document
floor(r) times, and the fractional rest once more for the documents that come
first in a seeded order, until their sizes fill the rest. The order is a hash of
the document, so reruns agree, and the fill point is found without sorting a
source in one task: sizes are summed in 2**BITS hash ranges per source, and
only the range that holds the fill point is ranked document by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import stage, words

#: hash ranges per source, as bits; the range that holds the fill point is cut into as many again, so that a huge
#: source ranks few documents at once
BITS = 10


def word_count(text: str | Column = "text") -> Column:
    return F.size(words(F.col(text) if isinstance(text, str) else text)).cast("long")


def cyclic_weights(sources: DataFrame, cycle: tuple[float, ...] = (1.0, 2.0, 3.0)) -> DataFrame:
    """``source, weight``: sources by code point, null last, weigh ``cycle``, repeating.

    One row per source is ordered here, never the documents.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), (rank % len(cycle) + 1).cast("int"))
    return sources.select("source").distinct().withColumn("weight", weight)


def water_fill(sources: DataFrame, budget: float, max_epochs: float = 3.0) -> DataFrame:
    """Add ``target`` to ``sources(source, source_size, weight)``; weights are positive.

    A null or non-positive weight counts as zero: such a source takes nothing.
    """
    weight = F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.0))
    cap = max_epochs * F.col("source_size").cast("double")
    level, clamped = 0.0, -1
    while True:
        full = (cap < level * weight) if clamped >= 0 else F.lit(False)
        taken, open_weight, n = sources.agg(
            F.sum(F.when(full, cap)), F.sum(F.when(~full, weight)), F.count_if(full)).first()
        if n == clamped:
            break
        clamped = n
        if not open_weight:
            break
        level = max(0.0, budget - (taken or 0.0)) / open_weight
    return sources.withColumn("target", F.least(cap, F.lit(level) * weight))


def mix(docs: DataFrame, size: Column, source: str = "source", doc_id: str = "doc_id", weights: DataFrame | None = None,
        max_epochs: float = 3.0, budget: float | None = None, seed: int = 17) -> DataFrame:
    """``docs`` columns ``doc_id, source`` with ``size, source_size, weight, target, repeats, taken``.

    ``weights(source, weight)`` defaults to ``cyclic_weights``; ``budget`` to the
    sum of all sizes. ``repeats`` is how often the mix takes the document,
    ``taken`` = repeats * size; the sum of a source's ``taken`` differs from its
    target by half of one document at most.

    A null source is a source of its own. Null sizes count as 0; documents of
    size 0 and sources of size 0 take nothing. Documents of equal doc_id and
    size have equal places; which of them comes first does not show in the
    result. Other columns are ignored; an empty table gives an empty result.
    """
    rows, _ = stage(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
        F.coalesce(size, F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(doc_id).cast("string")).alias("h")), "mix")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    weights = cyclic_weights(sizes) if weights is None else weights
    w = weights.select(F.col("source").alias("ws"), "weight")
    sources, _ = stage(sizes.join(w, F.col("source").eqNullSafe(F.col("ws")), "left").drop("ws"), "sources")
    if budget is None:
        budget = float(sources.agg(F.sum("source_size")).first()[0] or 0)
    sources, _ = stage(
        water_fill(sources, budget, max_epochs)
        .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .withColumn("whole", F.floor("rate")).withColumn("rest", (F.col("rate") - F.col("whole")) * F.col("source_size")),
        "targets")
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))

    # the hash range, and then the part of it, in which each source's rest is full
    coarse = F.shiftrightunsigned("h", 64 - BITS).cast("int")
    fine = F.shiftrightunsigned(F.shiftleft("h", BITS), 64 - BITS).cast("int")
    rows = rows.withColumn("coarse", coarse).withColumn("fine", fine)
    at = _fill(rows, "coarse", sources.select(F.col("source").alias("s"), F.col("rest").alias("left")))
    inside = rows.join(at, same("source", "s") & (F.col("coarse") == F.col("at")))
    at2 = _fill(inside.select("source", "size", "fine"), "fine", at.select("s", "left"))
    point = at.select(F.col("s").alias("ps"), F.col("at").alias("c")).join(
        at2.select("s", F.col("at").alias("f"), F.col("left").alias("last")), same("ps", "s"), "left").drop("s")
    point, _ = stage(point, "points")

    placed = (rows.join(sources.withColumnRenamed("source", "s"), same("source", "s"), "left").drop("s")
              .join(point, same("source", "ps"), "left").drop("ps"))
    # documents in the last part are ranked among themselves only: their windows hold 4**-BITS of a source
    edge = (F.col("coarse") == F.col("c")) & (F.col("fine") == F.col("f"))
    before = (F.col("coarse") < F.col("c")) | ((F.col("coarse") == F.col("c")) & (F.col("fine") < F.col("f")))
    filled = F.sum("size").over(Window.partitionBy("source").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0))
    ranked = placed.where(edge).withColumn("__more", (filled - F.col("size") / 2 <= F.col("last")).cast("long"))
    sure = placed.where(~F.coalesce(edge, F.lit(False))).withColumn("__more", F.coalesce(before, F.lit(False)).cast("long"))
    out = sure.unionByName(ranked)
    repeats = F.when(F.col("size") > 0, F.col("whole") + F.col("__more")).otherwise(0).cast("long")
    return (out.withColumn("repeats", repeats).withColumn("taken", F.col("repeats") * F.col("size"))
            .select("doc_id", "source", "size", "source_size", "weight", "target", "repeats", "taken"))


def _fill(rows: DataFrame, part: str, left: DataFrame) -> DataFrame:
    """``s, at, left``: the part in which a source's amount ``left(s, left)`` runs full, and what remains for it.

    Works on at most 2**BITS sums per source.
    """
    sums = rows.groupBy("source", part).agg(F.sum("size").alias("bytes"))
    w = Window.partitionBy("source").orderBy(part)
    run = sums.withColumn("upto", F.sum("bytes").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    run = run.join(left, F.col("source").eqNullSafe(F.col("s")))
    hit = run.where((F.col("upto") >= F.col("left")) & (F.col("upto") - F.col("bytes") < F.col("left")))
    return hit.select("s", F.col(part).alias("at"), (F.col("left") - F.col("upto") + F.col("bytes")).alias("left"))


def materialise(docs: DataFrame, mixed: DataFrame, doc_id: str = "doc_id", source: str = "source", size: Column | None = None) -> DataFrame:
    """The mix itself: each row of ``docs`` as many times as it is taken, with its columns.

    ``mixed`` is ``mix`` of ``docs`` with the same ``size`` (default: words). A row is
    known by doc_id, source and size. Rows equal in these are taken equally often,
    but for those at the point where their source runs full, some of which are taken
    once more; these are numbered, any order doing.
    """
    size = word_count() if size is None else size
    takes = (mixed.groupBy(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"))
             .agg(F.min("repeats").alias("__times"), F.sum(F.col("repeats")).alias("__sum"), F.count("*").alias("__rows"))
             .where("__sum > 0").withColumn("__more", F.col("__sum") - F.col("__times") * F.col("__rows")))
    same = (F.col(doc_id).eqNullSafe(F.col("__id")) & F.col(source).cast("string").eqNullSafe(F.col("__source"))
            & (F.coalesce(size, F.lit(0)).cast("long") == F.col("__size")))
    found = docs.join(takes, same)
    number = F.row_number().over(Window.partitionBy("__id", "__source", "__size").orderBy(F.lit(0)))
    partly = found.where("__more > 0").withColumn("__times", F.col("__times") + (number <= F.col("__more")).cast("long"))
    return (found.where("__more = 0").unionByName(partly)
            .where("__times > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__times")))).select(*docs.columns))
