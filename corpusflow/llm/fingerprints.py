"""Document fingerprints by invertible Bloom lookup sketches (native).

A paragraph is a line, cut after every ``cut`` characters, where ``cut`` is a power of two
that follows from the text's length: 16 cuts or fewer make a text, whatever its length,
and more than 8 above 32 characters. A document is the set of its paragraphs' 64-bit
digests. Two versions are compared at the coarser of their cuts; a piece of a coarser
cut is two of the finer, so what they share they share at both.

A sketch has three sub-tables of cells; a digest falls into one cell of each, which
counts it and keeps the XOR of its digests and of their check values. Sketches subtract
cell by cell, and what two versions share cancels. Peeling recovers the rest: a cell
whose count is 1 or -1 and whose check fits holds one digest, which is taken out of its
other cells. Sub-tables are peeled in turn, so no digest is taken out twice in a round.
Sketches of ``CELLS`` cells, as the fingerprints have, are compared first; pairs that
differ in more than those can tell are sketched again with four times the cells, until
all decode.

Texts are shuffled once, to bring each beside the next; digests are few, so they are
staged, and everything after is rows of (pair, cell) that stay in their partition.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import stage, text_or_empty, unstage
from corpusflow.llm.ranges import MAX_RANGES, range_of, splitters

CELLS, GROWTH, ROUNDS, PIECES, LEAST_CUT = 48, 4, 12, 16, 2
BYTES_PER_RANGE = 1 << 20


def cut_of(text: Column) -> Column:
    """The cut of a text: the smallest power of two of which ``PIECES`` cover its characters, ``LEAST_CUT`` at least."""
    over = F.floor((F.length(text) - 1) / PIECES)
    bits = F.when(over > 0, F.length(F.bin(over))).otherwise(0)
    return F.greatest(F.lit(LEAST_CUT), F.pow(F.lit(2.0), bits).cast("int"))


def digests(text: Column, cut: Column) -> Column:
    """Distinct digests of a text's paragraphs."""
    pieces = F.regexp_extract_all(text, F.concat(F.lit("[^\\n]{1,"), cut.cast("string"), F.lit("}")), F.lit(0))
    return F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(p)))


def check(digest: Column | str) -> Column:
    return F.xxhash64(F.lit(99), digest)


def cell(digest: Column | str, table: int, third: Column) -> Column:
    """The digest's cell in sub-table 0, 1 or 2 of a sketch of ``third`` cells a sub-table."""
    return F.pmod(F.xxhash64(F.lit(table), digest), third) + table * third


def _entries(rows: DataFrame, third: Column, *keep: str) -> DataFrame:
    """``rows(..., digest, n)`` with one row for each of the digest's three cells."""
    spots = F.array(*[cell("digest", t, third) for t in range(3)])
    return rows.select(*keep, "n", "digest", check("digest").alias("chk"), F.explode(spots).alias("cell"))


def sketch(rows: DataFrame, keys: list[str], digest_array: str, cells: int = CELLS) -> DataFrame:
    """``*keys, fingerprint``: the sketch of each row's digests as text, cell by cell count, XOR and check (hex)."""
    one = rows.select(*keys, F.explode(digest_array).alias("digest"), F.lit(1).alias("n"))
    filled = _entries(one, F.lit(cells // 3), *keys).groupBy(*keys, "cell").agg(
        F.sum("n").alias("n"), F.bit_xor("digest").alias("x"), F.bit_xor("chk").alias("c"))
    text = F.format_string("%d:%x:%x:%s", "cell", "n", "x", F.substring(F.lpad(F.hex("c"), 16, "0"), 9, 8))
    return (filled.select(*keys, F.struct("cell", text.alias("t")).alias("s")).groupBy(*keys)
            .agg(F.concat_ws(",", F.transform(F.array_sort(F.collect_list("s")), lambda s: s["t"])).alias("fingerprint")))


def difference(pairs: DataFrame, growth: int = 1, part: str = "row") -> DataFrame:
    """Recovered digests of ``pairs(row, a, b)``, arrays of distinct digests.

    Rows ``row, cell, n, digest``: a recovered digest has cell -1, and n is 1 if
    only ``a`` has it, -1 if only ``b``. Rows with a cell from 0 are what could
    not be peeled; a pair that has one isn't decoded. The sketches have ``growth``
    times ``CELLS`` cells. Nothing is shuffled if ``pairs`` is partitioned by its
    column ``part``.
    """
    sides = F.array(F.struct(F.lit(1).alias("n"), F.col("a").alias("d")), F.struct(F.lit(-1).alias("n"), F.col("b").alias("d")))
    keys, third = list(dict.fromkeys([part, "row"])), CELLS // 3 * growth
    one = pairs.select(*keys, F.explode(sides).alias("s")).select(*keys, F.col("s.n").alias("n"), F.explode("s.d").alias("digest"))
    state = _merge(_entries(one, F.lit(third), *keys), keys)
    for r in range(ROUNDS):
        t = r % 3
        pure = (F.col("cell").between(third * t, third * (t + 1) - 1) & (F.abs("n") == 1) & (F.col("chk") == check("digest")))
        same = F.struct("cell", "n")
        found = F.struct((-F.col("cell") - 1 - third * 3 * r).alias("cell"), F.col("n").alias("n"))
        out = [F.struct(cell("digest", u, F.lit(third)).alias("cell"), (-F.col("n")).alias("n")) for u in range(3) if u != t]
        state = _merge(state.select(*keys, "digest", "chk", F.explode(F.when(pure, F.array(found, *out)).otherwise(F.array(same))).alias("e"))
                       .select(*keys, F.col("e.n").alias("n"), "digest", "chk", F.col("e.cell").alias("cell")), keys)
    return state.select(*keys, F.greatest("cell", F.lit(-1)).alias("cell"), "n", "digest")


def _merge(entries: DataFrame, keys: list[str]) -> DataFrame:
    """Sum up the entries of each cell; cells that cancelled are left out."""
    state = entries.groupBy(*keys, "cell").agg(
        F.sum("n").alias("n"), F.bit_xor("digest").alias("digest"), F.bit_xor("chk").alias("chk"))
    return state.where((F.col("n") != 0) | (F.col("digest") != 0))


def differing(pairs: DataFrame, part: str = "row") -> DataFrame:
    """``row, only_a, only_b`` of ``pairs(row, a, b)``: how many digests either side has alone.

    Pairs that did not decode are sketched again with ``GROWTH`` times the cells,
    until all have. ``pairs`` must give the same rows each time.
    """
    todo, growth, done = pairs, 1, None
    while True:
        peeled = difference(todo, growth, part).groupBy(*dict.fromkeys([part, "row"])).agg(
            F.sum(F.when(F.col("cell") < 0, (F.col("n") == 1).cast("long")).otherwise(0)).alias("only_a"),
            F.sum(F.when(F.col("cell") < 0, (F.col("n") == -1).cast("long")).otherwise(0)).alias("only_b"),
            F.max((F.col("cell") >= 0).cast("int")).alias("stuck"))
        level, _ = stage(peeled, "peeled")
        good = level.where("stuck = 0").select("row", "only_a", "only_b")
        done = good if done is None else done.union(good)
        stuck = level.where("stuck = 1").select("row")
        if not stuck.limit(1).count():
            return done
        # dealt out by part once, so that no round of the next peeling is shuffled
        todo = stage(todo.join(stuck, "row", "left_semi"), "retry")[0].repartition(part)
        growth *= GROWTH


def with_next(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``row, range, doc_id, text, next_text``: each document beside the next by ascending doc_id.

    After the last comes the first. Documents are cut into doc_id ranges of
    about ``BYTES_PER_RANGE`` by a size-weighted sample; the first document of a
    range also goes to the range before it, so one shuffle is enough. The result
    is partitioned by ``range``, about two ranges a task. Null
    doc_ids come last; equal ones are ordered by their text's hash.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(F.col(text)).alias("text"))
    narrow, narrow_path = stage(rows.select("doc_id", (F.octet_length("text") + 64).alias("size")), "sizes")
    total, low = narrow.agg(F.sum("size"), F.min("doc_id")).first()
    n = min(MAX_RANGES, max(rows.sparkSession.sparkContext.defaultParallelism, ceil((total or 0) / BYTES_PER_RANGE)))
    bounds = [b for b in splitters(narrow, "doc_id", "size", n, float(total or 0)) if b > low]
    unstage(docs.sparkSession, narrow_path)
    last, own = len(bounds), range_of(F.col("doc_id"), bounds)
    spot = lambda r, guest: F.struct(r.cast("int").alias("range"), F.lit(guest).alias("guest"))
    spots = [spot(own, 0)]
    if bounds:  # the first of a range is also the guest of the range before
        starts = F.array_contains(F.lit(bounds), F.col("doc_id")) if last <= 64 else _is_bound(F.col("doc_id"), bounds)
        spots.append(F.when(starts, spot(own - 1, 0 + 1)))
    spots.append(F.when(F.col("doc_id").eqNullSafe(F.lit(low)), spot(F.lit(last), 2)))
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, (last + 2) // 2)
    dealt = (rows.select("doc_id", "text", F.explode(F.array_compact(F.array(*spots))).alias("s"))
             .select("s.range", "s.guest", "doc_id", "text").repartition(tasks, "range"))
    w = Window.partitionBy("range").orderBy("guest", F.asc_nulls_last("doc_id"), F.xxhash64("text"))
    return (dealt.select(
        "*", F.row_number().over(w).alias("rn"), F.lead("text").over(w).alias("next_text")).where("guest = 0")
        .withColumn("row", F.col("range").cast("long") * (1 << 40) + F.col("rn")))


def _is_bound(key: Column, bounds: list[int]) -> Column:
    """Whether ``key`` is a boundary: the boundary at the end of its range's list equals it."""
    at = range_of(key, bounds)
    return (at > 0) & F.element_at(F.lit(bounds), F.greatest(at, F.lit(1))).eqNullSafe(key)


def likeness(a: Column, b: Column, only_a: Column, only_b: Column) -> Column:
    """Shared over all digests of two sets of sizes ``a`` and ``b``; 1 for two empty sets."""
    apart = only_a + only_b
    shared = (a + b - apart) / 2
    return F.when(shared + apart == 0, 1.0).otherwise(shared / (shared + apart))


def edited_likeness(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how alike they are.

    The edited text replaces the last floor(n_chars / 2) code points by as many
    of the next document's first (or all it has). Columns: ``doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    A null text is empty: its fingerprint is the empty string, and two empty
    documents have likeness 1. A single document is its own next. Repeated rows
    are neighbours; null doc_ids come last. Other columns are ignored; an empty
    table gives an empty result.
    """
    beside = with_next(docs, text, doc_id)
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.expr("left(text, length(text) - CAST(floor(length(text) / 2) AS INT))"),
                      F.substring("next_text", F.lit(1), half))
    beside = beside.withColumn("edited", edited)
    cuts = [cut_of(F.col(c)) for c in ("text", "edited", "next_text")]
    beside = beside.select("*", *[c.alias(f"cut{i}") for i, c in enumerate(cuts)])
    with_edited, with_next_ = F.greatest("cut0", "cut1"), F.greatest("cut0", "cut2")
    finer = lambda text, own, cut: F.when(cut > F.col(own), digests(F.col(text), cut))
    wide, _ = stage(beside.select(
        "range", "row", "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        digests(F.col("text"), F.col("cut0")).alias("own"), digests(F.col("edited"), F.col("cut1")).alias("edit"),
        # the sets of the two comparisons, where their cut is not the text's own
        finer("text", "cut0", with_edited).alias("a0"), finer("edited", "cut1", with_edited).alias("b0"),
        finer("text", "cut0", with_next_).alias("a1"), digests(F.col("next_text"), with_next_).alias("b1")), "versions")
    spark = docs.sparkSession
    tasks = max(wide.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    dealt = wide.select(F.col("row").alias("doc"), "own", "edit", "a0", "b0", "a1", "b1").repartition(tasks, "doc")
    sets = [F.coalesce("a0", "own"), F.coalesce("b0", "edit"), F.coalesce("a1", "own"), F.col("b1")]
    versions = lambda *of: F.explode(F.array(*[F.struct(F.lit(i).alias("v"), *cols) for i, cols in enumerate(of)]))
    numbered = (F.col("doc") * 2 + F.col("x.v")).alias("row")
    # pair 0 compares a document and its edited text, pair 1 a document and the next
    pairs = (dealt.select("doc", versions([sets[0].alias("a"), sets[1].alias("b")], [sets[2].alias("a"), sets[3].alias("b")]).alias("x"))
             .select("doc", numbered, "x.a", "x.b"))
    apart = differing(pairs, "doc")
    of_pair = lambda i: apart.where(F.col("row") % 2 == i).select(
        F.floor(F.col("row") / 2).alias("row"), F.col("only_a").alias(f"a{i}"), F.col("only_b").alias(f"b{i}"))
    gap = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    near, _ = stage(
        wide.select("row", "doc_id", "n_chars", "edited_sha256", *[F.size(c).alias(f"n{i}") for i, c in enumerate(sets)])
        .join(of_pair(0), "row", "left").join(of_pair(1), "row", "left")
        .select(F.col("row").alias("doc"), "doc_id", "n_chars", "edited_sha256",
                likeness(F.col("n0"), F.col("n1"), gap("a0"), gap("b0")).alias("near_edited"),
                likeness(F.col("n2"), F.col("n3"), gap("a1"), gap("b1")).alias("near_next")), "near")
    # the fingerprints are long: they are made last, where their digests lie, and neither staged nor shuffled
    both = dealt.select("doc", versions([F.col("own").alias("d")], [F.col("edit").alias("d")]).alias("x")).select("doc", numbered, "x.d")
    of = lambda i, name: F.max(F.when(F.col("row") % 2 == i, F.col("fingerprint"))).alias(name)
    prints = sketch(both, ["doc", "row"], "d").groupBy("doc").agg(of(0, "fingerprint"), of(1, "edited_fingerprint"))
    return near.join(prints, "doc", "left").select(
        "doc_id", "n_chars", "edited_sha256", F.coalesce("fingerprint", F.lit("")).alias("fingerprint"),
        F.coalesce("edited_fingerprint", F.lit("")).alias("edited_fingerprint"), "near_edited", "near_next")
