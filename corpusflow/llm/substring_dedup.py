"""Substring dedup by relative Lempel-Ziv parsing.

A *window* is 35 consecutive words of one document. Every word covered by a
window that also starts anywhere else (same document included) is removed.

The reference is the corpus itself, as an index of window starts dealt over
blocks by hash (the shuffle partitions). Every start of a document is looked up in
its block, which takes the place of a search of the document in each block. The
index names two places of each repeated window, its first and its last by (class,
word); a start refers to those of them that are not itself. A document is then
factored greedily from left to right: a factor opens at the first start with a
reference and is extended word by word while the next start refers to the next word
of the same reference text. A factor has 35 words at least, and is a passage that
stands in its reference word for word. It is not always the longest there is, as a
start knows two places only; which words are covered does not depend on that.
A window that straddles two factors is looked up on its own start, so nothing is
missed where a parse switches its reference.

A window hash that makes up more than 1 / 2,048 of all starts to look up is *hot*.
There are fewer than 2,048 of these; their starts and their index rows are dealt
over 64 parts.

Only starts that can match are indexed. Each window has an anchor, the 8-word
run with the smallest hash among its 28; equal windows have equal anchors. An
anchor value found once in the whole corpus cannot lie in a repeated window, so
its windows are left out. Documents with equal word sequences are one class
with a count; a class of two or more is repeated throughout and only feeds the
index. Hashes are 64 bits for anchors (a false hit only adds a candidate) and
96 bits for windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import texthash as H
from corpusflow.llm.common import ensure_parallel, rows_repeat, stage, unstage, words

WINDOW, RUN = 35, 8
HOT, SALTS = 2048, 64
_EMPTY = hashlib.sha256(b"").digest()


def _slide(f, x: np.ndarray, width: int) -> np.ndarray:
    """``f`` (minimum or maximum) over every ``width`` consecutive values, by doubling."""
    k = 1
    while 2 * k <= width:
        x = f(x[:-k], x[k:])
        k *= 2
    rest = width - k
    return f(x[:len(x) - rest], x[rest:]) if rest else x


def _anchors(h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Run hashes, each window's smallest run hash, and which runs are the smallest of a window."""
    span = window - RUN + 1
    g = H.windows(h, RUN)
    least = _slide(np.minimum, g, span)
    pad = np.zeros(span - 1, np.uint64)
    return g, least, g == _slide(np.maximum, np.concatenate([pad, least, pad]), span)


def _profiles(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            count, lo, hi = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)
            anchors, again, sha = [None] * n, [None] * n, [_EMPTY] * n
            for row, h, raw, starts, ends in H.texts_with_bounds(batch.column("text")):
                if not len(h):
                    continue
                count[row] = len(h)
                lo[row], hi[row] = H.windows(h, len(h))[0], H.windows(h, len(h), 1)[0]
                sha[row] = hashlib.sha256(b" ".join(raw[starts[0]:ends[-1]].tobytes().split())).digest()
                if len(h) >= window:
                    g, _, smallest = _anchors(h, window)
                    value, times = np.unique(g[smallest], return_counts=True)
                    anchors[row], again[row] = H.signed(value), H.signed(value[times > 1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(count), pa.array(H.signed(lo)), pa.array(H.signed(hi)),
                 pa.array(sha, pa.binary()), pa.array(anchors, pa.list_(pa.int64())), pa.array(again, pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "n_words", "lo", "hi", "sha", "anchors", "again"])
    return run


def _starts(window: int):
    """Window starts of the candidate texts whose anchor value is repeated."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = np.uint64(0xFFFFFFFFFFFFFFFF)
        for batch in batches:
            cls, copies = batch.column("class").to_numpy(), batch.column("copies").to_numpy()
            values = batch.column("repeated")
            for row, h in H.texts(batch.column("text")):
                g, least, _ = _anchors(h, window)
                known = np.isin(g, np.array(values[row].values.to_numpy()).view(np.uint64))
                at = np.flatnonzero(_slide(np.minimum, np.where(known, g, top), window - RUN + 1) == least)
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), cls[row])), pa.array(np.full(len(at), copies[row])),
                         pa.array(at.astype(np.int32)), pa.array(H.signed(H.windows(h, window)[at])),
                         pa.array((H.windows(h, window, 1)[at] >> np.uint64(32)).astype(np.uint32).view(np.int32))],
                        names=["class", "copies", "start", "h1", "h2"])
    return run


def factors(starts: np.ndarray, references: np.ndarray, places: np.ndarray, own: int, window: int) -> list[tuple[int, int, int, int]]:
    """Greedy factors ``(first word, words, reference, first word there)`` of the document ``own``.

    ``starts`` are its matching starts (sorted); row i of ``references`` and
    ``places`` has the places where the window of start i stands, itself perhaps among them.
    """
    if not len(starts):
        return []
    shift = places - starts[:, None]
    cut = (np.diff(starts) != 1) | (np.diff(references, axis=0) != 0).any(axis=1) | (np.diff(shift, axis=0) != 0).any(axis=1)
    first = np.append(0, np.flatnonzero(cut) + 1)
    last = np.append(first[1:], len(starts)) - 1
    out, alive, begin, end = [], set(), 0, -1
    for a, b in zip(first, last):
        known = {(int(r), int(d)) for r, d in zip(references[a], shift[a]) if (r, d) != (own, 0)}
        on = alive & known if starts[a] == end + 1 else set()
        if not on:
            if alive:
                out.append((begin, end, *min(alive)))
            on, begin = known, int(starts[a])
        alive, end = on, int(starts[b])
    out.append((begin, end, *min(alive)))
    return [(a, b - a + window, r, a + d) for a, b, r, d in out]


def _parsed(window: int):
    """Factor each touched text; what is left of it, and its spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, out = batch.column("hits"), {k: [] for k in ("removed", "sha", "text", "spans")}
            for row, text in enumerate(batch.column("text").cast(pa.large_binary())):
                raw, offsets = H.text_buffer(pa.array([text.as_py()], pa.large_binary()))
                begin, end, _ = H.word_bounds(raw, offsets)
                found = hits[row].values
                order = np.argsort(found.field("start").to_numpy())
                at, r1, p1, r2, p2 = (found.field(f).to_numpy()[order].astype(np.int64) for f in ("start", "r1", "p1", "r2", "p2"))
                spans = factors(at, np.stack([r1, r2], 1), np.stack([p1, p2], 1), batch.column("class")[row].as_py(), window)
                gone = np.zeros(len(begin), bool)
                for a, n, *_ in spans:
                    gone[a:a + n] = True
                data, keep = raw.tobytes(), np.flatnonzero(~gone)
                out["removed"].append(int(gone.sum()))
                out["sha"].append(hashlib.sha256(b" ".join(data[begin[i]:end[i]] for i in keep)).digest())
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                pos, parts = 0, []
                for a, b in zip(edge[::2], edge[1::2]):
                    parts.append(data[pos:begin[a]])
                    pos = int(end[b - 1])
                out["text"].append(b"".join([*parts, data[pos:]]).decode("utf-8", "replace"))
                out["spans"].append([{"first": a, "words": n, "reference": r, "place": p} for a, n, r, p in spans])
            yield pa.RecordBatch.from_arrays(
                [batch.column("class"), pa.array(out["removed"], pa.int64()), pa.array(out["sha"], pa.binary()),
                 pa.array(out["text"], pa.string()),
                 pa.array(out["spans"], pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32()), ("reference", pa.int64()),
                                                       ("place", pa.int32())])))],
                names=["class", "n_removed", "sha", "text", "spans"])
    return run


def parse(docs: DataFrame, text: str | Column = "text", doc_id: str | Column = "doc_id",
          window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Profiles of all documents, and the touched classes.

    Profiles: ``doc_id, n_words, lo, hi, sha`` per row, (lo, hi) naming the word
    sequence. Touched: ``lo, hi, n_removed, sha, text, spans`` per word sequence
    that loses words; ``spans`` are its factors (first word, words, reference
    class, first word there). A sequence held by several rows loses everything: text
    is empty and spans is one factor over all words.
    """
    text, doc_id = (F.col(c) if isinstance(c, str) else c for c in (text, doc_id))
    rows = docs.select(doc_id.cast("long").alias("doc_id"), text.cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    wide, wide_path = stage(ensure_parallel(rows).mapInArrow(
        _profiles(window), "doc_id long, text_hash long, n_words long, lo long, hi long, sha binary, anchors array<long>, again array<long>"),
        "wide")
    profiles, _ = stage(wide.select("doc_id", "text_hash", "n_words", "lo", "hi", "sha"), "profiles")
    classes, _ = stage(
        wide.where(F.col("n_words") >= window).groupBy("lo", "hi")
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("rep"), F.count("*").alias("copies"), F.first("n_words").alias("n_words"),
             F.first("anchors").alias("anchors"), F.first("again").alias("again"))
        .withColumn("class", F.monotonically_increasing_id()), "classes")
    unstage(docs.sparkSession, wide_path)

    # anchor values in two classes or more; or twice in one that has no copy
    value = classes.select("class", F.explode("anchors").alias("value"))
    shared = value.groupBy("value").agg(F.min("class").alias("a"), F.max("class").alias("b")).where("a <> b").select("value")
    repeated = (value.join(shared, "value")
                .unionByName(classes.where("copies = 1").select("class", F.explode("again").alias("value")))
                .groupBy("class").agg(F.collect_set("value").alias("repeated")))
    wanted = classes.select("class", "rep", "lo", "hi", "copies").join(repeated, "class")
    # a class's text is found by row: two rows of one id and text hash are true copies
    held = (rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("rep.doc_id")) & (F.col("text_hash") == F.col("rep.text_hash")))
            .select("class", "copies", "lo", "hi", "repeated", "text"))
    own = held.mapInArrow(_own_text, held.schema)
    held, held_path = stage(own.dropDuplicates(["class"]) if rows_repeat(profiles, "doc_id", "text_hash") else own, "candidates")

    # computed anew for each of its two uses: hashing is cheaper than keeping a row for every start
    starts = held.mapInArrow(_starts(window), "class long, copies long, start int, h1 long, h2 int")
    place = F.struct(F.col("class").alias("reference"), F.col("start").alias("place"))
    index, index_path = stage(
        starts.groupBy("h1", "h2").agg(F.sum("copies").alias("times"), F.count_if(F.col("copies") == 1).alias("asked"),
                                       F.min(place).alias("low"), F.max(place).alias("high"))
        .where("times > 1 and asked > 0").drop("times"), "windows")
    hits = (_lookup(starts.where("copies = 1").drop("copies"), index)
            .groupBy("class").agg(F.collect_list(F.struct(
                "start", F.col("low.reference").alias("r1"), F.col("low.place").alias("p1"),
                F.col("high.reference").alias("r2"), F.col("high.place").alias("p2"))).alias("hits")))
    parsed, _ = stage(held.select("class", "text").join(hits, "class").mapInArrow(
        _parsed(window), "class long, n_removed long, sha binary, text string, "
        "spans array<struct<first:int,words:int,reference:long,place:int>>"), "parsed")
    unstage(docs.sparkSession, held_path, index_path)
    key = classes.select("class", "lo", "hi")
    whole = classes.where("copies > 1").select(
        "lo", "hi", F.col("n_words").alias("n_removed"), F.unhex(F.lit(_EMPTY.hex())).alias("sha"), F.lit("").alias("text"),
        F.array(F.struct(F.lit(0).alias("first"), F.col("n_words").cast("int").alias("words"),
                         F.col("class").alias("reference"), F.lit(0).alias("place"))).alias("spans"))
    touched = parsed.join(key, "class").select("lo", "hi", "n_removed", "sha", "text", "spans").union(whole)
    return profiles, touched


def _lookup(starts: DataFrame, index: DataFrame) -> DataFrame:
    """``class, start, low, high``: the starts whose window the index knows, and its places there.

    ``index`` has the starts that ask for each hash (``asked``). Hot hashes are
    fewer than ``HOT`` by their share, so they are broadcast, as marks of the starts to salt.
    """
    total = index.agg(F.sum("asked")).first()[0] or 0
    hot = F.col("asked") * HOT > total
    salts = F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    marks = F.broadcast(index.where(hot).select("h1", "h2", F.lit(True).alias("hot")))
    salted = starts.join(marks, ["h1", "h2"], "left").withColumn(
        "salt", F.when(F.col("hot"), F.pmod(F.hash("class", "start"), F.lit(SALTS))).otherwise(0)).drop("hot")
    return salted.join(index.select("h1", "h2", "low", "high", F.explode(salts).alias("salt")), ["h1", "h2", "salt"]).select(
        "class", "start", "low", "high")


def _own_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose text is their class's (texts of one hash may differ)."""
    for batch in batches:
        lo, hi = (batch.column(c).to_numpy().view(np.uint64) for c in ("lo", "hi"))
        keep = [row for row, h in H.texts(batch.column("text"))
                if len(h) and H.windows(h, len(h))[0] == lo[row] and H.windows(h, len(h), 1)[0] == hi[row]]
        yield batch.take(pa.array(keep, pa.int64()))


def removal_report(docs: DataFrame, text: str | Column = "text", doc_id: str | Column = "doc_id",
                   window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` per row.

    Null, empty and blank texts and texts shorter than a window lose nothing;
    repeated rows are occurrences of each other. Null doc_ids take part. Other
    columns are ignored; an empty table gives an empty result.
    """
    profiles, touched = parse(docs, text, doc_id, window)
    t = touched.select("lo", "hi", "n_removed", F.col("sha").alias("kept"))
    return profiles.join(t, ["lo", "hi"], "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.lower(F.hex(F.coalesce("kept", "sha"))).alias("kept_sha256"))


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with repeated passages cut from ``text`` (``n_chars`` follows, if there).

    The bytes around a cut stay as they are; untouched texts are unchanged, and a
    text that loses every word keeps its row with an empty text. Rows are told
    apart by their words, not by doc_id, so null and repeated ids are harmless.
    """
    profiles, touched = parse(docs, window=window)
    sha = profiles.where(F.col("n_words") >= window).groupBy("lo", "hi").agg(F.first("sha").alias("__sha"))
    cut = touched.select("lo", "hi", F.col("text").alias("__cut")).join(sha, ["lo", "hi"]).select("__sha", "__cut")
    own = F.unhex(F.sha2(F.array_join(words(F.col("text")), " ").cast("binary"), 256))
    out = docs.withColumn("__own", own).join(cut, F.col("__own") == F.col("__sha"), "left")
    cols = {c: F.col(c) for c in docs.columns}
    cols["text"] = F.coalesce("__cut", "text").alias("text")
    if "n_chars" in cols:
        cols["n_chars"] = (F.when(F.col("__cut").isNotNull(), F.char_length("__cut")).otherwise(F.col("n_chars"))
                           .cast(docs.schema["n_chars"].dataType).alias("n_chars"))
    return out.select(*cols.values())
