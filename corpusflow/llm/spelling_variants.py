"""Spelling variants of words, found by PartEnum signatures.

A word's letters are a multiset, written as a binary vector: dimension (letter, k) is
set if the letter stands in the word k times or more. Words that differ by one
inserted or deleted letter have vectors at Hamming distance one, their lengths one
apart. Words of equal length that differ by one replaced letter have vectors at
distance two at most; as the replaced letter keeps its place, that also holds if the
letters of a word's two halves count as different letters, and so they do there.

The dimensions are cut into parts by a hash. Two vectors at distance k agree on all
but k parts at least, so each choice of all but k parts gives a signature, the hash of
the vector on these parts, and two such words share one exactly. Words of equal length
are signed for k = 2, words whose lengths differ by one for k = 1. An equi-join on
signatures finds every near pair; pairs are tested as they are formed, by the distance
of their folded vectors and then letter by letter, so only near pairs leave the join.

Every join here merges sorted rows and broadcasts neither side. Spark goes by the size of
the staged files: a word there takes a few bytes, but it has 23 signatures, and rows in
memory are wider than compressed ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import ensure_parallel, stage, text_or_empty, unstage

MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
#: parts of the dimensions for words of equal length (all but two are signed) and of lengths one apart (all but one)
SAME_PARTS, APART_PARTS = 6, 4
#: how all joins are done: no table of words is small for good
JOIN = "merge"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Every 199th (document, run) pair, by CRC-32, loses a code point (a fixed value of the stated edit).
EDIT_EVERY = 199


def planted_edit(doc_id: Column, run: Column) -> Column:
    """The run, without one code point where the CRC-32 of ``<doc_id>:<run>`` says so; unchanged for a null doc_id."""
    h = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.length(run).cast("long")).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % EDIT_EVERY == 0, cut).otherwise(run)


def count_words(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", edit=None,
                min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of the letter runs of all texts with ``min_length`` code points and ``min_count`` occurrences at least.

    Letters are A-Z, a-z and U+00C0 to U+00FF; only A-Z are lower-cased. A null text
    has no runs. ``edit(doc_id, run)`` may change each run before it is counted; it
    must not make a run longer.
    """
    lowered = F.translate(text_or_empty(F.col(text)), _UPPER, _LOWER)
    long_runs = F.regexp_extract_all(lowered, F.lit("[a-zÀ-ÿ]{%d,}" % min_length), F.lit(0))
    rows = ensure_parallel(docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(F.col(text)).alias(text)))
    found = rows.select("doc_id", F.explode(long_runs).alias("run"))
    word = edit(F.col("doc_id"), F.col("run")) if edit else F.col("run")
    return (found.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
            .where((F.col("n") >= min_count) & (F.length("word") >= min_length)))


@lru_cache(1 << 16)
def _dimension(letter: str, k: int, parts: int) -> tuple[int, int, bytes]:
    """A dimension's part, its bit in the folded vector, and its name."""
    name = f"{letter}{k} ".encode()
    h = int.from_bytes(blake2b(name, digest_size=8).digest(), "little")
    return h % parts, 1 << (h >> 58), name


def _vector(letters: list[str], parts: int) -> tuple[int, list[bytes]]:
    """The multiset's vector folded to 64 bits (signed), and its dimensions by part."""
    mask, cut, seen = 0, [b""] * parts, {}
    for c in sorted(letters):
        seen[c] = seen.get(c, 0) + 1
        part, bit, name = _dimension(c, seen[c], parts)
        cut[part] += name
        mask ^= bit
    return mask - (1 << 64) if mask >> 63 else mask, cut


def _hash(kind: bytes, length: int, chosen: tuple[int, ...], cut: list[bytes]) -> int:
    key = kind + b"%d " % length + b"|".join(b"%d:" % i + cut[i] for i in chosen)
    return int.from_bytes(blake2b(key, digest_size=8).digest(), "little", signed=True)


def signatures(word: str) -> list[tuple[int, int, int]]:
    """``(role, folded vector, signature)``: role 0 meets role 0 (equal lengths), and role 1, the longer word, meets role 2."""
    n = len(word)
    mask, cut = _vector([("0" if i < n // 2 else "1") + c for i, c in enumerate(word)], SAME_PARTS)
    out = [(0, mask, _hash(b"s", n, chosen, cut)) for chosen in combinations(range(SAME_PARTS), SAME_PARTS - 2)]
    mask, cut = _vector(list(word), APART_PARTS)
    for chosen in combinations(range(APART_PARTS), APART_PARTS - 1):
        out += [(1, mask, _hash(b"a", n, chosen, cut)), (2, mask, _hash(b"a", n + 1, chosen, cut))]
    return out


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        index, found = [], []
        for i, word in enumerate(batch.column("word").to_pylist()):
            signed = signatures(word)
            index += [i] * len(signed)
            found += signed
        index, (roles, masks, signs) = pa.array(index, pa.int64()), zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("word").take(index), batch.column("n").take(index), pa.array(masks, pa.int64()), pa.array(roles, pa.int32()),
             pa.array(signs, pa.int64())], names=["word", "n", "mask", "role", "signature"])


def near_pairs(counts: DataFrame) -> DataFrame:
    """``a, na, b, nb``: the pairs of words of ``counts(word, n)`` that one inserted, deleted or replaced code point sets apart, once each."""
    signed = counts.select("word", "n").mapInArrow(_signed, "word string, n long, mask long, role int, signature long")
    a, b = signed.alias("a"), signed.alias("b")
    distance = F.bit_count(F.col("a.mask").bitwiseXOR(F.col("b.mask")))
    meet = ((F.col("a.role") == 0) & (F.col("b.role") == 0) & (distance <= 2)
            | (F.col("a.role") == 1) & (F.col("b.role") == 2) & (distance <= 1))
    # only a pair whose vectors are near is compared letter by letter
    ordered = (F.col("a.role") == 1) | (F.col("a.word") < F.col("b.word"))
    near = F.when(meet, ordered & (F.levenshtein("a.word", "b.word", 1) == 1)).otherwise(False)
    pairs = a.join(b.hint(JOIN), (F.col("a.signature") == F.col("b.signature")) & near)
    return pairs.select(F.col("a.word").alias("a"), F.col("a.n").alias("na"), F.col("b.word").alias("b"), F.col("b.n").alias("nb")).distinct()


def variant_groups(counts: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of ``counts(word, n)``.

    ``n_near`` counts the near words. ``form`` is the near word of largest n (ties:
    the first in code-point order) if that is ``ratio`` times the word's n or more, else
    null; ``form_n`` is its n. ``root`` follows forms to the last; a word without a
    form is its own. With a ratio above 1, n grows along the forms, so there are no circles.

    Words must be distinct and not null; rows with a null word or n are left out. An
    empty table gives an empty result; other columns are ignored.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 at least")
    spark = counts.sparkSession
    words, words_path = stage(counts.where("word is not null and n is not null").select("word", F.col("n").cast("long").alias("n")), "words")
    near, near_path = stage(near_pairs(words), "near")
    # arrays of the two directions, so that the pairs are read once
    ways = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("m")),
                             F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("na").alias("m"))))
    best = (near.select(ways.alias("w")).select("w.*").groupBy("word")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best")))
    enough = -F.col("best.m") >= ratio * F.col("n")
    formed, _ = stage(words.join(best.hint(JOIN), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.m")).alias("form_n")), "formed")
    unstage(spark, words_path, near_path)
    roots = _roots(formed.where("form is not null").select("word", "form"))
    return formed.join(roots.hint(JOIN), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(links: DataFrame) -> DataFrame:
    """``word, root`` of ``links(word, form)``: each round replaces the word reached by the word reached from there."""
    spark = links.sparkSession
    reached, path = stage(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        hop = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now, now_path = stage(reached.join(hop.hint(JOIN), "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                                  F.col("next").isNotNull().alias("moved")), "roots")
        moved = now.where("moved").limit(1).count()
        unstage(spark, path)
        reached, path = now.drop("moved"), now_path
        if not moved:
            return reached


def spelling_variants(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", edit=None) -> DataFrame:
    """``variant_groups`` of the words of all texts.

    A null or empty text has no words; repeated rows count again; a null doc_id
    only matters to ``edit``; other columns are ignored; an empty table gives an empty result.
    """
    return variant_groups(count_words(docs, text, doc_id, edit))
