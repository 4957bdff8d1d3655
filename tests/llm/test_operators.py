"""Each operator against a brute-force version, and on empty, null, repeated and odd input."""

import hashlib
import pathlib
import re
import subprocess
import sys
import textwrap
import zlib
from collections import Counter, defaultdict
from math import ceil

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import (
    common,
    fingerprints,
    license_scan,
    mixing,
    near_dedup,
    packing,
    quality_classifier,
    quality_rules,
    sharding,
    substring_dedup,
    texthash,
    token_counts,
    tokens,
)

SF_SMALL = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i}" for i in range(400))
ODD = [
    (1, "the quick brown fox jumps over the lazy dog and runs away"), (2, None), (3, ""), (4, " \t\n "), (5, "one two"), (6, "one two"),
    (6, "one two"), (None, "a null id with a text of its own, long enough for a rule"), (None, None), (7, LONG), (8, LONG + " tail"),
    (9, "x " * 300), (10, "日本語 текст   é"), (11, "line\nline\nline\nother line", None), (12, "1 2 3 4 5", None), (13, LONG + LONG)]


@pytest.fixture(scope="module")
def make(spark):
    """A documents table from (doc_id, text[, source]) rows, with an extra column of a clashing name."""
    def build(rows, extra=True):
        rows = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        return df.selectExpr("*", "1 as size", "'x' as class", "2.0 as score") if extra else df
    return build


@pytest.fixture(scope="module")
def docs(spark):
    df = common.documents(spark, SF_SMALL)
    return df, {r.doc_id: r for r in df.collect()}


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def byte_words(text):
    return (text or "").encode().split()


# --- hashes and tokens


def test_word_hashes_agree_with_words():
    texts = ["", None, " a  b\tc", "Ab aB", "é\xa0ü b\x0bc", "x" * 3000 + " y"]
    seen = {}
    for row, h, raw, s, e in texthash.texts_with_bounds(pa.array(texts), True, limit=5):
        found = [bytes(raw[a:b]).lower() for a, b in zip(s, e)]
        assert found == [w.lower() for w in byte_words(texts[row])]
        for w, x in zip(found, h):
            assert seen.setdefault(w, x) == x
    assert len(set(map(int, seen.values()))) == len(seen)


def test_token_ids_equal_the_library(docs):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(tokens.default_path())
    whole.encode_special_tokens = True
    own = tokens.encoder(tokens.default_path())
    parts = [" ", "  ", "a", "'s", "\n", "\t", "\xa0", "é", "1", "!", "<|endoftext|>", "日", "\x00", " the", "²", "."]
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(parts, 9)) for _ in range(2000)] + [r.text for r in docs[1].values() if r.text][:60]
    for t, want in zip(texts, whole.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(own.ids(t), "<u4").tolist() == want.ids


def test_added_tokens_as_the_library_by_default(make):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(tokens.default_path())
    own = tokens.encoder(tokens.default_path())
    assert np.frombuffer(own.with_added("a <|endoftext|> b"), "<u4").tolist() == [64, 220, 50256, 275]
    parts = [" ", "  ", "a", "'s", "\n", "1", "<|endoftext|>", "<|endoftext|>", "<|endof", "|>", "<", " the", "\xa0", "é"]
    rng = np.random.default_rng(3)
    texts = ["", "<|endoftext|>", *("".join(rng.choice(parts, 9)) for _ in range(2000)), "<|endoftext|> b" * 700]
    want = [w.ids for w in whole.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(own.with_added(t), "<u4").tolist() for t in texts] == want
    some = [*range(40), len(texts) - 1]
    pieces = defaultdict(list)
    for r in packing.packed_documents(make([(i, texts[i]) for i in some])).collect():
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32))
    for i in some:
        ids, at = np.array([*want[i], 2], "<u4"), 0
        for start, length, crc in sorted(pieces[i]):
            assert start == at and crc == zlib.crc32(ids[start:start + length].tobytes())
            at += length
        assert at == len(ids)


# --- op 1


def test_mixing_targets_and_takes(spark, docs):
    got = rows_of(mixing.mix(docs[0], mixing.word_count()))
    size = Counter()
    for r in docs[1].values():
        size[r.source] += len(byte_words(r.text))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    full, total = set(), sum(size.values())
    while True:
        level = (total - sum(3 * size[s] for s in full)) / sum(weight[s] for s in order if s not in full)
        more = {s for s in order if s not in full and level * weight[s] > 3 * size[s]}
        if not more:
            break
        full |= more
    target = {s: 3 * size[s] if s in full else level * weight[s] for s in order}
    taken, largest = Counter(), Counter()
    for r in got:
        assert r["size"] == len(byte_words(docs[1][r["doc_id"]].text)) and r["taken"] <= 3 * r["size"]
        assert r["target"] == pytest.approx(target[r["source"]])
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in order:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6
    again = rows_of(mixing.mix(docs[0].repartition(5), mixing.word_count()))
    assert sorted((r["doc_id"], r["taken"]) for r in got) == sorted((r["doc_id"], r["taken"]) for r in again)


def test_mixing_odd_rows(make):
    got = rows_of(mixing.mix(make(ODD), mixing.word_count()))
    assert len(got) == len(ODD)
    assert all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert rows_of(mixing.mix(make(ODD).limit(0), mixing.word_count())) == []


def test_water_fill_clamps(spark):
    df = spark.createDataFrame([("a", 10, 1.0), ("b", 100, 1.0), ("c", 1000, 2.0), ("d", 5, None)], "source string, source_size long, weight double")
    got = {r.source: r.target for r in mixing.water_fill(df, 1115.0).collect()}
    assert got["a"] == 30 and got["d"] == 0 and got["b"] == 300 and got["c"] == pytest.approx(785)


# --- op 2


def test_classifier_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = common.documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality_classifier.classify(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)


def test_classifier_odd_rows(spark, make):
    labels = spark.createDataFrame([(1, 1), (5, 0), (7, None), (99, 1)], "doc_id long, quality int")
    got = rows_of(quality_classifier.classify(make(ODD), labels))
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    none = rows_of(quality_classifier.classify(make(ODD), labels.limit(0)))
    assert {r["score"] for r in none} == {0.5}
    assert rows_of(quality_classifier.classify(make(ODD).limit(0), labels)) == []


def test_isotonic_is_monotone():
    s, y = np.arange(50.0), np.random.default_rng(0).random(50)
    knots, values = quality_classifier.isotonic(s, y, np.ones(50))
    assert (np.diff(values) > 0).all() and (np.diff(knots) > 0).all()


# --- op 3


def test_license_rules():
    s = license_scan.Scanner()
    mit = "\n".join(license_scan.SENTENCES[i] for i in ("mit-grant", "mit-notice", "as-is"))
    wrapped = re.sub(r"((?:\S+ ){8})", r"\1\n", mit)
    assert s.licenses(s.sentences("Intro.\n" + mit)) == ["MIT"]
    assert s.licenses(s.sentences(license_scan.SENTENCES["cc-by-nc-4"] + "\nword | other")) == ["CC-BY-NC-4.0"]
    assert s.licenses(s.sentences("Released under the MIT License. Licensed under the Apache License, Version 2.0.")) == ["MIT", "Apache-2.0"]
    assert s.sentences("the word license alone is none.") == []
    assert "mit-notice" in s.sentences(wrapped)
    assert all(re.search(license_scan.TRIGGERS, x) for x in license_scan.SENTENCES.values())


def test_license_scan_against_lines(docs, make):
    got = {r["doc_id"]: r["license"] for r in rows_of(license_scan.scan(docs[0]))}
    line = {"Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
            "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "All rights reserved.": "all-rights-reserved",
            "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}
    for i, r in docs[1].items():
        want = {name for s, name in line.items() if s in (r.text or "")}
        assert got[i] == (" AND ".join(sorted(want)) or None)
    assert len(rows_of(license_scan.scan(make(ODD)))) == len(ODD)
    assert rows_of(license_scan.scan(make(ODD).limit(0))) == []


# --- op 4


def packed_ok(got, texts):
    fill = defaultdict(list)
    for r in got:
        fill[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in fill.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    encode = tokens.encoder(tokens.default_path()).ids
    want = Counter()
    for i, t in texts:
        ids = encode(t or "") + (2).to_bytes(4, "little")
        n = len(ids) // 4
        cuts = [0, n] if n <= 1024 else [0, *range(n % 1024 or 1024, n + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i, k, a, b - a, zlib.crc32(ids[4 * a:4 * b])] += 1
    assert want == Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got)
    return len(fill), ceil(sum(r["length"] for r in got) / 1024)


def test_packing(docs, make):
    used, bound = packed_ok(rows_of(packing.packed_documents(docs[0])), [(i, r.text) for i, r in docs[1].items()])
    assert used <= bound * 1.02 + 1
    packed_ok(rows_of(packing.packed_documents(make(ODD))), [(r[0], r[1]) for r in ODD])
    assert rows_of(packing.packed_documents(make(ODD).limit(0))) == []


def test_packings_are_scored_once(monkeypatch):
    """An island scores each packing when it is made, not again in every generation."""
    calls, score = [], packing._score
    monkeypatch.setattr(packing, "_score", lambda *a: calls.append(1) or score(*a))
    sizes = [341, 342, 343] * 40 + [700, 701] * 20
    bins = packing.evolve(sizes, 1024, [], 1)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert 0 < len(calls) <= packing.POPULATION + 2 * packing.GENERATIONS


def test_encoder_with_small_caches():
    """Ids are the library's while full caches are emptied, of texts with NUL characters too."""
    from tokenizers import Tokenizer
    path = tokens.default_path()
    whole, small = Tokenizer.from_file(path), tokens.Encoder(path)
    small.pieces.size = small.tokens.size = 3
    for text in ["", " ", "a", " a", "a ", "a  b", "\0", "a\0 b \0c,", "Don't stop, won't stop. It's 12.5% off!", "\u00e9t\u00e9, \u00df; \n\n x", "a,", ", a ,", "a\tb  \u00a0 c"]:
        assert small.with_added(text) == np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert len(small.pieces) <= 3 and len(small.tokens) <= 3


COLUMN = [None, "", " ", "a", " a", "a ", "a  b", "  a", "\n a", "\0", "a\0 b \0c,", "\u0100 a\u0100b", "Don't stop, won't stop. It's 12.5% off!",
          "\u00e9t\u00e9, \u00df; \n\n x", "a,", ", a ,", ".", "a\tb  \u00a0 c", "x <|endoftext|> y", "<|endoftext|>", "\u4e2d\u6587 \U0001f600!",
          "z" * 300 + " tail", "wor\u00e8d.\nNext wor\u00e8d", " ".join(f"w{chr(97 + i % 26)}ord{'xyz'[i % 3]}" for i in range(200))]


@pytest.mark.parametrize("cache, block, row", [(3, 1, 1), (50, 64, 2), (1_200_000, 8 << 20, 1000)])
def test_encoder_of_a_column(cache, block, row):
    """Ids of a column are the library's, whatever fits the cache, a block of texts and a call of the library."""
    from tokenizers import Tokenizer
    path = tokens.default_path()
    whole, some = Tokenizer.from_file(path), tokens.Encoder(path)
    some.pieces.size, some.BLOCK, some.ROW = cache, block, row
    want = [np.array(whole.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in COLUMN]
    for _ in range(2):
        assert list(some.many(pa.array(COLUMN))) == want
        assert len(some.pieces) <= cache
    assert list(some.many(pa.array(COLUMN)[3:9])) == want[3:9]
    assert list(some.many(pa.array([], pa.string()))) == [] and list(some.many(pa.array([None], pa.string()))) == [b""]
    some.nul = None  # a vocabulary without an id for NUL
    some.pieces.clear()
    assert list(some.many(pa.array(COLUMN[:9] + COLUMN[11:]))) == want[:9] + want[11:]


def test_column_merges_unseen_words_together(monkeypatch):
    """Words of a column are merged by few calls of the library, each word once, none by a call of its own."""
    some = tokens.Encoder(tokens.default_path())
    rows, row = [], some._merged_row
    monkeypatch.setattr(some, "_merged_row", lambda x: rows.append(list(x)) or row(x))
    monkeypatch.setattr(some, "_merged", lambda token: pytest.fail(f"a call for {token!r}"))
    texts = ["one two, three two"] * 300 + ["two three one."] * 300
    assert len(list(some.many(pa.array(texts)))) == 600
    assert [sorted(r) for r in rows] == [sorted(["one", "two", " two", " three", " one", ",", "."])]


def test_column_is_cut_where_pre_tokens_end():
    """Ids of a column are the library's wherever its bytes are cut; a word is held once, whatever mark follows it."""
    from tokenizers import Tokenizer
    whole, some = Tokenizer.from_file(tokens.default_path()), tokens.Encoder(tokens.default_path())
    parts = [" ", "  ", "a", "B", "'s", "'", "'ll", "\n", "\n\n", "\t", "\r", "\x1c", "\x7f", "\xa0", "\x85", "\u00e9", "\u00d7", "\u00f7", "\u00c0",
             "\u0101", "1", "23", "\u00b2", "!", ",", "..", "_", "\u65e5", "\u0301", "\u2009", "the", "\u00ab", "\U0001f600"]
    rng = np.random.default_rng(7)
    texts = ["".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(6000)]
    want = [np.array(w.ids, "<u4").tobytes() for w in whole.encode_batch(texts, add_special_tokens=False)]
    assert list(some.many(pa.array(texts))) == want
    some.pieces.clear()
    assert len(list(some.many(pa.array(["mot\u00e9, mot\u00e9. mot\u00e9!\nmot\u00e9 12; mot\u00e9"])))) == 1
    assert set(some.pieces) == {"mot\u00e9", " mot\u00e9", ",", ".", "!", "\n", " 12", ";"}


def test_full_cache_keeps_the_pieces_in_use():
    some = tokens.Encoder(tokens.default_path())
    some.pieces.size = 6
    for column in (["one two three"], ["one two six"], ["one ten nine"]):
        assert len(list(some.many(pa.array(column)))) == 1
    assert set(some.pieces) == {"one", " ten", " nine"} | {" two", " three", " six"}
    assert len(list(some.many(pa.array(["one six four"])))) == 1
    assert set(some.pieces) == {"one", " six", " four"}


def test_worker_holds_little_between_tasks():
    """A worker that has seen 1.5 million words holds under 200 MB more than before, as other stages run beside it."""
    code = """
import re, pyarrow as pa
from corpusflow.llm import tokens
def held():
    return sum(map(int, re.findall(r"Pss_Anon: +(\\d+)", open("/proc/self/smaps_rollup").read()))) >> 10
some, texts = tokens.encoder(tokens.default_path()), lambda k: pa.array([" ".join(
    "".join(chr(97 + (i * 7919 + k) // 26 ** j % 26) for j in range(6)) + ",.!"[i % 3] for i in range(a, a + 1000)) for a in range(0, 1_500_000, 1000)])
column = texts(0)
before = held()
n = sum(map(len, some.many(column)))
print(held() - before)
"""
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=pathlib.Path(__file__).parents[2], timeout=120)
    assert int(run.stdout) < 200, run.stdout


def test_crossover_keeps_every_piece():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 1024, 300).tolist()
    a, b = (packing.evolve(sizes, 1024, [], s, population=1, generations=0) for s in (1, 2))
    child = packing.crossover(a, b, sizes, 1024, rng)
    assert sorted(i for x in child for i in x) == list(range(300)) and all(sum(sizes[i] for i in x) <= 1024 for x in child)


def test_sequences_hold_the_ids(make):
    packed = packing.packed_documents(make(ODD), keep_ids=True)
    total = sum(len(r.ids) // 4 for r in packing.sequences(packed).collect())
    assert total == sum(r.length for r in packed.collect())


# --- op 5


def near_brute(texts, percent=75):
    sets = {}
    for k, (i, t) in enumerate(texts):
        w = byte_words("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets[k] = {tuple(w[a:a + 5]) for a in range(max(1, len(w) - 4))} if w else set()
    group = list(range(len(texts)))
    for a in sets:
        for b in range(a):
            x = len(sets[a] & sets[b])
            if x and 100 * x >= percent * len(sets[a] | sets[b]):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    names = defaultdict(list)
    for k, g in enumerate(group):
        names[g].append(texts[k][0])
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in names.items()}
    return sorted(((texts[k][0], len(sets[k]), least[g]) for k, g in enumerate(group)), key=str)


def test_near_duplicates_equal_all_pairs(docs, make):
    def got(df):
        return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df).collect()), key=str)
    assert got(docs[0]) == near_brute([(i, r.text) for i, r in docs[1].items()])
    assert got(make(ODD)) == near_brute([(r[0], r[1]) for r in ODD])
    assert got(make(ODD).limit(0)) == []


def test_near_duplicates_hidden_links(make):
    """Leaves that are linked with each other but not with the typical text; a chain; many edits of one text."""
    rng = np.random.default_rng(4)
    base = [f"b{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for k in range(1, 40):
        w = list(base)
        for p in rng.choice(120, k % 9, replace=False):
            w[p] = f"e{k}x{p}"
        rows.append((k, " ".join(w)))
    chain = [f"c{i}" for i in range(100)]
    for k in range(12):
        rows.append((100 + k, " ".join(chain[6 * k:] + [f"d{i}" for i in range(6 * k)])))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(make(rows)).collect()), key=str)
    assert got == near_brute(rows)


# --- op 6


def test_sharding(docs, make):
    for df, texts in ((docs[0], [(i, r.text) for i, r in docs[1].items()]), (make(ODD), [(r[0], r[1]) for r in ODD])):
        got = rows_of(sharding.shard(df))
        assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=str) == sorted(
            ((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts), key=str)
        load, slots = Counter(), defaultdict(list)
        for r in got:
            load[r["shard"]] += r["size"]
            slots[r["shard"]].append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(load) <= set(range(24))
        assert max(load.values()) <= sum(load.values()) / 24 + max(r["size"] for r in got)
    assert rows_of(sharding.shard(make(ODD).limit(0))) == []


# --- op 7


def removal_brute(texts, window=35):
    words, seen = [byte_words(t) for _, t in texts], Counter()
    for w in words:
        seen.update(tuple(w[k:k + window]) for k in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(texts, words):
        gone = set()
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k:k + window])] > 1:
                gone.update(range(k, k + window))
        left = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def test_substring_dedup_equals_all_windows(docs, make):
    def got(df):
        return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.removal_report(df).collect()), key=str)
    excerpts = ODD + [(20, " ".join(LONG.split()[100:140])), (21, "own start " + " ".join(LONG.split()[250:290]) + " own end"), (22, "p q r " * 40)]
    assert got(docs[0]) == removal_brute([(i, r.text) for i, r in docs[1].items()])
    assert got(make(excerpts)) == removal_brute([(r[0], r[1]) for r in excerpts])
    assert got(make(ODD).limit(0)) == []


def test_factors_follow_their_reference(make):
    """A factor is a passage of its reference, word for word, and never stands on itself."""
    base = [f"w{i}" for i in range(200)]
    texts = {1: "a " + " ".join(base[:90]), 2: "b b " + " ".join(base[40:150]), 3: " ".join(base), 4: "c " + " ".join(base[:60] + base[100:160]),
             5: " ".join(base[10:50]) + " x " + " ".join(base[10:50]), 6: " ".join(["z"] * 50 + ["u"]), 7: "own text",
             8: "h " * 2000, 9: "h " * 1500 + "end", 10: "same " * 40, 11: "same " * 40,
             12: " ".join(["k", *(f"c{i}" for i in range(90)), "k"]), 13: " ".join(["m", "m", *(f"c{i}" for i in range(90))])}
    profiles, touched = substring_dedup.parse(make(list(texts.items())))
    words = {(r.lo, r.hi): texts[r.doc_id].split() for r in profiles.collect()}
    spans = {(r.lo, r.hi): r.spans for r in touched.collect()}
    assert len(spans) == 11
    covered = {k: set() for k in spans}
    for k, of in spans.items():
        for f in of:
            covered[k] |= set(range(f.first, f.first + f.words))
            assert f.words >= 35
            passage = words[k][f.first:f.first + f.words]
            assert any(w[f.place:f.place + f.words] == passage and (o != k or f.place != f.first or w.count(w[0]) == 40) for o, w in words.items())
    assert [[tuple(f)[:2] + (f.place,) for f in spans[k]] for k in spans if words[k][0] in "km"] in ([[(1, 90, 2)], [(2, 90, 1)]], [[(2, 90, 1)], [(1, 90, 2)]])
    brute = {r[0]: r[2] for r in removal_brute(list(texts.items()))}
    ids = {" ".join(texts[i].split()): i for i in texts}
    assert all(len(covered[k]) == brute[ids[" ".join(words[k])]] for k in spans)


def test_hot_windows_are_salted(spark):
    rows = [(i, s, 5, 5) for i in range(40) for s in range(50)] + [(100 + i, 0, i, 0) for i in range(30)] + [(200 + i, 7, i, 0) for i in range(30)]
    starts = spark.createDataFrame(rows, "class long, start int, h1 long, h2 int")
    place = F.struct(F.col("class").alias("reference"), F.col("start").alias("place"))
    index = starts.groupBy("h1", "h2").agg(F.count("*").alias("asked"), F.min(place).alias("low"), F.max(place).alias("high"))
    got = substring_dedup._lookup(starts, index).collect()
    assert sorted((r["class"], r.start) for r in got) == sorted((r[0], r[1]) for r in rows)
    for r in got:
        n = r["class"] % 100
        assert (tuple(r.low), tuple(r.high)) == (((0, 0), (39, 49)) if r["class"] < 100 else ((n + 100, 0), (n + 200, 7)))


def test_greedy_factors():
    at = np.array([3, 4, 5, 6, 9, 10])
    refs = np.array([[1, 8], [1, 8], [2, 8], [2, 7], [5, 6], [5, 6]])
    places = np.array([[10, 0], [11, 1], [50, 2], [51, 9], [9, 70], [10, 71]])
    assert substring_dedup.factors(at, refs, places, 5, 35) == [(3, 37, 8, 0), (6, 35, 2, 51), (9, 36, 6, 70)]
    assert substring_dedup.factors(at[:0], refs[:0], places[:0], 5, 35) == []


def test_no_hot_windows_in_empty_tables(spark):
    starts = spark.createDataFrame([], "class long, start int, h1 long, h2 int")
    place = F.struct(F.col("class").alias("reference"), F.col("start").alias("place"))
    index = starts.groupBy("h1", "h2").agg(F.count("*").alias("asked"), F.min(place).alias("low"), F.max(place).alias("high"))
    assert substring_dedup._lookup(starts.limit(0), index.limit(0)).collect() == []


def test_remove_repeats_keeps_the_rest(make):
    own = "alpha beta\ngamma  delta"
    df = make([(1, own + " " + LONG), (2, LONG + "\nend"), (3, own), (None, None)])
    got = {r.doc_id: r for r in substring_dedup.remove_repeats(df).collect()}
    assert got[1].text == own + " " and got[2].text == "\nend" and got[3].text == own and got[None].text is None
    assert got[1].n_chars == len(own) + 1 and got[3].n_chars == len(own) and got[1]["class"] == "x"


# --- op 8


def test_rule_counts_and_verdicts(docs, make):
    for df, texts in ((docs[0], [(i, r.text) for i, r in docs[1].items()]), (make(ODD), [(r[0], r[1]) for r in ODD])):
        want = []
        for i, t in texts:
            w, t = byte_words(t), t or ""
            grams = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
            again = {p for k in range(len(w) - 4) if grams[tuple(w[k:k + 5])] > 1 for p in range(k, k + 5)}
            lines = [x for x in t.split("\n") if byte_words(x)]
            want.append((i, len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again),
                         len(w) < 10 or 100 * len(again) > 20 * len(w)))
        got = quality_rules.judge(df).collect()
        assert sorted(want, key=str) == sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                                               for r in got), key=str)
        assert not any(r.kept and r.base_failed for r in got)
    assert rows_of(quality_rules.judge(make(ODD).limit(0))) == []
    kept = quality_rules.kept_documents(docs[0])
    assert kept.columns == docs[0].columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in quality_rules.judge(docs[0]).where("kept").collect())


# --- op 9


def test_fingerprints(docs, make):
    def near(s, t):
        """Shared pieces of two texts, of the least power of two of which 16 cover the longer."""
        size = 2
        while 16 * size < max(len(s), len(t)):
            size *= 2
        a, b = ({x[k:k + size] for x in t.split("\n") for k in range(0, len(x), size)} for t in (s, t))
        return len(a & b) / len(a | b) if a | b else 1.0

    texts = sorted((i, r.text or "") for i, r in docs[1].items())
    got = {r.doc_id: r for r in fingerprints.edited_likeness(docs[0]).collect()}
    prints = {}
    for k, (i, t) in enumerate(texts):
        after, half = texts[(k + 1) % len(texts)][1], len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(near(t, edited)) and r.near_next == pytest.approx(near(t, after))
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint
    assert len(rows_of(fingerprints.edited_likeness(make(ODD)))) == len(ODD)
    assert rows_of(fingerprints.edited_likeness(make(ODD).limit(0))) == []
    one = rows_of(fingerprints.edited_likeness(make([(5, "abcd")])))
    assert one[0]["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and one[0]["near_next"] == 1.0


def test_fingerprints_of_short_single_lines(make):
    line = "a line of its own without any break, number %d of those that tell one half from another, and so on to the end"
    rows = [(i, (line % i)[i % 7:i % 7 + n]) for i, n in enumerate([4, 5, 8, 17, 24, 32, 33, 47, 64, 80, 99, 100] * 3)]
    rows += [(100 + i, f"{i} " + " ".join(hashlib.md5(f"{i}-{k}".encode()).hexdigest() for k in range(9))) for i in range(6)]
    for r in fingerprints.edited_likeness(make(rows)).collect():
        assert 0 < r.near_edited <= 1 and (r.doc_id < 100 or r.near_edited > r.near_next)


def test_licences_wrapped_and_named_in_many_ways():
    scanner = license_scan.Scanner()
    name = lambda text: scanner.licenses(scanner.sentences(text))
    whole = {"MIT": ["mit-grant", "mit-notice", "as-is"], "BSD-3-Clause": ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-names"],
             "BSD-2-Clause": ["bsd-redistribution", "bsd-source", "bsd-binary"], "ISC": ["isc"], "GPL-2.0-or-later": ["gpl-2-free", "gpl-hope"],
             "AGPL-3.0-or-later": ["agpl-free"], "LGPL-2.1-or-later": ["lgpl-2-free"],
             "Apache-2.0": ["apache-2-header", "apache-2-use", "apache-2-copy", "apache-2-law"]}
    for licence, of in whole.items():
        text = " ".join(license_scan.SENTENCES[i] for i in of)
        for width in (20, 30, 35, 38, 45, 80, 10_000):
            assert name("\n".join(f" * {x}" for x in textwrap.wrap(text, width))) == [licence], (licence, width)
    assert name("SPDX-License-Identifier: MIT\n\nint main()") == ["MIT"]
    assert name("// SPDX-License-Identifier: GPL-2.0-or-later") == ["GPL-2.0-or-later"]
    assert name("This project is licensed under the MIT License - see the\nLICENSE file for details.") == ["MIT"]
    assert name("This work is licensed under the GNU General Public License, version 2 or later.") == ["GPL-2.0-or-later"]
    assert name("no licence here. Permission to use this is not given.") == []


def test_end_ids_of_more_than_16_bits_are_an_error(spark, make, scratch):
    for end in (-1, 1 << 16):
        with pytest.raises(ValueError):
            token_counts.scan_token_files(spark, scratch, end_id=end)
        with pytest.raises(ValueError):
            token_counts.write_token_files(make(ODD), f"{scratch}/none", end_id=end)


def ends_brute(data, end):
    """Documents of a file's bytes: ordinal, start, tokens, ended."""
    ids = [data[i] + 256 * data[i + 1] for i in range(0, len(data) - 1, 2)]
    out, start = [], 0
    for i, x in enumerate(ids):
        if x == end:
            out.append((len(out), start, i - start, True))
            start = i + 1
    return out + ([(len(out), start, len(ids) - start, False)] if start < len(ids) else [])


@pytest.mark.parametrize("end", [0, 257, 0xBBEF, 0x11BF, 65535])
def test_any_end_id_in_files_of_any_size(spark, scratch, end):
    low, high = end.to_bytes(2, "little")
    rng = np.random.default_rng(end)
    alphabet = bytes({low, high, 0, 1, 0x0A, 0x0D, 0xEF, 0xBB, 0xBF, 0x11})
    dense = [bytes(rng.choice(list(alphabet), n).astype(np.uint8)) for n in (1, 2, 7, 8, 9001, 9002)]
    marked = [b"\xef\xbb\xbf" + bytes(rng.choice(list(alphabet), n).astype(np.uint8)) for n in (1, 2, 6001)] + [b"\xef\xbb\xbf\x11"]
    runs = [bytes([low, high] * 3000), bytes([high]) * 6001, bytes([low]) * 6000, bytes([1, low, high, 1] * 1500), bytes([1, 0, 0, 0, 5, 0, 0, 0])]
    pathlib.Path(scratch, "a").mkdir()
    files = {f"part-{i}": x for i, x in enumerate(dense + marked + runs)}
    for name, x in files.items():
        pathlib.Path(scratch, "a", name).write_bytes(x)
    want = sorted((name, *row) for name, x in files.items() for row in ends_brute(x, end))
    for block in (None, 64):
        got = token_counts.scan_token_files(spark, f"{scratch}/a", end_id=end, block_tokens=block).collect()
        assert sorted((r.file.rsplit("/", 1)[1], *r[1:]) for r in got) == want


def test_peeling_recovers_the_difference(spark):
    df = spark.createDataFrame([(1, [1, 2, 3, 4], [3, 4, 5]), (2, [], [7]), (3, [8], [8])], "row long, a array<long>, b array<long>")
    got = {(r.row, r.digest, r.n) for r in fingerprints.difference(df).where("cell < 0").collect()}
    assert got == {(1, 1, 1), (1, 2, 1), (1, 5, -1), (2, 7, -1)}
    many = spark.createDataFrame([(1, list(range(500)), list(range(400, 1000)))], "row long, a array<long>, b array<long>")
    assert fingerprints.difference(many).where("cell >= 0").count() > 0  # 900 digests don't decode from the first sketch
    assert fingerprints.differing(many).first()[:] == (1, 400, 500)


def test_fingerprints_of_long_texts_and_of_one_id(make):
    """Sets stay small whatever the length; rows without an id and of one id are neighbours."""
    long = "".join(f"{hashlib.md5(str(i).encode()).hexdigest()} " for i in range(40_000))  # over 1 MB in one line
    got = {r.doc_id: r for r in fingerprints.edited_likeness(make([(1, long), (2, long[:700_000] + "x" * 700_000), (3, long.replace(" ", "\n"))])).collect()}
    assert 0.2 < got[1].near_edited < 1 and 0.2 < got[1].near_next < 1 and got[3].near_edited > 0.3
    rows = [(None, f"text number {i} of no id") for i in range(200)] + [(7, f"text number {i} of id 7") for i in range(200)]
    got = rows_of(fingerprints.edited_likeness(make(rows)))
    assert len(got) == 400 and Counter(r["doc_id"] for r in got) == {None: 200, 7: 200} and all(r["near_edited"] > 0 for r in got)


# --- op 10


def test_token_counts(spark, docs, make, scratch):
    encode = tokens.encoder(tokens.default_path()).ids
    got = rows_of(token_counts.document_counts(spark, docs[0], f"{scratch}/a"))
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {i: len(encode(r.text or "")) // 4 for i, r in docs[1].items()}
    by_file = defaultdict(list)
    for r in token_counts.scan_token_files(spark, f"{scratch}/a", block_tokens=7).collect():
        by_file[r.file].append((r.ordinal, r.start, r.n_tokens, r.ended))
    flat = defaultdict(list)
    for r in token_counts.scan_token_files(spark, f"{scratch}/a").collect():
        flat[r.file].append((r.ordinal, r.start, r.n_tokens, r.ended))
    assert {f: sorted(x) for f, x in by_file.items()} == {f: sorted(x) for f, x in flat.items()}
    (folder := __import__("pathlib").Path(scratch, "b")).mkdir()
    folder.joinpath("part-0").write_bytes(np.array([5, 50256, 50256, 7, 8, 9], "<u2").tobytes())
    folder.joinpath("part-1").write_bytes(b"")
    got = sorted((r.ordinal, r.start, r.n_tokens, r.ended) for r in token_counts.scan_token_files(spark, str(folder), block_tokens=2).collect())
    assert got == [(0, 0, 1, True), (1, 2, 0, True), (2, 3, 3, False)]
    odd = make(ODD).coalesce(1)
    odd.write.parquet(f"{scratch}/odd")
    odd = spark.read.parquet(f"{scratch}/odd")
    got = rows_of(token_counts.document_counts(spark, odd, f"{scratch}/c"))
    assert sorted(((r["doc_id"], r["n_tokens"]) for r in got), key=str) == sorted(((r[0], len(encode(r[1] or "")) // 4) for r in ODD), key=str)
    assert rows_of(token_counts.document_counts(spark, odd.limit(0), f"{scratch}/d")) == []


def test_token_files_are_read_in_ranges(spark, docs, scratch):
    rng = np.random.default_rng(4)
    end = 50256
    ids = rng.integers(0, 50256, 5000).astype("<u2")
    ids[rng.integers(0, 5000, 300)] = end
    ids[100:104] = [0x5000, 0x11C4, 0x5011, end]  # the separator's bytes across two ids
    marked = np.array([0xBBEF, 0x11BF, 7, end, 8, end], "<u2")  # begins like a byte order mark
    (folder := __import__("pathlib").Path(scratch, "a")).mkdir()
    files = {"part-0": ids, "part-1": marked, "part-2": marked[:3], "part-3": ids[::-1]}
    for name, x in files.items():
        folder.joinpath(name).write_bytes(x.tobytes())
    want = set()
    for name, x in files.items():
        stops, start = np.flatnonzero(x == end).tolist(), 0
        for k, stop in enumerate(stops + ([len(x)] if x[-1] != end else [])):
            want.add((name, k, start, stop - start, stop < len(x)))
            start = stop + 1
    for block in (None, 64):
        got = token_counts.scan_token_files(spark, str(folder), block_tokens=block).collect()
        assert Counter((r.file.rsplit("/", 1)[1], *r[1:]) for r in got) == Counter(want)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128")
    try:
        assert token_counts._lines(spark, str(folder), end).rdd.getNumPartitions() > 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    token_counts.write_token_files(docs[0], f"{scratch}/b")
    assert not [p for p in __import__("pathlib").Path(scratch, "b").glob("part-*") if p.suffix == ".gz"]
