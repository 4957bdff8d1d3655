"""Unit cases for path, hash and text expressions, from the reference's inline samples."""

import hashlib
import uuid

from pyspark.sql import functions as F

from corpusflow.functions import hashing as H
from corpusflow.functions import paths as P
from corpusflow.functions import text as TX


def _one(spark, rows, schema, *cols):
    return spark.createDataFrame(rows, schema).select(*cols).collect()


def test_mirrored_keys(spark):
    keys = ["source/harbour/y2019/tides.pdf", "source/forest/plan.docx", "source/map.pdf",
            "other/a.b.c.pdf", "source/noext"]
    got = [r[0] for r in _one(spark, [(k,) for k in keys], "k string", P.mirrored_key("k"))]
    assert got == ["markdown/harbour/y2019/tides.md", "markdown/forest/plan.md",
                   "markdown/map.md", "markdown/other/a.b.c.md", "markdown/noext.md"]


def test_original_name_and_parts(spark):
    rows = _one(spark, [("markdown/x/f.md",), ("markdown/x/tide 4.1 table.md",), ("markdown/y/report.pdf.md",)],
                "k string", P.original_name("k"), P.stem("k"), P.suffix("k"), P.depth("k"), P.top_directory("k"))
    assert [r[0] for r in rows] == ["f.pdf", "tide 4.1 table", "report.pdf"]
    assert rows[0][1:] == ("f", ".md", 2, "x")
    dot = _one(spark, [("a/.DS_Store",), ("a/b/c/doc_8.DS_Store",)], "k string", P.suffix("k"), P.stem("k"))
    assert dot[0] == ("", ".DS_Store") and dot[1] == (".DS_Store", "doc_8")


def test_skip_and_markdown_filters(spark):
    rows = _one(spark, [("s/a.pdf",), ("s/b.DS_Store",), ("s/c.MD",), ("s/d.markdown",)], "k string",
                P.skip_by_extension("k", [" .DS_Store ", "", ".docx"]), P.is_markdown("k"),
                P.skip_by_extension("k", []))
    assert [tuple(r) for r in rows] == [(False, False, False), (True, False, False), (False, True, False),
                                        (False, False, False)]


def test_hashes_match_python(spark):
    names = ["doc_1.pdf", "tide 4.1 table.pdf", "ü漢字.md"]
    rows = _one(spark, [(n,) for n in names], "n string", "n", H.uuid5("n"), H.text_md5("n"),
                H.chunk_point_id("n", F.lit(3)))
    for n, u, m, c in rows:
        assert u == str(uuid.uuid5(uuid.NAMESPACE_DNS, n))
        assert m == hashlib.md5(n.encode()).hexdigest()
        assert c == str(uuid.uuid5(uuid.NAMESPACE_DNS, f"{n}_3"))


def test_hashes_read_whole_files(spark):
    data = [b"x" * (2 << 20) + end for end in (b"a", b"b")]  # equal size, equal first 2 MiB
    df = spark.createDataFrame([(bytearray(d), len(d)) for d in data], "c binary, n long")
    rows = df.select(H.fast_hash("c", "n"), H.size_switched_hash("c")).collect()
    for d, (fast, full) in zip(data, rows):
        assert fast == hashlib.md5(d + str(len(d)).encode()).hexdigest() and full == hashlib.md5(d).hexdigest()


def test_long_tokens_are_kept(spark):
    from corpusflow.operators.filters import match_text
    df = spark.createDataFrame([("the end",), ("the internationalization of it",)], "t string")
    assert [r[0] for r in df.select(match_text("t", "the internationalization")).collect()] == [False, True]
    assert not any(r[0] for r in df.select(match_text("t", "the internationalization", max_len=15)).collect())
    assert "internationalization" in df.select(TX.prefix_tokens("t")).collect()[1][0]


def test_light_hash_groups_equal_content(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "t string").select(H.light_hash(H.utf8("t")).alias("h"))
    hs = [r.h for r in df.collect()]
    assert hs[0] == hs[1] != hs[2] and all(len(h) == 16 for h in hs)


def test_decode_fallback(spark):
    text = "Réel élan"
    df = spark.createDataFrame([(bytearray(text.encode("latin-1")),), (bytearray(text.encode("utf-8")),)], "c binary")
    assert [r[0] for r in df.select(TX.decode_with_fallback("c")).collect()] == [text, text]


def test_tokenizers(spark):
    df = spark.createDataFrame([("Gulls; nets, rope.",), ("tide",), ("Bay 港口",)], "t string")
    word = [r[0] for r in df.select(TX.normalise_tokens(TX.word_tokens("t"))).collect()]
    assert word[0] == ["gulls", "nets", "rope"]
    ws = [r[0] for r in df.select(TX.whitespace_tokens("t")).collect()]
    assert ws[0] == ["Gulls;", "nets,", "rope."]
    pre = df.select(TX.prefix_tokens("t")).collect()[1][0]
    assert pre == ["t", "ti", "tid", "tide"]
    ml = df.select(TX.normalise_tokens(TX.multilingual_tokens("t"))).collect()[2][0]
    assert ml == ["bay", "港口"]


def test_element_types(spark):
    samples = {
        "| a | b |\n|---|---|": "Table", "see ![x](y.png) here": "Image", "```\ncode\n```": "Code",
        "intro\n- item": "List", "1. first": "List", "plain text.": "Text", "    indented": "Text",
        "![a\n](b)": "Text",
    }
    df = spark.createDataFrame([(k,) for k in samples], "t string")
    got = [r[0] for r in df.select(TX.element_type("t")).collect()]
    assert got == list(samples.values())


def test_token_count(spark):
    df = spark.createDataFrame([("Gulls, nets; 42 ü_x",)], "t string")
    assert df.select(TX.token_count("t")).first()[0] == 8


def test_content_point_id_scope(spark):
    from corpusflow.operators.points import content_points
    rows = [("a/x.pdf", "x.pdf", 1, "t", "Text", "m", [0.1]), ("b/x.pdf", "x.pdf", 1, "t", "Text", "m", [0.2])]
    df = spark.createDataFrame(rows, "key string, filename string, chunk_number int, text string, "
                                     "element_type string, md5_hash string, vector array<double>")
    by_name = {r.id for r in content_points(df, file_hash_col=None).collect()}
    by_key = {r.id for r in content_points(df, file_hash_col=None, id_scope="key").collect()}
    assert len(by_name) == 1 and len(by_key) == 2
