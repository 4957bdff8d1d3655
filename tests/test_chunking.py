"""The linear splitter against the plain statement of the recursive one (brute force)."""

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import python_splitter as PS
from corpusflow.operators import chunking as CH
from conftest import SF_SMALL

SAMPLE = """
# Harbour log

Boats leave at dawn when the tide allows it; the keeper writes every departure down.

## Gear aboard

1. two anchors
2. a spare sail
* rope of forty metres

| boat | crew |
|------|------|
| Gull | 4    |
| Tern | 2    |

![chart of the bay](bay.png)

The chart shows the bay at low water; a sandbank lies in the north, an old wreck in the east, and the
channel between them is wide enough for two boats.

```sh
tide --at noon
```

The evening entry closes the page.
"""


def _native(spark, texts, size, overlap=0):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [list(r[0]) for r in df.select(CH.chunk_texts("t", size, overlap)).collect()]


@pytest.mark.parametrize("size,overlap", [(100, 0), (10, 0), (7, 3), (3, 0)])
def test_inline_samples(spark, size, overlap):
    texts = [SAMPLE, "Gulls follow the nets home. " * 50, "", "   \n\n  ", "a" * 40, "x. " * 30]
    got = _native(spark, texts, size, overlap)
    assert got == [PS.split_text(t, size, overlap) for t in texts]


@pytest.mark.parametrize("size,overlap", [(500, 0), (60, 0), (60, 15)])
def test_all_small_documents(spark, size, overlap):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.regexp_replace("text", r"\.\n", ".\n\n\n"))
                           .otherwise(F.col("text")))
    rows = docs.select("text", CH.chunk_texts("text", size, overlap).alias("c")).collect()
    for r in rows:
        assert list(r.c) == PS.split_text(r.text, size, overlap)


def test_chunk_documents_record_and_stats(spark):
    df = spark.createDataFrame([("f.pdf", SAMPLE), ("empty.pdf", "")], "filename string, text string")
    ch = CH.chunk_documents(df, chunk_tokens=30)
    rows = ch.orderBy("chunk_number").collect()
    assert [r.chunk_number for r in rows] == list(range(1, len(rows) + 1))
    assert all(r.n_tokens <= 30 for r in rows)
    assert {r.element_type for r in rows} >= {"Table", "List", "Code"}
    rec = CH.chunk_record(ch).first()
    assert rec.metadata.page_number == 1 and rec.metadata.filename == "f.pdf"
    stats = {r.filename: r for r in CH.chunk_stats(ch, df.select("filename")).collect()}
    assert stats["empty.pdf"].total_chunks == 0 and stats["f.pdf"].total_chunks == len(rows)


def test_chunking_is_narrow(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(F.col("doc_id").cast("string").alias("filename"), "text")
    plan = CH.chunk_documents(df, min_partitions=0)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    # a single-split input is only spread round-robin in front of the fold, never hashed
    spread = CH.chunk_documents(df)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in spread


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "bc", "\n", "\n\n", "\n\n\n", ". ", " ", "!", "é", "_", "漢", "\u0001", "\xa0", "."]), max_size=60),
       st.sampled_from([1, 2, 3, 5, 8, 20]), st.integers(0, 4))
def test_any_text(parts, size, overlap):
    text, overlap = "".join(parts), min(overlap, size - 1)
    got = CH.split_text(text, size, overlap)
    assert [c for c, _ in got] == PS.split_text(text, size, overlap)
    assert all(n == PS.count_tokens(c) for c, n in got)


def test_overlap_opens_chunks_with_the_kept_tail():
    words = [f"w{i}" for i in range(300)]
    got = [c.split() for c, _ in CH.split_text(" ".join(words), 50, 10)]
    assert all(b[:10] == a[-10:] for a, b in zip(got, got[1:])) and len(got) > 5


def test_custom_counter_and_null(spark):
    df = spark.createDataFrame([("a b c d e",), (None,), ("",)], "t string")
    rows = df.select(CH.chunk_texts_counted("t", 4, 0, counter=len).alias("c")).collect()
    assert [r.c if r.c is None else [(x.t, x.n) for x in r.c] for r in rows] == [[("a b", 3), ("c d", 3), ("e", 1)], None, []]


def test_texts_pass_through_in_small_slices(spark):
    """F3, F6, F7, F8: a worker holds the chunks, vectors and conversions of about a megabyte of text, not of a whole batch."""
    import pyarrow as pa

    from corpusflow.operators import convert as CV
    from corpusflow.operators import embedding as EM
    texts = ["a" * 600, None, "b" * 600, "", "c" * 5000, "d" * 10]
    assert list(CH.slices(pa.array(texts), 1000)) == [(0, 2), (2, 4), (4, 5), (5, 6)]
    assert list(CH.slices(pa.array([], pa.string()))) == []
    words = [(i, None if i % 7 == 0 else f"w{i} " * (40_000 if i % 5 == 0 else i)) for i in range(1, 41)]
    df = spark.createDataFrame(words, "id long, text string").coalesce(1)
    chunks = CH.chunk_documents(df, filename_col="id", chunk_tokens=1000, keep=("id",), min_partitions=0)
    got = {(r.filename, r.chunk_number): (r.text, r.n_tokens) for r in chunks.collect()}
    want = {(i, k): c for i, t in words if t for k, c in enumerate(CH.split_text(t, 1000), 1)}
    assert got == want
    vectors = EM.batch_embed(df, EM.HashingEmbedder(8), keep=("id",), batch_size=3)
    assert {r.id: r.vector is None for r in vectors.collect()} == {i: t is None for i, t in words}
    made = CV.convert_with(df.withColumn("content", F.encode("text", "UTF-8")), lambda b, n: (b.decode(), None), "content", "id")
    assert {r.id: r.markdown for r in made.collect()} == dict(words)
