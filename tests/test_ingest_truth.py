"""Writes neither lose nor falsify rows."""

import hashlib
import time

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import dedup as DD
from corpusflow.operators import embedding as EM
from corpusflow.plans import jobs
from corpusflow.plans.catalog_runs import per_file
from corpusflow.plans.ingest_run import ingest, rebuild
from corpusflow.session import write_table
from corpusflow.sources import collections as C
from corpusflow.sources import ledgers as L
from corpusflow.sources import markdown_store as MS
from corpusflow.sources.run_store import RunStore


def _keys(df, col="filename"):
    return sorted(r[0] for r in df.select(col).distinct().collect())


def test_markdown_increments_merge(spark, scratch):
    path = f"{scratch}/md"
    for rows in ([("markdown/a/x.md", "s/x", "1"), ("markdown/b/z.md", "s/z", "1")], [("markdown/a/y.md", "s/y", "1")],
                 [("markdown/a/x.md", "s/x", "2")]):
        MS.write_markdown(spark.createDataFrame(rows, "markdown_key string, source_key string, text string"), path)
    got = {r.markdown_key: r.text for r in MS.read_markdown(spark, path).collect()}
    assert got == {"markdown/a/x.md": "2", "markdown/a/y.md": "1", "markdown/b/z.md": "1"}


def test_first_write_keeps_one_point_per_id(spark, scratch):
    rows = [("i1", "f", 1, "a"), ("i1", "f", 1, "b"), ("i2", "g", 1, "c")]
    pts = spark.createDataFrame(rows, "id string, filename string, page_number int, pagecontent string")
    C.create_collection(spark, scratch, "c", dim=2)
    C.write_points(spark, scratch, "c", pts)
    assert sorted(r.id for r in C.read_points(spark, scratch, "c").collect()) == ["i1", "i2"]


class Failing:
    dim = 8

    def __init__(self):
        self.inner = EM.HashingEmbedder(8)

    def __call__(self, texts):
        if any("broken" in t for t in texts):
            raise RuntimeError("no service")
        return self.inner(texts)


def states(df):
    return {r.key: r.stage or r.state for r in df.collect()}


def test_every_file_ends_in_a_state(spark, scratch):
    """Each failing stage, a copy of a failing file, and a second run that takes exactly what failed."""
    store = RunStore(spark, f"{scratch}/store")
    rows = [("s/good.pdf", "some text here"), ("s/copy.pdf", "some text here"), ("s/bad.pdf", "a broken text"), ("s/bad2.pdf", "a broken text"),
            ("s/empty.pdf", " \n"), ("s/gone.pdf", None), ("s/odd.xyz", "not read"), ("s/broken.pdf", "fine text")]
    files = spark.createDataFrame([(k, None if t is None else t.encode()) for k, t in rows], "key string, content binary")

    def convert(content, name):
        return (None, "unsupported") if name.endswith(".xyz") else (content.decode() if content else None, None)
    got = states(ingest(store, files, convert=convert, embed=Failing(), name_embed=Failing(), attempts=1))
    assert got == {"s/good.pdf": "skipped", "s/copy.pdf": "processed", "s/bad.pdf": "qdrant", "s/bad2.pdf": "qdrant", "s/empty.pdf": "chunker",
                   "s/gone.pdf": "pipeline", "s/odd.xyz": "docling", "s/broken.pdf": "ollama"}
    failed = {r.filename: (r.stage, r.error) for r in store.ledger("failed").collect()}
    assert failed["s/odd.xyz"] == ("docling", "unsupported") and failed["s/broken.pdf"][1].startswith("Filename embedding failed: RuntimeError")
    assert _keys(store.ledger("upload")) == ["s/copy.pdf", "s/good.pdf"]
    assert _keys(store.points("content"), "file") == _keys(store.points("filenames"), "file") == ["s/copy.pdf"]
    again = states(ingest(store, files, convert=convert, embed=EM.HashingEmbedder(8), name_embed=EM.HashingEmbedder(8)))
    assert again == {"s/good.pdf": "known", "s/copy.pdf": "known", "s/bad.pdf": "processed", "s/bad2.pdf": "skipped", "s/empty.pdf": "chunker",
                     "s/gone.pdf": "pipeline", "s/odd.xyz": "docling", "s/broken.pdf": "processed"}
    m = {r.seq: (r.n_files, r.n_processed, r.n_skipped, r.n_failed) for r in store.manifests().collect()}
    assert m == {1: (8, 1, 1, 6), 2: (8, 2, 3, 3)}


def test_chunks_without_a_vector_are_dropped(spark, scratch):
    store = RunStore(spark, f"{scratch}/store")
    text = "\n\n".join(["good words " * 30, "broken words " * 30, "more words " * 30])
    files = spark.createDataFrame([("a.pdf", text)], "key string, text string")
    assert states(ingest(store, files, embed=Failing(), chunk_tokens=60, attempts=1)) == {"a.pdf": "processed"}
    assert sorted(r.page_number for r in store.points("content").collect()) == [1, 3]
    status = {r.collection_name: (r.status, r.chunks_created) for r in store.ledger("embedding").collect()}
    assert status == {"content": ("partial", 3), "filenames": ("success", 1)}


def test_shortened_file_keeps_no_old_chunk(spark, scratch):
    store = RunStore(spark, f"{scratch}/store")
    for text in ("\n\n".join(f"part {i} " * 40 for i in range(3)), "short now"):
        ingest(store, spark.createDataFrame([("a/f.pdf", text), ("b/f.pdf", text + " b")], "key string, text string"), chunk_tokens=60)
    got = [(r.file, r.pagecontent) for r in store.points("content").collect()]
    assert sorted(got) == [("a/f.pdf", "short now"), ("b/f.pdf", "short now b")]
    assert store.files("content").where("n_points = 1").count() == 2


def test_files_of_one_name(spark, scratch):
    files = spark.createDataFrame([("a/f.pdf", "text of a"), ("b/f.pdf", "text of b")], "key string, text string")
    store = RunStore(spark, f"{scratch}/store")
    ingest(store, files, id_scope="name")
    assert [(r.file, r.pagecontent) for r in store.points("content").collect()] == [("f.pdf", "text of b")]
    assert [r.source for r in store.points("filenames").select(F.col("pagecontent").alias("source")).collect()] == ["f.pdf"]


def test_run_counts_wholly_or_not_at_all(spark, scratch):
    store = RunStore(spark, f"{scratch}/store")
    rows = lambda *k: spark.createDataFrame([(x, "h" + x) for x in k], "filename string, hash string")
    run = store.begin("batch-0")
    store.write_ledger(run, "upload", rows("a", "b", "lost"))
    assert store.ledger("upload").count() == 0
    run = store.begin("batch-0")
    store.write_ledger(run, "upload", rows("a", "b"))
    store.commit(run, 2)
    assert store.begin("batch-0") is None and _keys(store.ledger("upload")) == ["a", "b"]
    assert store.begin("batch-1").seq == 2
    files = spark.createDataFrame([("k", "t"), ("k", "u")], "key string, text string")
    for bad in (files, spark.createDataFrame([(None, "t")], "key string, text string")):
        with pytest.raises(ValueError):
            ingest(store, bad)
    assert ingest(store, files, run_id="batch-0").count() == 0
    assert ingest(store, files.limit(0)).count() == 0 and store.manifests().count() == 2


def test_equal_names_in_two_directories(spark, scratch):
    md = spark.createDataFrame([("markdown/a/f.md", "text of a"), ("markdown/b/f.md", "text of b")], "key string, text string")
    empty = L.empty(spark, "embedding")
    points = jobs.markdown_to_points(md, empty, None).content_points.collect()
    assert len({p.id for p in points}) == 2
    assert {(p.pagecontent, p.file_hash) for p in points} == {(t, hashlib.md5(t.encode()).hexdigest()) for t in ("text of a", "text of b")}


def test_null_content_is_not_a_duplicate(spark):
    files = spark.createDataFrame([("a", None), ("b", None), ("c", "h"), ("d", "h")], "key string, hash string")
    got = {r.key: r.action for r in DD.dedup_decision(files, L.empty(spark, "embedding"), None, key_col="key", collection="content").collect()}
    assert got == {"a": "process", "b": "process", "c": "process", "d": "skip"}


def test_ledger_row_without_a_date_counts(spark):
    files = spark.createDataFrame([("k", "h")], "key string, hash string")
    ledger = spark.createDataFrame([(None, "k", "h", "content")], "timestamp timestamp, filename string, md5_hash string, collection_name string")
    assert DD.dedup_decision(files, ledger, None, key_col="key", collection="content").first()["action"] == "skip"


def test_corrupt_json_rows_are_reported(spark, scratch):
    path = f"{scratch}/led.json"
    with open(path, "w") as f:
        f.write('[{"filename": "a", "hash": "1"}, {"filename": "b", "hash": "2", "datetime": {"x": 1}}]')
    good, bad = L.read_json_ledger(spark, path, "upload").collect(), L.corrupt_json_rows(spark, path, "upload").collect()
    assert [r.filename for r in good] == ["a"] and len(bad) == 1


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.split("\n") if f.endswith(".data")}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_written_table_leaves_no_shuffle_files(spark, scratch):
    """a run holds the shuffle files of one write at a time, not of all."""
    rows = spark.range(1000, numPartitions=4).groupBy((F.col("id") % 300).alias("k")).agg(F.count("*").alias("n"))
    held = RunStore(spark, f"{scratch}/store")
    run = held.begin("r")
    before = _shuffle_files(spark)
    write_table(rows, f"{scratch}/a")
    held.write(run, "t", rows)
    for _ in range(50):  # files are deleted in the background
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left
    assert spark.read.parquet(f"{scratch}/a").agg(F.sum("n")).first()[0] == 1000
    assert [f for f in spark.read.parquet(f"{scratch}/store/t").inputFiles() if not f.endswith(".zstd.parquet")] == []


def test_texts_are_not_exchanged_for_nothing(spark, scratch):
    """where no file was replaced, the points and the markdown are read without a join; one exchange makes the text of a file."""
    store = RunStore(spark, f"{scratch}/store")
    files = spark.createDataFrame([("a/f.pdf", "text of a. " * 90), ("b/f.pdf", "text of b"), ("c/f.pdf", "text of b")], "key string, text string")
    ingest(store, files, chunk_tokens=60)
    rebuild(store, "again", EM.HashingEmbedder(24), "hashing-24", chunk_tokens=30)
    for rows in (store.points("content"), store.points("again"), store.markdown()):
        assert not any(x in _plan(rows) for x in ("SortMergeJoin", "Exchange hashpartitioning"))
    assert store.markdown().count() == 3 and _keys(store.points("content"), "file") == ["a/f.pdf", "b/f.pdf"]
    assert _keys(store.points("again"), "file") == ["a/f.pdf", "b/f.pdf", "c/f.pdf"]
    made = per_file(store.points("again"), "file")
    assert _plan(made).count("Exchange hashpartitioning") == 1
    squeezed = {k: hashlib.md5(t.replace(" ", "").encode()).hexdigest() for k, t in files.collect()}
    assert {r.file: (r.pages_whole, r.text_md5) for r in made.collect()} == {k: (True, m) for k, m in squeezed.items()}
    # a second run that replaces one file
    ingest(store, spark.createDataFrame([("a/f.pdf", "new text of a")], "key string, text string"), chunk_tokens=60)
    assert sorted((r.file, r.pagecontent) for r in store.points("content").collect()) == [("a/f.pdf", "new text of a"), ("b/f.pdf", "text of b")]
    assert {r.key: r.text for r in store.markdown().collect()}["a/f.pdf"] == "new text of a" and store.markdown().count() == 3


@pytest.mark.parametrize("rows", [
    [("u", 1, "u", "a"), ("u", 2, "u", "a"), ("u", 3, "v", "a")],  # pages 1, 2, 3, ids u, u, v
    [("u", 1, "u", "a"), ("u", 1, "v", "a")], [("u", None, "u", "a"), ("u", None, "v", "b")], [("u", 1, None, "a")],
    [("u", 1, "u", "a"), ("u", None, "v", "b")], [("u", 1, "u", None), ("u", 2, "v", "x")], [("u", 2, "u", "b"), ("u", 1, "v", "a")]])
def test_pages_are_whole(spark, rows):
    got = per_file(spark.createDataFrame(rows, "file string, page_number int, id string, pagecontent string"), "file").collect()
    pages, ids = {r[1] for r in rows} - {None}, {r[2] for r in rows} - {None}
    want = len(pages) == len(ids) == len(rows) == max(pages, default=0)
    assert [bool(r.pages_whole) for r in got] == [want]


def test_points_of_equal_ids_in_one_run(spark, scratch):
    """Of points with equal ids those of the last file stay; rows without an id or a file are no points."""
    rows = [("1", "a", 1), ("1", "b", 1), ("1", "b", 2), ("2", "a", 3), ("2", "a", 4), (None, "a", 5), ("3", None, 6), ("4", None, 7), ("4", "c", 8), ("5", "d", 9)]
    for kept, name in ((rows, "x"), ([r for r in rows if r[0] not in ("1",)], "y"), (rows[:0], "z")):
        store = RunStore(spark, f"{scratch}/{name}")
        store.create_collection("c", 2)
        run = store.begin()
        store.write_points(run, "c", spark.createDataFrame(kept, "id string, file string, page_number int"))
        store.commit(run)
        want = [r for r in kept if None not in r and r[1] == max(x[1] or "" for x in kept if x[0] == r[0])]
        assert sorted((r.id, r.file, r.page_number) for r in store.points("c").collect()) == want
        assert {r.file: r.n_points for r in store.files("c").collect()} == {f: sum(r[1] == f for r in want) for f in {r[1] for r in want}}


def test_a_file_that_fails_with_vectors_has_no_points(spark, scratch):
    """A converter that gives a text where there is no content: the file fails for want of content, though its chunks were embedded."""
    store = RunStore(spark, f"{scratch}/store")
    files = spark.createDataFrame([("a.pdf", b"text of a"), ("gone.pdf", None)], "key string, content binary")
    got = states(ingest(store, files, convert=lambda content, name: ("made up" if content is None else content.decode(), None)))
    assert got == {"a.pdf": "processed", "gone.pdf": "pipeline"} or got == {"a.pdf": "processed", "gone.pdf": "docling"}
    assert _keys(store.points("content"), "file") == ["a.pdf"]
