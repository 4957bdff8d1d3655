"""Listing, content, markdown store and streaming operators."""

import gzip
import hashlib
import os

from pyspark.sql import functions as F

from corpusflow.sources import listing as LS
from corpusflow.sources import markdown_store as MS
from corpusflow.streaming import ingest as ST
from conftest import SF_SMALL


def _tree(root):
    files = {"source/a/x.pdf": b"alpha", "source/a/b/y.docx": b"beta!", "source/z.md": b"", "other/q.txt": b"q"}
    for k, v in files.items():
        p = os.path.join(root, k)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as fh:
            fh.write(v)
    return files


def test_listing_metadata_only_and_prefix(spark, scratch):
    files = _tree(scratch)
    lst = LS.list_objects(spark, scratch)
    got = {r.key: r.size for r in lst.collect()}
    # Spark's file scan skips zero-byte files when planning splits (README, open items)
    assert got == {k: len(v) for k, v in files.items() if v}
    plan = lst._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[1].split("\n")[0]
    src = {r.key for r in LS.with_prefix(lst, "source/").collect()}
    assert src == {k for k, v in files.items() if k.startswith("source/") and v}
    first = [r.key for r in LS.first_n(lst, 2).collect()]
    assert first == sorted(k for k, v in files.items() if v)[:2]


def test_read_content_and_exists(spark, scratch):
    files = _tree(scratch)
    keys = spark.createDataFrame([("source/a/x.pdf",), ("missing.pdf",)], "key string")
    got = {r.key: r.content for r in LS.read_content(spark, scratch, keys).collect()}
    assert bytes(got["source/a/x.pdf"]) == b"alpha" and got["missing.pdf"] is None
    lst = LS.list_objects(spark, scratch, with_content=True)
    etags = {r.key: r.etag for r in lst.collect()}
    assert etags["source/a/x.pdf"] == hashlib.md5(b"alpha").hexdigest()
    ex = {r.key: r.exists for r in LS.object_exists(keys, lst).collect()}
    assert ex == {"source/a/x.pdf": True, "missing.pdf": False}
    meta = LS.object_metadata(keys, lst).collect()
    assert [(m.key, m.content_type) for m in meta] == [("source/a/x.pdf", "application/pdf")]


def test_markdown_store_roundtrip(spark, scratch):
    rows = [("markdown/a/x.md", "source/a/x.pdf", "# x"), ("markdown/b/y.md", "source/b/y.pdf", "y")]
    df = spark.createDataFrame(rows, "markdown_key string, source_key string, text string")
    path = os.path.join(scratch, "md")
    MS.write_markdown(df, path)
    # dynamic partition overwrite: rewriting directory 'a' keeps 'b'
    MS.write_markdown(spark.createDataFrame([("markdown/a/x.md", "source/a/x.pdf", "# x2")],
                                            "markdown_key string, source_key string, text string"), path)
    back = {r.markdown_key: r.text for r in MS.read_markdown(spark, path).collect()}
    assert back == {"markdown/a/x.md": "# x2", "markdown/b/y.md": "y"}
    listing = spark.createDataFrame([("source/a/x.pdf",), ("source/c/none.pdf",)], "key string")
    look = {r.key: r.markdown for r in MS.lookup_markdown(listing, MS.read_markdown(spark, path)).collect()}
    assert look == {"source/a/x.pdf": "# x2", "source/c/none.pdf": None}


def test_stream_rates_and_dedup(spark, scratch):
    schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    ev = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(SF_SMALL)
    tab = ST.run_to_files(ST.stream_rates(ev, failed=F.col("event_type") == "error"), os.path.join(scratch, "o1"), os.path.join(scratch, "c1"), "complete")
    static = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    assert tab.agg(F.sum("n_files")).first()[0] == static.count()
    docs_schema = spark.read.parquet(f"{SF_SMALL}/documents.parquet").schema
    ds = (spark.readStream.schema(docs_schema).option("pathGlobFilter", "documents.parquet").parquet(SF_SMALL)
          .withColumn("ts", F.current_timestamp()))
    dd = ST.run_to_files(ST.stream_dedup(ds, "ts").select("doc_id", "hash"), os.path.join(scratch, "o2"), os.path.join(scratch, "c2"))
    distinct = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(F.md5("text")).distinct().count()
    assert dd.count() == distinct


def test_streams_read_tables_that_are_folders(spark, scratch):
    """a table may be one file or a folder of files."""
    import shutil

    from corpusflow.plans import catalog_search, fixtures
    d = os.path.join(scratch, "tables")
    shutil.copytree(SF_SMALL, d)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    os.remove(f"{d}/documents.parquet")
    docs.repartition(3).write.parquet(f"{d}/documents.parquet")
    for one in (SF_SMALL, d):
        seen = ST.run_to_files(fixtures.table_stream(spark, one, "documents").select("doc_id"), f"{scratch}/o{len(one)}", f"{scratch}/c{len(one)}")
        assert seen.count() == docs.count()
    assert catalog_search.stream_ingest(spark, d).count() > 0


def test_stream_dedup_batches_have_many_files(spark, scratch):
    """each arrival is dealt over several files; the second brings nothing new."""
    from corpusflow.plans import catalog_runs
    d, texts = os.path.join(scratch, "tables"), [f"text {i % 70}" for i in range(200)]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3).write.parquet(f"{d}/documents.parquet")
    out = catalog_runs.stream_dedup(spark, d)
    assert sorted(r.hash for r in out.collect()) == sorted(hashlib.md5(t.encode()).hexdigest() for t in set(texts))
    source = out.inputFiles()[0].removeprefix("file://").rsplit("-out/", 1)[0]
    assert len([f for f in os.listdir(source) if f.endswith(".parquet")]) == 6


def test_md5_of_objects_read_in_blocks(spark, scratch):
    """bytes as blocks, whatever an object's line ends, first bytes or name; no object is one row."""
    root = os.path.join(scratch, "objects")
    os.makedirs(f"{root}/a b")
    blobs = {"one.txt": b"alpha", "end.txt": b"alpha\n", "ends.txt": b"\n\n", "nl.txt": b"\n", "cr.txt": b"a\r\nb\rc\n\r",
             "bom.txt": b"\xef\xbb\xbfx\ny", "bom_end.txt": b"\xef\xbb\xbfx\n", "bom_alone.txt": b"\xef\xbb\xbf",
             "a b/big %20.bin": os.urandom(3_000_000) + b"\n" * 5000, "plain.gz": gzip.compress(b"packed" * 1000), "not.gz": b"no gzip\n"}
    for name, body in blobs.items():
        with open(f"{root}/{name}", "wb") as fh:
            fh.write(body)
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")  # an object is read by many tasks
    try:
        wanted = LS.list_objects(spark, root).select("key", "size").unionByName(spark.createDataFrame([("none", 5)], "key string, size long"))
        for at_once in (100, 3):  # by path, and by a semi-join
            blocks = LS.read_content(spark, root, wanted, blocks=True, paths_at_once=at_once)
            got = {r.key: (r.size, r.etag) for r in LS.content_md5(blocks).collect()}
            assert got == {k: (len(v), hashlib.md5(v).hexdigest()) for k, v in blobs.items()} | {"none": (5, None)}
        assert blocks.where("key like '%big%'").agg(F.max(F.length("content"))).first()[0] < 1_500_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


def test_stream_to_store_across_batches(spark, scratch):
    from corpusflow.sources.run_store import RunStore
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    src, store = os.path.join(scratch, "in"), RunStore(spark, os.path.join(scratch, "store"))
    # two input files: the second repeats some texts of the first
    docs.where("doc_id < 120").coalesce(1).write.parquet(src)
    docs.where("doc_id >= 80").coalesce(1).write.mode("append").parquet(src)

    def drain(checkpoint):
        stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(src)
        files = stream.select(F.concat(F.lit("in/doc_"), F.col("doc_id").cast("string"), F.lit(".md")).alias("key"), "text")
        ST.stream_to_store(store, "docs", files, os.path.join(scratch, checkpoint), chunk_tokens=200)
    drain("ckpt")
    distinct = docs.select(F.md5("text")).distinct().count()
    emb = store.ledger("embedding").where("collection_name = 'content'")
    assert emb.count() == emb.select("md5_hash").distinct().count() == distinct  # nothing embedded twice
    assert store.manifests().count() == 2
    before = {n: store.ledger(n).count() for n in ("conversion", "upload", "embedding", "qdrant_upload", "skipped", "failed")}
    drain("another")  # both batches again
    assert before == {n: store.ledger(n).count() for n in before} and store.manifests().count() == 2


def test_late_rows_are_dropped_in_append_mode(spark, scratch):
    """One file per batch; the row of 08:20 arrives when the watermark has closed its window (Spark tests late rows
    against the watermark that the batch before it used)."""
    src = os.path.join(scratch, "events")
    for i, hours in enumerate([["2024-01-01 08:10:00", "2024-01-01 09:00:00"], ["2024-01-01 12:00:00"],
                               ["2024-01-01 13:00:00"], ["2024-01-01 08:20:00", "2024-01-01 15:00:00"]]):
        df = spark.createDataFrame([(h,) for h in hours], "ts string").select(F.to_timestamp("ts").alias("ts"))
        df.coalesce(1).write.parquet(f"{src}/b{i}")
        for f in os.listdir(f"{src}/b{i}"):
            if f.endswith(".parquet"):
                os.utime(f"{src}/b{i}/{f}", (1_700_000_000 + 100 * i,) * 2)
    ev = (spark.readStream.schema("ts timestamp").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
          .option("maxFilesPerTrigger", 1).parquet(src))
    out = ST.run_to_files(ST.stream_rates(ev), os.path.join(scratch, "out"), os.path.join(scratch, "ck"))
    got = {str(r.w.start): r.n_files for r in out.collect()}
    assert got == {"2024-01-01 08:00:00": 1, "2024-01-01 09:00:00": 1, "2024-01-01 12:00:00": 1,
                   "2024-01-01 13:00:00": 1}


def test_batch_numbers_without_holes(spark):
    from corpusflow.operators import points as PT
    pts = spark.createDataFrame([("f", p, f"i{p}") for p in (1, 2, 7, 8, 9, 5000, 9000)], "filename string, page_number int, id string")
    rows = PT.write_batches(pts, 2).orderBy("page_number").collect()
    assert [(r.batch_number, r.batch_count) for r in rows] == [(1, 4), (1, 4), (2, 4), (2, 4), (3, 4), (3, 4), (4, 4)]


def test_bytes_are_read_of_changed_keys_only(spark, scratch):
    """Snapshots of a folder: bytes of new and changed objects only; unchanged ones keep their etag."""
    import hashlib
    import os
    import pathlib

    from corpusflow.sources import snapshots as SN
    from corpusflow.sources.run_store import RunStore
    root, store = pathlib.Path(scratch, "objects"), RunStore(spark, f"{scratch}/store")
    names = ["a/1.txt", "a/2.txt", "b/space %20 [x].txt", "b/4.txt", "c/5.txt"]
    for i, name in enumerate(names):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(f"text {i}" * (i + 1))

    def states(df):
        return {r.key: r.state for r in df.collect()}

    def md5(name):
        return hashlib.md5((root / name).read_bytes()).hexdigest()

    assert states(SN.refresh(store, str(root), "r1")) == dict.fromkeys(names, "new")
    assert {r.key: r.etag for r in SN.latest(store).collect()} == {n: md5(n) for n in names}
    assert SN.refresh(store, str(root), "r1") is None
    kept = (root / "a/1.txt").stat()
    (root / "a/1.txt").write_text("TEXT 0")  # same size and, below, same time: taken for unchanged
    os.utime(root / "a/1.txt", ns=(kept.st_atime_ns, kept.st_mtime_ns))
    (root / "a/2.txt").write_text("longer than it was")
    (root / "b/4.txt").unlink()
    (root / "c/6.txt").write_text("six")
    want = {"a/1.txt": "same", "a/2.txt": "changed", names[2]: "same", "b/4.txt": "removed", "c/5.txt": "same", "c/6.txt": "new"}
    assert states(SN.refresh(store, str(root), "r2")) == want
    now = {r.key: r.etag for r in SN.latest(store).collect()}
    assert now["a/1.txt"] == hashlib.md5(b"text 0").hexdigest() and now["a/2.txt"] == md5("a/2.txt") and now["c/6.txt"] == md5("c/6.txt")
    assert set(now) == set(want) - {"b/4.txt"}

    some = spark.createDataFrame([(names[2],), ("c/5.txt",), ("none",)], "key string")
    for at_once, files in ((10_000, 2), (1, 5)):  # by path, and by a semi-join
        read = LS.content_of(spark, str(root), some, paths_at_once=at_once)
        assert {r.key: bytes(r.content) for r in read.collect()} == {n: (root / n).read_bytes() for n in (names[2], "c/5.txt")}
        if files == 2:
            read.write.format("noop").mode("overwrite").save()
            scan = read._jdf.queryExecution().executedPlan().collectLeaves().head()
            read._jdf.queryExecution().toRdd().count()
            assert scan.metrics().apply("numFiles").value() == files
    got = {r.key: r.content for r in LS.read_content(spark, str(root), some).collect()}
    assert got["none"] is None and bytes(got["c/5.txt"]) == (root / "c/5.txt").read_bytes()


def test_listing_changes_of_odd_entries(spark):
    from corpusflow.sources import snapshots as SN
    schema = "key string, size long, last_modified timestamp, etag string"
    before = spark.createDataFrame([("a", 1, None, "X"), ("b", 1, None, "x"), ("c", None, None, None), ("d", 1, None, "old"), (None, 1, None, None)], schema)
    now = spark.createDataFrame([("a", 1, None, "x"), ("b", 1, None, "y"), ("c", None, None, "e"), ("d", 1, None, None), (None, 2, None, None)], schema)
    assert {(r.key, r.state, r.etag) for r in SN.changes(before, now).collect()} == {
        ("a", "same", "x"), ("b", "changed", "y"), ("c", "same", "e"), ("d", "same", "old")}
    assert {r.state for r in SN.changes(before.limit(0), now).collect()} == {"new"}
    assert {r.state for r in SN.changes(before, now.limit(0)).collect()} == {"removed"}
