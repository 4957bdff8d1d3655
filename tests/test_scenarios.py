"""The eight dedup scenarios as ledger/collection state transitions, plus ledger I/O."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusflow.plans import jobs as J
from corpusflow.plans.ingest_run import ingest
from corpusflow.session import remove_path
from corpusflow.sources import collections as C
from corpusflow.sources import ledgers as L
from corpusflow.sources.run_store import RunStore
from conftest import SF_SMALL


@pytest.fixture()
def corpus(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("doc_id < 40")
    key = lambda top: F.concat(F.lit(f"source/{top}/doc_"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("key")
    return docs.select(key("a"), "text").union(docs.where("doc_id < 3").select(key("copies"), "text"))


def _store(spark, root):
    return RunStore(spark, f"{root}/store")


def _run(store, files, **kw):
    return {r.key: r for r in ingest(store, files, chunk_tokens=120, **kw).collect()}


def _counts(store):
    return {n: store.ledger(n).count() for n in ("embedding", "skipped", "upload")}


def test_ledger_roundtrip_and_missing(spark, scratch):
    assert L.read_ledger(spark, scratch, "failed").count() == 0
    df = spark.createDataFrame([("a.pdf", "h1", "boom", "docling")], "filename string, hash string, error string, stage string")
    L.append_ledger(df, scratch, "failed")
    L.append_ledger(df, scratch, "failed")
    got = L.read_ledger(spark, scratch, "failed")
    assert got.count() == 2 and got.columns == [f.name for f in L.SCHEMAS["failed"].fields]


def test_scenarios(spark, scratch, corpus):
    n, distinct = corpus.count(), corpus.select(F.md5("text")).distinct().count()
    store = _store(spark, scratch)
    # 1. first run processes all distinct contents; 7. duplicates inside one run: one processed, the rest skipped
    first = Counter(r.state for r in _run(store, corpus).values())
    assert first == {"processed": distinct, "skipped": n - distinct}
    points = store.points("content").count()
    assert _counts(store) == {"embedding": 2 * distinct, "skipped": n - distinct, "upload": n} and points > 0
    # 2. second run: everything already uploaded -> nothing new, no ledger grows
    assert Counter(r.state for r in _run(store, corpus).values()) == {"known": n}
    assert _counts(store)["upload"] == n and store.points("content").count() == points
    # 3. force: processed again (in-run duplicates too); 8. a second upsert keeps the point count
    assert Counter(r.state for r in _run(store, corpus, force=True).values()) == {"processed": n}
    forced = store.points("content").count()
    assert forced >= points
    _run(store, corpus, force=True)
    assert store.points("content").count() == forced


def test_ledgers_lost_but_points_kept(spark, scratch, corpus):
    """4. Without its ledgers a store still knows what its collection holds, and enters it in the upload ledger."""
    store = _store(spark, scratch)
    _run(store, corpus)
    for name in ("embedding", "upload"):
        remove_path(spark, f"{store.root}/ledger_{name}")
    got = _run(store, corpus)
    assert {(r.state, r.reason) for r in got.values()} == {("skipped", "already_in_qdrant")}
    assert {r.state for r in _run(store, corpus).values()} == {"known"}


def test_pipeline_b_after_ingest_skips(spark, scratch, corpus):
    store = _store(spark, scratch)
    _run(store, corpus)
    md = store.markdown().select(F.col("markdown_key").alias("key"), "text")
    assert md.count() == corpus.count()
    # 5. same bytes -> every file skipped
    out = J.markdown_to_points(md, store.ledger("embedding"), store.resident("content"), chunk_tokens=120)
    assert out.content_points.count() == 0
    # 6. with force -> processed
    forced = J.markdown_to_points(md, store.ledger("embedding"), store.resident("content"), chunk_tokens=120, force=True)
    assert forced.content_points.count() > 0


def test_collection_create_and_versions(spark, scratch):
    assert C.create_collection(spark, scratch, "c1", 4, "Cosine") is True
    assert C.create_collection(spark, scratch, "c1", 4, "Cosine") is False
    assert C.list_collections(spark, scratch) == ["c1"]
    with pytest.raises(ValueError):
        C.create_collection(spark, scratch, "bad name!", 4)
    p = spark.createDataFrame([("a", "f", 1, [0.1] * 4), ("b", "f", 2, [0.2] * 4)],
                              "id string, filename string, page_number int, vector array<double>")
    C.write_points(spark, scratch, "c1", p)
    p2 = spark.createDataFrame([("b", "f", 2, [0.3] * 4)], "id string, filename string, page_number int, vector array<double>")
    C.write_points(spark, scratch, "c1", p2)
    got = {r.id: r for r in C.read_points(spark, scratch, "c1").collect()}
    assert len(got) == 2 and got["b"].vector[0] == 0.3 and got["b"].version >= got["a"].version


def test_json_ledger_and_replace(spark, scratch):
    import json
    import os
    from corpusflow.operators.reports import clear_resolved
    path = os.path.join(scratch, "failed.json")
    rows = [{"filename": "a.pdf", "hash": "h1", "datetime": "2025-01-01T00:00:00Z", "error": "x", "stage": "docling"},
            {"filename": "b.pdf", "hash": "h2", "datetime": "2025-01-02T00:00:00Z", "error": "y", "stage": "chunker"}]
    with open(path, "w") as fh:
        json.dump(rows, fh)
    led = L.read_json_ledger(spark, path, "failed")
    assert {r.filename for r in led.collect()} == {"a.pdf", "b.pdf"}
    assert L.read_json_ledger(spark, os.path.join(scratch, "missing.json"), "failed").count() == 0
    root = os.path.join(scratch, "ledgers")
    L.append_ledger(led, root, "failed")
    ok = spark.createDataFrame([("h1",)], "hash string")
    # rewrite the ledger from a plan that reads the same ledger (staged first)
    L.replace_ledger(spark, clear_resolved(L.read_ledger(spark, root, "failed"), ok), root, "failed")
    assert [r.filename for r in L.read_ledger(spark, root, "failed").collect()] == ["b.pdf"]
