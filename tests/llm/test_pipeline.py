"""Each stage of the pipeline against a brute-force version on what its predecessor kept."""

from collections import Counter

import pytest
from test_operators import ODD, SF_SMALL, make, near_brute, packed_ok  # noqa: F401

import corpus_pipeline
from corpusflow.llm import common, mixing, quality_rules, substring_dedup


@pytest.mark.parametrize("kind", ["table", "odd", "empty"])
def test_stages(spark, make, scratch, kind):
    docs = common.documents(spark, SF_SMALL) if kind == "table" else make(ODD) if kind == "odd" else make(ODD).limit(0)
    columns, seen = docs.columns, {}
    for name, step in corpus_pipeline.STAGES:
        step(spark, docs, SF_SMALL).write.parquet(f"{scratch}/{name}")
        seen[name] = (docs, docs := spark.read.parquet(f"{scratch}/{name}"))
    for name, (before, after) in list(seen.items())[:-1]:
        assert after.columns == columns, name
    before, after = seen["quality_rules"]
    n_words = lambda t: len((t or "").encode().split())
    judged = Counter((r.doc_id, r.n_words) for r in quality_rules.judge(before).where("kept").collect())
    assert Counter((r.doc_id, n_words(r.text)) for r in after.collect()) == judged
    before, after = seen["minhash_near_dedup"]
    brute = near_brute([(r.doc_id, r.text) for r in before.collect()])
    assert {r.doc_id for r in after.collect()} == {i for i, _, c in brute if i == c}
    before, after = seen["substring_dedup"]
    report = {r.doc_id: r for r in substring_dedup.removal_report(before).collect()}
    for r in after.collect():
        assert len((r.text or "").encode().split()) == report[r.doc_id].n_words - report[r.doc_id].n_removed
    before, after = seen["mixing"]
    takes = Counter()
    for r in mixing.mix(before, mixing.word_count()).collect():
        takes[r.doc_id, r.source, r.size] += r.repeats
    assert Counter((r.doc_id, r.source, n_words(r.text)) for r in after.collect()) == +takes
    before, after = seen["best_fit_packing"]
    packed_ok([r.asDict() for r in after.collect()], [(r.doc_id, r.text) for r in before.collect()])


def test_near_dedup_keeps_one_row_of_each_component(spark, make):
    text = lambda k: " ".join(f"{k}w{i}" for i in range(60))
    rows = [(3, text("c")), (5, text("a")), (5, text("c") + " more"), (5, text("a") + " end"), (7, text("b")), (7, text("b"), "src1"),
            (7, text("d")), (None, text("e")), (None, text("f")), (None, text("f")), (None, text("a") + " tail"), (None, None),
            (8, ""), (8, "")]
    kept = lambda df: Counter((r.doc_id, r.text) for r in corpus_pipeline.near_dedup_stage(spark, df, SF_SMALL).collect())
    got = kept(make(rows))
    a = [x for x in got if x[0] == 5]
    assert len(a) == 1 and a[0][1] in (text("a"), text("a") + " end")
    want = [(3, text("c")), a[0], (7, text("b")), (7, text("d")), (None, text("e")), (None, text("f")), (None, None), (8, ""), (8, "")]
    assert got == Counter(want)
