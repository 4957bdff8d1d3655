"""A representative set of registered queries against their DuckDB oracles at sf0.001
(the full set runs with tools/oracle_check.py at sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ("documents embeddings pages benchmark labels conversations events supplier").split()
NAMES = ["mirrored_keys", "point_ids", "element_types", "chunk_invariants_100", "dedup_decision_four",
         "hashing_embedder", "search_cosine", "search_context_window", "search_keyword_filenames",
         "skip_breakdown", "retry_worklist", "corpus_diagnosis", "html_convert", "payload_profile"]


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{round(v, 6):.6f}"
    return "NULL" if v is None else str(v)


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert _canon([tuple(r) for r in df.collect()], df.columns) == _canon(drows, dcols)
