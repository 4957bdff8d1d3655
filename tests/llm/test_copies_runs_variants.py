"""Exact copies, periodic runs and spelling variants against brute force, and on empty, null, repeated, long and odd input."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from test_operators import ODD, SF_SMALL, make, rows_of  # noqa: F401

from corpusflow.llm import common, exact_dedup, mixing, near_dedup, periodic_runs, sharding, spelling_variants, substring_dedup, texthash

LONG = "".join(f"word{i % 997} " for i in range(160_000))  # over 1 MB
REPEATS = [(i if i % 3 else None, f"text {i % 4}") for i in range(60)] + [(7, "same  row"), (7, "same row"), (7, "same\trow")]


def norm(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


# --- exact copies


def copies_ok(got, rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    assert Counter((r["doc_id"], r["text_sha256"]) for r in got) == Counter(
        (i, s) for s, ids in sha.items() for i in ids)
    kept = Counter(r["text_sha256"] for r in got if r["kept"])
    assert kept == Counter(dict.fromkeys(sha, 1))
    for r in got:
        ids = sha[r["text_sha256"]]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == min((i for i in ids if i is not None), default=None)
        assert not r["kept"] or r["doc_id"] == r["keep_id"]


@pytest.mark.parametrize("width", [64, 6])
def test_exact_copies(spark, make, width):
    """Six bits make almost all texts share a fingerprint, so only the bytes tell them apart."""
    table = common.documents(spark, SF_SMALL)
    copies_ok(rows_of(exact_dedup.exact_duplicates(table, width=width)), [(r.doc_id, r.text) for r in table.collect()])
    rows = [(r[0], r[1]) for r in ODD] + REPEATS + [(90, LONG), (91, LONG.replace(" ", "\n")), (92, LONG + "x")]
    copies_ok(rows_of(exact_dedup.exact_duplicates(make(rows), width=width)), rows)


def test_exact_copies_of_frequent_texts(make, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BLOCK_ENTRIES", 16)
    monkeypatch.setattr(exact_dedup, "FILTER_ROWS", 50)
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", 20)
    rows = [(i, "a third of all rows" if i % 3 else f"text {i % 50}") for i in range(900)]
    got = rows_of(exact_dedup.exact_duplicates(make(rows).repartition(4)))
    copies_ok(got, rows)


def test_exact_copies_of_nothing(make):
    empty = exact_dedup.exact_duplicates(make(ODD).limit(0))
    assert empty.collect() == [] and empty.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


@pytest.mark.parametrize("width", [64, 20, 5])
def test_filters_lose_nothing_and_merge(width):
    rng = np.random.default_rng(width)
    parts = [rng.integers(0, 1 << min(width, 63), n, dtype=np.uint64) % np.uint64(500 + k) for k, n in enumerate((0, 1, 300, 2000))]
    parts.append(np.array([0, (1 << width) - 1], np.uint64))
    parts = [p & np.uint64((1 << width) - 1) for p in parts]
    filters = []
    for p in parts:
        prints, counts = np.unique(p, return_counts=True)
        back, n = exact_dedup.decode(*exact_dedup.encode(prints, counts, width), width)
        assert (back == prints).all() and (n == counts).all()
        filters.append((back, n))
    prints, counts = exact_dedup.merge(filters)
    assert Counter(dict(zip(prints.tolist(), counts.tolist()))) == Counter(np.concatenate(parts).tolist())
    for bits in (0, 1, 3):
        again = [exact_dedup.decode(*f, width - bits) for _, *f in exact_dedup._blocks(prints, counts, width, bits)]
        assert np.concatenate([n for _, n in again]).tolist() == counts.tolist()


# --- periodic runs


def runs_brute(w, least=12):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = q
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i - q, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, q, n) for (s, n), q in found.items())


def report_brute(doc_id, text, edit):
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if edit and w and h % 10 == 0:
        a, p = h // 10 % len(w), 1 + (len(w) - h // 10 % len(w)) // (3 + h // 10 % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    found = runs_brute(w)
    gone = {i for s, q, n in found for i in range(s + q, s + n)}
    best = min(((-n, s, q) for s, q, n in found), default=None)
    first = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(found), *first, sha("".join(f"{s},{n},{q}\n" for s, q, n in found).encode()),
            sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_runs_of_random_words():
    rng = np.random.default_rng(5)

    def words():
        w = rng.integers(0, rng.integers(1, 5), rng.integers(0, 220))
        if len(w) and rng.random() < 0.7:
            a = rng.integers(0, len(w))
            w = w[np.concatenate([np.arange(a), a + np.arange(len(w) - a) % (1 + rng.integers(0, max(1, (len(w) - a) // 2)))])]
            w[rng.integers(0, len(w))] = 9
        return np.concatenate([w, w]) if rng.random() < 0.2 else w

    for _ in range(150):
        texts = [words() for _ in range(rng.integers(1, 5))]
        starts = np.cumsum([0, *map(len, texts)])
        s, n, q = periodic_runs.find_runs(texthash.mix((np.concatenate(texts) + 1).astype(np.uint64)), starts)
        for k, w in enumerate(texts):
            own = (s >= starts[k]) & (s < starts[k + 1])
            assert [(int(a - starts[k]), int(c), int(b)) for a, b, c in zip(s[own], n[own], q[own])] == runs_brute(w.tolist())


@pytest.mark.parametrize("edit", [None, periodic_runs.planted])
def test_run_report(spark, make, edit):
    rows = [(r[0], r[1]) for r in ODD] + [(i, "a b " * i + "c " * (i % 17)) for i in range(100, 140)] + [(5, "a b c " * 9)] * 2
    got = periodic_runs.run_report(make(rows), edit=edit)
    assert Counter(tuple(r) for r in got.collect()) == Counter(report_brute(i, t, edit) for i, t in rows)
    table = common.documents(spark, SF_SMALL).where("length(text) < 6000")
    got = {tuple(r) for r in periodic_runs.run_report(table, edit=edit).collect()}
    assert got == {report_brute(r.doc_id, r.text, edit) for r in table.collect()}


def test_runs_of_long_texts_and_of_nothing(make):
    """A word repeated 300,000 times has one run, and so has a long text of a long period."""
    got = {r.doc_id: r for r in periodic_runs.run_report(make([(1, "x " * 300_000), (2, LONG), (3, "a " * 50_000 + "b " + "a " * 50_000)])).collect()}
    assert (got[1].n_runs, got[1].start, got[1].length, got[1].period) == (1, 0, 300_000, 1)
    assert (got[2].n_runs, got[2].length, got[2].period, got[2].exponent_milli) == (1, 160_000, 997, 160_481)
    assert (got[3].n_runs, got[3].start, got[3].length, got[3].period) == (2, 0, 50_000, 1)
    assert periodic_runs.run_report(make(ODD).limit(0)).collect() == []
    units = [tuple(r) for r in periodic_runs.runs(make([(1, "z " + "a b " * 8), (None, None), (2, "one two")])).collect()]
    assert units == [(1, 1, 16, 2, "a b")]


# --- spelling variants


def near_brute_words(counts):
    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(b) - len(a) > 1 or a == b:
            return False
        i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return a[i + (len(a) == len(b)):] == b[i + 1:]
    return {w: [x for x in counts if near(w, x)] for w in counts}


def variants_brute(counts, ratio=5):
    form, out = {}, set()
    near = near_brute_words(counts)
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] is not None else None))
    return out


def count_brute(rows, edit):
    found = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if edit and i is not None and h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def test_variants_of_random_words(spark):
    rng = np.random.default_rng(2)
    words = {"".join(rng.choice(list("abcé÷Ò"), rng.integers(1, 9))) for _ in range(700)} | {"", "日本語日本語", "日本語日本𝒳", "日本語本語"}
    counts = {w: int(5 ** rng.integers(0, 7) + rng.integers(0, 2)) for w in words}
    table = spark.createDataFrame([(w, n, "x") for w, n in counts.items()] + [(None, 3, "x"), ("null n", None, "x")], "word string, n long, root string")
    got = [tuple(r) for r in spelling_variants.variant_groups(table).collect()]
    assert len(got) == len(counts) and set(got) == variants_brute(counts)
    assert any(r[1] is not None and r[1] != r[2] for r in got)


def test_near_words_share_a_signature():
    rng = np.random.default_rng(8)
    letters = list("abcdefgéß")
    for _ in range(3000):
        w = "".join(rng.choice(letters, rng.integers(1, 14)))
        i = int(rng.integers(0, len(w)))
        swapped, shorter = w[:i] + str(rng.choice(letters)) + w[i + 1:], w[:i] + w[i + 1:]
        keys = lambda x, role: {(s, m) for r, m, s in spelling_variants.signatures(x) if r == role}
        def meet(a, ra, b, rb, most):
            return any(s == t and ((m ^ n) & (1 << 64) - 1).bit_count() <= most for s, m in keys(a, ra) for t, n in keys(b, rb))
        assert meet(w, 0, swapped, 0, 2) and meet(w, 1, shorter, 2, 1)


@pytest.mark.parametrize("edit", [None, spelling_variants.planted_edit])
def test_variants_of_documents(spark, make, edit):
    table = common.documents(spark, SF_SMALL)
    odd = [(r[0], r[1]) for r in ODD] + REPEATS + [(5, "Straße ÉTOILE étoile etoile " * 40), (None, "Wonderful wonderfull " * 90), (8, "wonderful" * 30_000)]
    for df, rows in ((table, [(r.doc_id, r.text) for r in table.collect()]), (make(odd), odd), (make(ODD).limit(0), [])):
        got = [tuple(r) for r in spelling_variants.spelling_variants(df, edit=edit).collect()]
        want = variants_brute(count_brute(rows, edit))
        assert len(got) == len(want) and set(got) == want


def test_no_table_of_words_is_broadcast(spark, monkeypatch):
    """Spark takes the 23 signatures of each word for a table as small as the words, and no join may go by that."""
    plans = []
    real = spelling_variants.stage

    def planned(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, name)
    monkeypatch.setattr(spelling_variants, "stage", planned)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") not in ("-1", "-1b")
    made = spelling_variants.variant_groups(spark.createDataFrame([("wonderful", 900), ("wonderfull", 30), ("wonderfulll", 6)], "word string, n long"))
    plans.append(made._jdf.queryExecution().executedPlan().toString())
    assert {tuple(r)[:3] for r in made.collect()} == {("wonderful", None, "wonderful"), ("wonderfull", "wonderful", "wonderful"),
                                                     ("wonderfulll", "wonderfull", "wonderful")}
    plans.append(made._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in p for p in plans) >= 5 and not any("Broadcast" in p for p in plans)


# --- rows without an id of their own


@pytest.fixture(scope="module")
def anonymous(make):
    """1,000 different texts without an id, and 1,000 under one id."""
    text = lambda k: " ".join(f"{k}x{j}" for j in range(40))
    return make([(None, text(i), f"src{i % 3}") for i in range(1000)] + [(5, text(2000 + i), f"src{i % 3}") for i in range(1000)]
                + [(5, text(7) + " end"), (None, text(2003) + " end")])


def test_rows_of_one_id_are_joined_by_row(anonymous, monkeypatch):
    """No stage of near-duplicate search or passage removal multiplies rows that share an id."""
    seen = Counter()
    real = common.stage

    def counting(df, name):
        out, path = real(df, name)
        seen[name] = max(seen[name], out.count())
        return out, path
    for module in (near_dedup, substring_dedup):
        monkeypatch.setattr(module, "stage", counting)
    got = near_dedup.near_duplicates(anonymous).collect()
    assert len(got) == 2002 and Counter(r.n_shingles for r in got) == {36: 2000, 37: 2}
    assert seen["sets"] <= 2002
    report = substring_dedup.removal_report(anonymous).collect()
    assert Counter(r.n_removed for r in report) == {0: 1998, 40: 4}
    assert seen["candidates"] <= 2002


def test_mix_takes_rows_of_one_id_apart(make):
    docs = make([(None, "a b c", "s1")] * 5 + [(None, "d e f", "s2")] * 40 + [(None, "x y", "s1"), (3, "a b", "s2"), (3, "a b c d", "s1"), (None, None, None)])
    mixed = mixing.mix(docs, mixing.word_count())
    key = lambda r: (r["doc_id"], r["source"])
    want, got = Counter(), Counter()
    for r in rows_of(mixed):
        want[key(r)] += r["taken"]
    for r in rows_of(mixing.materialise(docs, mixed)):
        got[key(r)] += len(r["text"].split())
    assert got == +want and set(mixing.materialise(docs, mixed).columns) == set(docs.columns)


def test_shards_are_written_row_by_row(spark, make, scratch):
    rows = [(None, "a"), (None, "a"), (None, "b"), (4, "c"), (4, "c"), (4, "d"), (5, None)] + [(i, f"text {i}") for i in range(10, 60)]
    sharding.write_shards(make(rows), f"{scratch}/shards", 3)
    back = spark.read.parquet(f"{scratch}/shards")
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter(rows) and set(back.columns) == {*make(rows).columns, "shard"}
