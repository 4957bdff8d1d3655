"""The registered queries of this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusflow.llm import (
    exact_dedup,
    fingerprints,
    license_scan,
    mixing,
    near_dedup,
    packing,
    periodic_runs,
    quality_classifier,
    quality_rules,
    sharding,
    spelling_variants,
    substring_dedup,
    token_counts,
)
from corpusflow.llm.common import documents, stage_path

#: name -> (query, DuckDB SQL or None)
REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return add


@query("op1_mixing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by words to weights 1, 2, 3, ... of their sources, three epochs at most."""
    return mixing.mix(documents(spark, sf_dir), mixing.word_count()).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "weight", "repeats")


@query("op2_quality_classifier")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learnt from the labels that are not held out."""
    return quality_classifier.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query("op3_license_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence sentences and licences of all documents."""
    return license_scan.scan(documents(spark, sf_dir))


@query("op4_best_fit_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return packing.packed_documents(documents(spark, sf_dir))


@query("op5_minhash_near_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents; checked against all pairs in tests/llm."""
    return near_dedup.near_duplicates(documents(spark, sf_dir))


@query("op6_sharding")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes."""
    return sharding.shard(documents(spark, sf_dir))


@query("op7_substring_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text without its repeated 35-word windows."""
    return substring_dedup.removal_report(documents(spark, sf_dir))


@query("op8_quality_rules")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak-supervision verdicts on all documents."""
    return quality_rules.judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


@query("op9_document_fingerprints")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of all documents, against their edited texts and the next documents."""
    return fingerprints.edited_likeness(documents(spark, sf_dir))


@query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as flat token files and counted from these."""
    return token_counts.document_counts(spark, documents(spark, sf_dir), stage_path(spark, "token-files"))


OP11_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept,
       sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm)
"""


@query("op11_exact_dedup", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts of all documents, equal up to white space."""
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


# CRC-32 of a list of bytes: the table follows from the polynomial 0xEDB88320 in eight steps an entry.
_CRC = """
steps(i, k, c) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8),
crc(t) AS (SELECT list(c ORDER BY i) FROM steps WHERE k = 8)"""
_CRC_OF = "xor(list_reduce({bytes}, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295)"

OP12_SQL = rf"""
WITH RECURSIVE {_CRC},
w0 AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
hashed AS (
  SELECT doc_id, w, len(w) AS n, {_CRC_OF.format(bytes="list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)")} AS h
  FROM w0, crc),
planted AS (
  SELECT doc_id, n, w, h % 10 = 0 AND n > 0 AS edit, CASE WHEN n > 0 THEN (h // 10) % n ELSE 0 END AS a, 3 + (h // 10) % 8 AS r FROM hashed),
w1 AS (
  SELECT doc_id, CASE WHEN edit THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1]
    ELSE w[a + (i - a) % (1 + (n - a) // r) + 1] END) ELSE w END AS w FROM planted),
one AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM w1),
-- a run has at least six equal pairs in a row, so each cell of it lies in an equal pair of six words
six AS (
  SELECT doc_id, i, hash(word, lead(word, 1) OVER p, lead(word, 2) OVER p, lead(word, 3) OVER p, lead(word, 4) OVER p, lead(word, 5) OVER p) AS g,
         lead(word, 5) OVER p IS NOT NULL AS whole
  FROM one WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
cells AS (
  SELECT b.doc_id, b.i - a.i AS d, b.i AS i FROM six a JOIN six b ON a.doc_id = b.doc_id AND a.g = b.g AND a.i < b.i AND a.whole AND b.whole),
isles AS (SELECT doc_id, d, i, i - row_number() OVER (PARTITION BY doc_id, d ORDER BY i) AS isle FROM cells),
found AS (
  SELECT doc_id, min(i) - d AS start, count(*) + 5 + d AS length, min(d) OVER (PARTITION BY doc_id, min(i) - d, count(*) + 5 + d) AS least, d
  FROM isles GROUP BY doc_id, d, isle HAVING count(*) + 5 >= greatest(d, 12 - d)),
runs AS (SELECT doc_id, start::BIGINT AS start, length::BIGINT AS length, d::BIGINT AS period FROM found WHERE d = least),
told AS (
  SELECT doc_id, count(*) AS n_runs, arg_max({{'s': start, 'l': length, 'p': period}}, (length, -start, -period)) AS best,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY doc_id),
dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
left_over AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM one ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.p AS period, 1000 * best.l // best.p AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM documents LEFT JOIN told USING (doc_id) LEFT JOIN left_over USING (doc_id)
"""


@query("op12_periodic_runs", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal periodic runs of all documents, after the stated edit of one in ten."""
    return periodic_runs.run_report(documents(spark, sf_dir), edit=periodic_runs.planted)


OP13_SQL = f"""
WITH RECURSIVE {_CRC},
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[a-zÀ-ÿ]+')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL),
bytes AS (
  SELECT run, n, list_transform(range(len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT) AS b
  FROM (SELECT run, n, hex(encode(doc_id || ':' || run)) AS x FROM counted)),
hashed AS (SELECT run, n, {_CRC_OF.format(bytes="b")} AS h FROM bytes, crc),
edited AS (
  SELECT CASE WHEN h % 199 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM edited WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
-- every word without one of its code points
cuts AS (
  SELECT word, n, i, substring(word, 1, i) || substring(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS m FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT c.word, w.word, w.n FROM cuts c JOIN words w ON c.rest = w.word
  UNION
  SELECT w.word, c.word, c.n FROM cuts c JOIN words w ON c.rest = w.word),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, encode(other)) AS other, max(m) AS m FROM pairs GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * w.n THEN other END AS form, CASE WHEN m >= 5 * w.n THEN m END AS form_n
  FROM words w LEFT JOIN best USING (word)),
chain(word, reached) AS (
  SELECT word, word FROM words
  UNION
  SELECT c.word, f.form FROM chain c JOIN formed f ON c.reached = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.reached AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c USING (word) JOIN formed z ON c.reached = z.word WHERE z.form IS NULL
"""


@query("op13_spelling_variants", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents, after the stated edit of one run in 199."""
    return spelling_variants.spelling_variants(documents(spark, sf_dir), edit=spelling_variants.planted_edit)
