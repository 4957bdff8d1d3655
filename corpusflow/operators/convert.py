"""Document conversion re-aimed as a Spark job (O-15).

The reference uploads each file to a remote converter. Here conversion is a
column transformation over a table of documents:

* ``html_to_markdown`` — a built-in chain of native ``regexp_replace`` steps
  for web pages (scripts, styles and comments removed; headings, list items,
  paragraphs, line breaks and table cells mapped to markdown; remaining tags
  dropped; common entities decoded). Each step is also valid RE2, so the
  same chain runs in the DuckDB oracle.
* ``convert_with`` — any other converter plugs in as a function
  ``(bytes, name) -> (markdown | None, error | None)`` run by ``mapInArrow``.

An empty result is a failure with stage ``docling`` (the reference's name for
the conversion stage).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions._util import col
from corpusflow.operators.chunking import slices

# The conversion steps in order (pattern, replacement).
HTML_STEPS: list[tuple[str, str]] = [
    (r"(?is)<script[^>]*>.*?</script>", ""),
    (r"(?is)<style[^>]*>.*?</style>", ""),
    (r"(?s)<!--.*?-->", ""),
    (r"(?i)<h1[^>]*>", "\n# "),
    (r"(?i)<h2[^>]*>", "\n## "),
    (r"(?i)<h3[^>]*>", "\n### "),
    (r"(?i)<h4[^>]*>", "\n#### "),
    (r"(?i)<h5[^>]*>", "\n##### "),
    (r"(?i)<h6[^>]*>", "\n###### "),
    (r"(?i)</h[1-6]>", "\n\n"),
    (r"(?i)<br[ \t\n\r\f]*/?>", "\n"),
    (r"(?i)<li[^>]*>", "\n- "),
    (r"(?i)</p>", "\n\n"),
    (r"(?i)</(div|tr|ul|ol|table|article|section|nav|header|footer)>", "\n"),
    (r"(?i)</t[dh]>", " | "),
    (r"<[^>]+>", ""),
    (r"&lt;", "<"),
    (r"&gt;", ">"),
    (r"&quot;", "\""),
    (r"&#39;", "'"),
    (r"&nbsp;", " "),
    (r"&amp;", "&"),
    (r"[ \t]+\n", "\n"),
    (r"\n{3,}", "\n\n"),
    (r"^[ \t\n\r\f]+|[ \t\n\r\f]+$", ""),
]


def html_to_markdown(html) -> Column:
    out = col(html)
    for pat, rep in HTML_STEPS:
        out = F.regexp_replace(out, pat, rep)
    return out


def convert_pages(pages: DataFrame, html_col: str = "html", id_cols: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """id columns, markdown (null when empty) and error."""
    from corpusflow.operators.chunking import ensure_parallelism
    pages = ensure_parallelism(pages)
    md = html_to_markdown(html_col)
    return pages.select(*id_cols, F.when(md != "", md).alias("markdown"),
                        F.when(md == "", F.lit("empty conversion")).alias("error"))


ConvertFn = Callable[[bytes, str], tuple]


def convert_with(df: DataFrame, fn: ConvertFn, content_col: str = "content", name_col: str = "key",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """Run a plug-in converter over Arrow batches; exceptions become row errors."""
    keep = tuple(c for c in keep if c not in (content_col, name_col))
    schema = df.select(*keep, name_col).schema
    out_schema = T.StructType(list(schema.fields) + [
        T.StructField("markdown", T.StringType(), True), T.StructField("error", T.StringType(), True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content, names = batch.column(batch.num_columns - 1), batch.column(batch.num_columns - 2)
            for a, b in slices(content):
                mds, errs = [], []
                for c, n in zip(content.slice(a, b - a).to_pylist(), names.slice(a, b - a).to_pylist()):
                    try:
                        m, e = fn(c, n)
                    except Exception as ex:  # noqa: BLE001
                        m, e = None, f"{type(ex).__name__}: {ex}"
                    if not m and e is None:
                        e = "empty conversion"
                    mds.append(m or None)
                    errs.append(e)
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(a, b - a) for i in range(batch.num_columns - 1)),
                                                  pa.array(mds, pa.string()), pa.array(errs, pa.string())], names=out_schema.names)

    return df.select(*keep, name_col, content_col).mapInArrow(run, out_schema)


def failed_rows(converted: DataFrame, filename_col: str, hash_col: str | None = None,
                stage: str = "docling") -> DataFrame:
    """Failed-ledger rows for conversions without output."""
    h = F.col(hash_col) if hash_col else F.lit(None).cast("string")
    return converted.where(F.col("markdown").isNull()).select(
        F.col(filename_col).alias("filename"), h.alias("hash"),
        F.current_timestamp().alias("datetime"), F.col("error"), F.lit(stage).alias("stage"))
