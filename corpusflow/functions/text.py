"""Text expressions: token counting, element types, tokenizers (O-11, O-26, O-30, O-33 … O-37).

Everything is a native Column expression so it stays inside the JVM; regexes
are written so Java (Spark) and RE2 (the DuckDB oracle) read them the same way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow.functions._util import col

# Default token counter: runs of letters/digits, and every other
# non-whitespace character on its own. The reference counts BPE tokens with a
# vocabulary that is not available offline; the counter is a parameter.
TOKEN_PATTERN = r"[\p{L}\p{N}]+|[^ \t\n\r\f\p{L}\p{N}]"
WORD_PATTERN = r"[\p{L}\p{N}]+"
# Whitespace removed at chunk boundaries.
STRIP_CLASS = r"[ \t\n\r\f]"


def token_count(text, pattern: str = TOKEN_PATTERN) -> Column:
    """Number of tokens (O-26)."""
    return F.regexp_count(col(text), F.lit(pattern)).cast("int")


def strip_ws(text) -> Column:
    """Remove [ \t\n\r\f] at both ends."""
    return F.btrim(col(text), F.lit(" \t\n\r\f"))


def remove_ws(text) -> Column:
    return F.regexp_replace(col(text), STRIP_CLASS, "")


# Element-type labels and the markdown cues that select them, in
# the reference's order of precedence (Table, Image, Code, List, else Text).
ELEMENT_TYPES = ("Table", "Image", "Code", "List", "Text")
IMAGE_PATTERN = r"(?d)!\[.*?\]\(.*?\)"
LIST_BULLET_PATTERN = r"(?md)^[ \t\n\r\f]*[-*+][ \t\n\r\f]"
LIST_NUMBER_PATTERN = r"(?md)^[ \t\n\r\f]*[0-9]+\.[ \t\n\r\f]"


def element_type(text) -> Column:
    """First matching markdown element type of a chunk (O-30)."""
    t = col(text)
    return (
        F.when(t.contains("|") & (t.contains("---") | t.contains("|-")), F.lit("Table"))
        .when(t.rlike(IMAGE_PATTERN), F.lit("Image"))
        .when(t.contains("```"), F.lit("Code"))
        .when(t.rlike(LIST_BULLET_PATTERN) | t.rlike(LIST_NUMBER_PATTERN), F.lit("List"))
        .otherwise(F.lit("Text"))
    )


def decode_with_fallback(content) -> Column:
    """UTF-8 when the bytes are valid UTF-8, else Latin-1 (O-11)."""
    c = col(content)
    utf8_text = F.try_validate_utf8(c.cast("string"))
    return F.coalesce(utf8_text, F.decode(c, "ISO-8859-1"))


# ---- tokenizers of the text index (O-33 … O-37) ----

def word_tokens(text) -> Column:
    """Split at spaces and punctuation (the 'word' tokenizer)."""
    return F.regexp_extract_all(col(text), F.lit(WORD_PATTERN), 0)


def whitespace_tokens(text) -> Column:
    """Split at whitespace, punctuation kept."""
    return F.filter(F.split(col(text), r"[ \t\n\r\f]+"), lambda x: x != "")


def prefix_tokens(text, min_len: int = 1, max_len: int | None = None) -> Column:
    """All prefixes (within the length bounds; none above by default) of each lower-cased word token."""
    toks = F.filter(F.transform(word_tokens(text), lambda t: F.lower(t)), lambda t: F.length(t) >= min_len)
    return F.flatten(F.transform(
        toks,
        lambda t: F.transform(
            F.sequence(F.lit(min_len), F.length(t) if max_len is None else F.least(F.length(t), F.lit(max_len))),
            lambda i: F.substr(t, F.lit(1), i),
        ),
    ))


# Script-aware split: runs of CJK ideographs, kana runs, Hangul runs and
# runs of any other letters/digits, so a change of script is a boundary. No
# dictionary segmentation inside a run.
MULTILINGUAL_PATTERN = (
    r"\p{IsHan}+|[\p{IsHiragana}\p{IsKatakana}]+|\p{IsHangul}+"
    r"|[\p{L}\p{N}&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]]+"
)


def multilingual_tokens(text) -> Column:
    return F.regexp_extract_all(col(text), F.lit(MULTILINGUAL_PATTERN), 0)


def normalise_tokens(tokens, min_len: int = 1, max_len: int | None = None, lowercase: bool = True) -> Column:
    """Lower-case and keep tokens with min_len <= length <= max_len (O-37); no upper bound by default."""
    t = col(tokens)
    if lowercase:
        t = F.transform(t, lambda x: F.lower(x))
    return F.filter(t, lambda x: F.length(x) >= min_len if max_len is None else F.length(x).between(min_len, max_len))


TOKENIZERS = {
    "word": word_tokens,
    "whitespace": whitespace_tokens,
    "prefix": prefix_tokens,
    "multilingual": multilingual_tokens,
}
