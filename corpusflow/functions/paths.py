"""Object-key expressions (O-06 … O-11), all native Column expressions.

Keys are '/'-separated object-store keys. Name, stem and suffix follow the
usual path rules: the suffix is the last '.xxx' of the name provided the name
has at least one character before that dot ('.DS_Store' has no suffix).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow.functions._util import col


def basename(key) -> Column:
    """Last path component."""
    return F.element_at(F.split(col(key), "/"), -1)


def suffix(key) -> Column:
    """Last extension including the dot, '' when there is none."""
    return F.regexp_extract(basename(key), r"^.+(\.[^.]+)$", 1)


def stem(key) -> Column:
    """Name without its last extension."""
    return F.regexp_replace(basename(key), r"^(.+)\.[^.]+$", "$1")


def depth(key) -> Column:
    """Number of '/' separated components minus one."""
    return (F.size(F.split(col(key), "/")) - 1).cast("int")


def top_directory(key) -> Column:
    """Second component when the key has more than two, else null."""
    parts = F.split(col(key), "/")
    return F.when(F.size(parts) > 2, F.element_at(parts, 2))


def skip_by_extension(key, extensions: Iterable[str]) -> Column:
    """True when the name ends with any configured suffix (case-sensitive).

    An empty list skips nothing, as in the reference.
    """
    exts = [e.strip() for e in extensions if e and e.strip()]
    if not exts:
        return F.lit(False)
    name = basename(key)
    cond = F.lit(False)
    for e in exts:
        cond = cond | name.endswith(e)
    return cond


def is_markdown(key) -> Column:
    """Lower-cased key ends with '.md' ('.MD' yes, '.markdown' no)."""
    return F.lower(col(key)).endswith(".md")


def _norm_prefix(prefix: str) -> str:
    return prefix.rstrip("/") + "/"


def mirrored_key(key, source_prefix: str = "source", target_prefix: str = "markdown",
                 new_suffix: str = ".md") -> Column:
    """source/a/b.pdf -> markdown/a/b.md.

    Strip the source prefix if present, replace the last extension of the name
    (or append when there is none) and prepend the target prefix.
    """
    src = _norm_prefix(source_prefix)
    dst = _norm_prefix(target_prefix)
    k = col(key)
    relative = F.when(k.startswith(src), F.substring(k, len(src) + 1, 1 << 30)).otherwise(k)
    parent = F.regexp_extract(relative, r"^(.*/)[^/]*$", 1)
    return F.concat(F.lit(dst), parent, stem(relative), F.lit(new_suffix))


def original_name(markdown_key, default_suffix: str = ".pdf") -> Column:
    """markdown/x/f.md -> stem; a stem without '.' gets the default suffix."""
    s = stem(markdown_key)
    return F.when(s.contains("."), s).otherwise(F.concat(s, F.lit(default_suffix)))


def with_prefix(key, prefix: str) -> Column:
    """Prefix filter of the listing (O-02)."""
    return col(key).startswith(prefix)
