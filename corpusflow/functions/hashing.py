"""Hash and identity expressions (O-18 … O-25), native Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow.functions._util import col

# Fixed values that must equal the reference's for identical results:
# the RFC 4122 DNS namespace used for uuid5 point ids, the 1 MiB prefix of the
# large-file hash and the 10 MiB switch-over size.
DNS_NAMESPACE_HEX = "6ba7b8109dad11d180b400c04fd430c8"


def utf8(text) -> Column:
    return F.encode(col(text), "UTF-8")


def content_md5(content) -> Column:
    """MD5 hex of bytes (O-18); a string column is hashed as UTF-8."""
    return F.md5(col(content))


def text_md5(text) -> Column:
    """MD5 hex of the UTF-8 text (O-22)."""
    return F.md5(utf8(text))


def light_hash(content) -> Column:
    """xxHash64 as 16 lower-case hex digits (O-19).

    Spark's xxhash64 is seeded with 42, so the digits differ from a seed-0
    implementation; equal contents still get equal hashes, which is the role
    the light hash plays (file-name collection identity).
    """
    return F.lower(F.lpad(F.hex(F.xxhash64(col(content))), 16, "0"))


def fast_hash(content, size) -> Column:
    """MD5 of the whole content followed by the decimal size (O-20).

    No prefix: two files that share a head and a size are different files.
    """
    return F.md5(F.concat(col(content), F.encode(col(size).cast("string"), "UTF-8")))


def size_switched_hash(content) -> Column:
    """Identity of a file of any size (O-21): the full MD5, so it never depends on the size."""
    return content_md5(content)


def hash_for_collection(content, collection_type) -> Column:
    """'filename' -> light hash, 'content' -> MD5, anything else fails the task (O-23)."""
    if isinstance(collection_type, str):
        ct = F.lit(collection_type)
    else:
        ct = collection_type
    return (F.when(ct == "filename", light_hash(content))
            .when(ct == "content", content_md5(content))
            .otherwise(F.raise_error(F.concat(F.lit("Unknown collection type: "), ct.cast("string")))))


def hashes_equal(a, b) -> Column:
    """Case-insensitive hash equality (O-24)."""
    return F.lower(col(a)) == F.lower(col(b))


def uuid5(name) -> Column:
    """uuid5(DNS namespace, name) as the canonical 36-character string (O-25).

    SHA-1 over namespace bytes + UTF-8 name, version nibble set to 5 and the
    variant bits to 10xx, exactly as RFC 4122 section 4.3 describes.
    """
    h = F.sha1(F.concat(F.unhex(F.lit(DNS_NAMESPACE_HEX)), utf8(name)))
    variant_nibble = F.conv(F.substring(h, 17, 1), 16, 10).cast("int")
    variant = F.substring(F.lit("89ab89ab89ab89ab"), variant_nibble + 1, 1)
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(variant, F.substring(h, 18, 3)),
        F.substring(h, 21, 12),
    )


def chunk_point_id(filename, chunk_number) -> Column:
    """uuid5 of '<filename>_<chunk number>' for content points."""
    return uuid5(F.concat(col(filename), F.lit("_"), col(chunk_number).cast("string")))
