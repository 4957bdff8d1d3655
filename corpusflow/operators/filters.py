"""Payload filters and payload typing (O-72 … O-80).

Filters are Column predicates, so they reach the Parquet scan
(``PushedFilters``) whenever the column is stored flat. Text and phrase
matches that need an index are joins against token tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions import text as TX
from corpusflow.functions._util import col


def match(field, value) -> Column:
    """Exact match (O-72)."""
    return col(field) == F.lit(value)


def match_any(field, values) -> Column:
    """Field in a literal list (O-73)."""
    return col(field).isin(list(values))


def match_any_table(df: DataFrame, field: str, values: DataFrame, value_col: str) -> DataFrame:
    """Field in a value table of any length: a semi join (O-73)."""
    return df.join(values.select(F.col(value_col).alias(field)).distinct(), field, "left_semi")


def match_text(field, query: str, mode: str = "word", lowercase: bool = True,
               min_len: int = 1, max_len: int | None = None) -> Column:
    """All query tokens are tokens of the field (O-74); one outside the bounds matches nothing."""
    import regex
    qt = regex.findall(TX.WORD_PATTERN, query)
    qt = [t.lower() if lowercase else t for t in qt]
    if mode == "prefix":
        ft = TX.prefix_tokens(field, min_len, max_len)
    else:
        ft = TX.normalise_tokens(TX.word_tokens(field), min_len, max_len, lowercase)
    if not qt or any(len(t) < min_len or (max_len is not None and len(t) > max_len) for t in qt):
        return F.lit(False)
    cond = F.lit(True)
    for t in dict.fromkeys(qt):
        cond = cond & F.array_contains(ft, t)
    return cond


def phrase_match(df: DataFrame, field: str, phrase: str, id_col: str, lowercase: bool = True) -> DataFrame:
    """Rows whose field holds the phrase's tokens consecutively (O-75).

    Token positions are joined to the phrase's (token, offset) table (tiny,
    broadcast); a match is a start position where every offset lines up.
    """
    import regex
    words = [w.lower() if lowercase else w for w in regex.findall(TX.WORD_PATTERN, phrase)]
    if not words:
        return df.limit(0)
    spark = df.sparkSession
    ph = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "token string, offset int")
    toks = TX.word_tokens(field)
    if lowercase:
        toks = F.transform(toks, lambda t: F.lower(t))
    pos = df.select(id_col, F.posexplode(toks).alias("pos", "token"))
    hits = (pos.join(F.broadcast(ph), "token")
            .groupBy(id_col, (F.col("pos") - F.col("offset")).alias("start"))
            .agg(F.countDistinct("offset").alias("n"))
            .where(F.col("n") == len(words))
            .select(id_col).distinct())
    return df.join(hits, id_col, "left_semi")


def range_filter(field, gte=None, lte=None, gt=None, lt=None) -> Column:
    """gte/lte/gt/lt on numbers or timestamps (O-76)."""
    c = col(field)
    cond = F.lit(True)
    if gte is not None:
        cond = cond & (c >= F.lit(gte))
    if lte is not None:
        cond = cond & (c <= F.lit(lte))
    if gt is not None:
        cond = cond & (c > F.lit(gt))
    if lt is not None:
        cond = cond & (c < F.lit(lt))
    return cond


EARTH_RADIUS_M = 6371008.8


def haversine_m(lon1, lat1, lon2, lat2) -> Column:
    rl1, rl2 = F.radians(col(lat1)), F.radians(col(lat2))
    dlat = rl2 - rl1
    dlon = F.radians(col(lon2)) - F.radians(col(lon1))
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(rl1) * F.cos(rl2) * F.pow(F.sin(dlon / 2), 2)
    return 2 * EARTH_RADIUS_M * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def geo_radius(lon_col, lat_col, lon: float, lat: float, radius_m: float) -> Column:
    """Within ``radius_m`` of (lon, lat) (O-77); a latitude band pre-filter
    (pushable to the scan) precedes the exact great-circle test."""
    import math
    dlat = math.degrees(radius_m / EARTH_RADIUS_M)
    band = (col(lat_col) >= lat - dlat) & (col(lat_col) <= lat + dlat)
    return band & (haversine_m(lon_col, lat_col, F.lit(lon), F.lit(lat)) <= radius_m)


def geo_bbox(lon_col, lat_col, top_left: tuple[float, float], bottom_right: tuple[float, float]) -> Column:
    (lon1, lat1), (lon2, lat2) = top_left, bottom_right
    return (col(lon_col).between(lon1, lon2)) & (col(lat_col).between(lat2, lat1))


# ---- payload typing ----

# Index kinds, the field types each accepts and their options.
INDEX_KINDS = [
    ("keyword", "str", "is_tenant,on_disk"),
    ("integer", "int", "is_principal,on_disk"),
    ("float", "float", "is_principal,on_disk"),
    ("bool", "bool", "on_disk"),
    ("geo", "dict", "on_disk"),
    ("datetime", "str", "on_disk"),
    ("uuid", "str", "on_disk"),
    ("text", "str", "tokenizer,min_token_len,max_token_len,lowercase,phrase_matching,on_disk"),
]
UUID_PATTERN = r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$"
RFC3339_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?([Zz]|[+-][0-9]{2}:[0-9]{2})?$"


def _is_geo(dt: T.DataType) -> bool:
    return isinstance(dt, T.StructType) and {"lon", "lat"} <= set(dt.fieldNames())


def leaf_paths(schema: T.StructType, prefix: str = "") -> list[tuple[str, T.DataType]]:
    """Dotted leaf paths; geo structs ({lon, lat}) stay leaves."""
    out = []
    for f in schema.fields:
        p = f"{prefix}.{f.name}" if prefix else f.name
        if isinstance(f.dataType, T.StructType) and not _is_geo(f.dataType):
            out += leaf_paths(f.dataType, p)
        else:
            out.append((p, f.dataType))
    return out


def _python_type(dt: T.DataType) -> str:
    if _is_geo(dt) or isinstance(dt, (T.StructType, T.MapType)):
        return "dict"
    if isinstance(dt, T.BooleanType):
        return "bool"
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "int"
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "float"
    if isinstance(dt, T.ArrayType):
        return "list"
    return "str"


def value_type(c: Column, dt: T.DataType) -> Column:
    """Suggested index kind of one value (O-79): geo, uuid, datetime, then by type."""
    pt = _python_type(dt)
    if pt == "dict":
        return F.lit("geo") if _is_geo(dt) else F.lit("keyword")
    if pt in ("int", "float", "bool"):
        return F.lit({"int": "integer", "float": "float", "bool": "bool"}[pt])
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.lit("datetime")
    s = c.cast("string")
    return (F.when(s.rlike(UUID_PATTERN), "uuid")
            .when(s.rlike(RFC3339_PATTERN), "datetime")
            .otherwise("keyword"))


def payload_profile(df: DataFrame, exclude: tuple[str, ...] = ("vector",), sample_len: int = 50) -> DataFrame:
    """Per leaf path: type, suggested index, non-null count, sample (O-78, O-79).

    The suggestion is the most frequent per-value kind over the whole table
    (ties by name); the sample is the smallest value, cut to ``sample_len``
    characters + '...'. One aggregation pass for all paths.
    """
    leaves = [(p, dt) for p, dt in leaf_paths(df.schema) if p.split(".")[0] not in exclude]
    rows = []
    for i, (p, dt) in enumerate(leaves):
        c = F.col(p)
        s = F.to_json(c) if isinstance(dt, (T.StructType, T.ArrayType, T.MapType)) else c.cast("string")
        rows.append(F.struct(F.lit(p).alias("path"), F.lit(_python_type(dt)).alias("type"),
                             value_type(c, dt).alias("kind"), s.alias("sval")))
    exploded = df.select(F.explode(F.array(*rows)).alias("r")).select("r.*").where(F.col("sval").isNotNull())
    kinds = exploded.groupBy("path", "type", "kind").agg(F.count(F.lit(1)).alias("n_kind"))
    best = kinds.groupBy("path", "type").agg(
        F.min_by("kind", F.struct(-F.col("n_kind"), F.col("kind"))).alias("suggested_index"),
        F.sum("n_kind").cast("bigint").alias("non_null"))
    samples = exploded.groupBy("path").agg(F.min("sval").alias("__s"))
    out = best.join(samples, "path")
    return out.select("path", "type", "suggested_index", "non_null",
                      F.when(F.length("__s") > sample_len, F.concat(F.substring("__s", 1, sample_len), F.lit("...")))
                      .otherwise(F.col("__s")).alias("sample"))


def index_kinds(spark) -> DataFrame:
    return spark.createDataFrame(INDEX_KINDS, "index_kind string, python_type string, options string")


def compatible_indexes(profile: DataFrame) -> DataFrame:
    """Field paths joined to the index kinds their type accepts (O-80)."""
    kinds = index_kinds(profile.sparkSession)
    return profile.join(F.broadcast(kinds), profile["type"] == kinds["python_type"]).select(
        "path", "type", "suggested_index", "index_kind", "options",
        (F.col("index_kind") == F.col("suggested_index")).alias("is_suggested"))
