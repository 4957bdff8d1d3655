"""Stored listings: what has changed since the last one, and bytes of changed keys only (O-01, O-03, O-40).

A snapshot is a run of a ``RunStore``, table ``listing``: ``key, size,
last_modified, etag``. The next listing is compared with the latest snapshot by one
full join on the key. Size and time decide, and the etag where both listings have
one, so no byte of an unchanged object is read, and its etag is carried over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.sources.listing import content_of, list_objects
from corpusflow.sources.run_store import RunStore, _fields, conform_to

LISTING = "key string, size long, last_modified timestamp, etag string"


def latest(store: RunStore) -> DataFrame:
    """The listing of the latest run; empty before the first."""
    last = store.manifests().agg(F.max_by("run", "seq").alias("run"))
    return store.table("listing", _fields(LISTING)).join(last, "run", "left_semi").select(*_fields(LISTING).names)


def changes(before: DataFrame, now: DataFrame) -> DataFrame:
    """``key, state, size, last_modified, etag`` of every key of either listing.

    ``state`` is ``new``, ``changed``, ``same`` or ``removed``. Two entries differ if their size, their time or, where
    both are known, their etag does. A key that is unchanged keeps the etag it had. Removed keys have their last
    entry. Keys must be unique within a listing; rows without a key are left out.
    """
    b, n = (df.where("key is not null").select("key", F.struct("size", "last_modified", "etag").alias(name))
            for df, name in ((before, "b"), (now, "n")))
    differs = ~F.col("b.size").eqNullSafe(F.col("n.size")) | ~F.col("b.last_modified").eqNullSafe(F.col("n.last_modified"))
    differs = differs | F.coalesce(F.lower("b.etag") != F.lower("n.etag"), F.lit(False))
    state = (F.when(F.col("b").isNull(), "new").when(F.col("n").isNull(), "removed").when(differs, "changed").otherwise("same"))
    entry = F.coalesce("n", "b")
    etag = F.when(F.col("state") == "same", F.coalesce("n.etag", "b.etag")).otherwise(entry["etag"])
    return b.join(n, "key", "full").withColumn("state", state).select(
        "key", "state", entry["size"].alias("size"), entry["last_modified"].alias("last_modified"), etag.alias("etag"))


def record(store: RunStore, now: DataFrame, run_id: str | None = None) -> DataFrame | None:
    """Compare a listing with the latest snapshot and make it the latest; the changes, or None if ``run_id`` already counts.

    The changes are a table of the run, and so is the listing; both count once the run does.
    """
    run = store.begin(run_id)
    if run is None:
        return None
    found = store.write(run, "listing_changes", changes(latest(store), conform_to(now, _fields(LISTING))))
    store.write(run, "listing", found.where("state <> 'removed'").drop("state"))
    store.commit(run)
    return found


def refresh(store: RunStore, root: str, run_id: str | None = None, glob: str | None = None) -> DataFrame | None:
    """List ``root``, read the objects that are new or changed, and record the listing with their etags (the MD5 of the bytes).

    ``key, state, size, last_modified, etag``; None if ``run_id`` already counts.
    """
    run = store.begin(run_id)
    if run is None:
        return None
    listed = conform_to(list_objects(store.spark, root, glob=glob), _fields(LISTING))
    found = store.write(run, "listing_compared", changes(latest(store), listed))
    read = content_of(store.spark, root, found.where("state in ('new', 'changed')"), glob=glob).select("key", F.md5("content").alias("md5"))
    found = store.write(run, "listing_changes", found.join(read, "key", "left").withColumn("etag", F.coalesce("md5", "etag")).drop("md5"))
    store.write(run, "listing", found.where("state <> 'removed'").drop("state"))
    store.commit(run)
    return found
