"""A store whose tables grow by whole runs (O-12, O-17, O-62, O-65).

Under ``root`` every table is a folder of appended run folders, ``<table>/run=<id>/``.
A run writes its rows to all the tables it has rows for and, last of all, its manifest
``_runs/run=<id>/``. Readers join with the manifests, so a run that was lost before
its manifest is in no table: it counts wholly or not at all. Writing a run again under
the same id replaces its folders, and a run that has its manifest is not written
again, so a retried micro-batch changes nothing. One writer at a time is assumed, as
for any set of append-only ledgers.

Points are appended, never rewritten. The table ``files`` says which files a run
wrote to which collection; a file's points are those of the latest run that wrote it,
so a file that got shorter keeps none of its old chunks, and a run costs as much as its
own rows whatever the collection holds.

Points and markdown are by far the largest rows. They are joined, and so exchanged, only
where small columns have shown that some of them are to go.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.session import remove_path, scratch_path, write_table
from corpusflow.sources import collections as C
from corpusflow.sources.ledgers import SCHEMAS, _exists, conform

_RUN_ID = re.compile(r"^[A-Za-z0-9_.-]{1,200}$")

POINTS = ("id string, vector array<float>, pagecontent string, filename string, page_number int, element_type string, "
          "md5_hash string, file_hash string, file string")
FILES = "collection_name string, file string, file_hash string, n_points long"
MARKDOWN = "key string, markdown_key string, hash string, text string, error string"
MANIFEST = "seq long, finished timestamp, n_files long, n_processed long, n_skipped long, n_failed long"


@dataclass(frozen=True)
class Run:
    """A run under way: its id, its place among the runs, and its start."""

    id: str
    seq: int


class RunStore:
    """The ledgers, markdown and collections under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # --- runs

    def manifests(self) -> DataFrame:
        """``run, seq, finished, n_files, n_processed, n_skipped, n_failed`` of the runs that count."""
        return self._folder("_runs", _fields(MANIFEST))

    def begin(self, run_id: str | None = None) -> Run | None:
        """A new run, or None if ``run_id`` already counts."""
        run_id = run_id or uuid.uuid4().hex
        if not _RUN_ID.match(run_id):
            raise ValueError(f"invalid run id: {run_id!r}")
        last = self.manifests().agg(F.max("seq"), F.max(F.col("run") == run_id)).first()
        return None if last[1] else Run(run_id, (last[0] or 0) + 1)

    def commit(self, run: Run, n_files: int = 0, n_processed: int = 0, n_skipped: int = 0, n_failed: int = 0) -> None:
        """Write the manifest: from now on the run's rows are in all tables."""
        row = self.spark.createDataFrame([(run.seq, n_files, n_processed, n_skipped, n_failed)],
                                         "seq long, n_files long, n_processed long, n_skipped long, n_failed long")
        conform_to(row.withColumn("finished", F.current_timestamp()), _fields(MANIFEST)).coalesce(1).write.mode("overwrite").parquet(
            f"{self.root}/_runs/run={run.id}")

    # --- tables

    def write(self, run: Run, table: str, rows: DataFrame) -> DataFrame:
        """Write the run's rows of a table, in place of any the run wrote before; the rows as read back."""
        path = f"{self.root}/{table}/run={run.id}"
        write_table(rows, path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _folder(self, table: str, schema: T.StructType) -> DataFrame:
        path = f"{self.root}/{table}"
        schema = T.StructType([*schema.fields, T.StructField("run", T.StringType())])
        if not _exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def table(self, table: str, schema: T.StructType) -> DataFrame:
        """All rows of the runs that count, with ``run`` and ``seq``."""
        return self._folder(table, schema).join(self.manifests().select("run", "seq"), "run")

    def write_ledger(self, run: Run, name: str, rows: DataFrame) -> None:
        self.write(run, f"ledger_{name}", conform(rows, name))

    def ledger(self, name: str) -> DataFrame:
        """A ledger with ``run`` and ``seq``."""
        return self.table(f"ledger_{name}", SCHEMAS[name])

    # --- markdown

    def markdown(self) -> DataFrame:
        """``key, markdown_key, hash, text``: the latest conversion of each key."""
        rows = self.table("markdown", _fields(MARKDOWN)).where("text is not null and key is not null")
        if _some(_seqs(rows, "key").where("first < last")):
            latest = rows.groupBy("key").agg(F.max("seq").alias("seq"))
            rows = rows.join(latest, ["key", "seq"])
        return rows.select("key", "markdown_key", "hash", "text")

    # --- collections

    def create_collection(self, name: str, dim: int, distance: str = "Cosine") -> bool:
        """Create a collection if it is absent; True if it was."""
        return C.create_collection(self.spark, f"{self.root}/points", name, dim, distance)

    def collections(self) -> list[str]:
        return C.list_collections(self.spark, f"{self.root}/points")

    def write_points(self, run: Run, collection: str, points: DataFrame) -> None:
        """Write the run's points of a collection. ``file`` names the file a point belongs to; a file's earlier points go.

        Of points with equal ids in one run the one of the last file stays.
        """
        points = conform_to(points, _fields(POINTS)).where("id is not null and file is not null")
        ids = points.groupBy("id").agg(F.min("file").alias("first"), F.max("file").alias("last"))
        scratch = scratch_path(self.spark, f"shared-ids-{uuid.uuid4().hex}")
        write_table(ids.where("first < last").select("id", "last"), scratch)
        shared = self.spark.read.parquet(scratch)
        if _some(shared):
            points = points.join(shared.hint("merge"), "id", "left").where("last is null or file = last").drop("last")
        held = self.write(run, f"points/{collection}/data", points)
        remove_path(self.spark, scratch)
        self.replace_files(run, collection, held.groupBy("file").agg(
            F.min("file_hash").alias("file_hash"), F.count("*").alias("n_points")))

    def replace_files(self, run: Run, collection: str, files: DataFrame) -> None:
        """Say which files the run wrote to a collection; a file with 0 points is removed from it."""
        rows = files.withColumn("collection_name", F.lit(collection))
        self.write(run, f"files/of={collection}", conform_to(rows, _fields(FILES)))

    def files(self, collection: str) -> DataFrame:
        """``file, file_hash, n_points, run, seq`` of the files a collection holds, each in its latest version."""
        rows = self._files_of(collection)
        latest = rows.groupBy("file").agg(F.max("seq").alias("seq"))
        return rows.join(latest, ["file", "seq"]).where("n_points > 0").select("file", "file_hash", "n_points", "run", "seq")

    def _files_of(self, collection: str) -> DataFrame:
        return self.table(f"files/of={collection}", _fields(FILES)).drop("collection_name")

    def points(self, collection: str) -> DataFrame:
        """The points of each file's latest version.

        Versions that were replaced are few against all points, so they are what the
        points are joined with, and a file with very many points stays spread.
        """
        rows = self._files_of(collection)
        points = self.table(f"points/{collection}/data", _fields(POINTS))
        replaced = _seqs(rows, "file").where("first < last")
        if _some(replaced):
            old = rows.join(replaced, "file").where("seq < last").select("file", "run")
            points = points.join(old, ["file", "run"], "left_anti")
        return points.select(*_fields(POINTS).names, "run", "seq")

    def resident(self, collection: str) -> DataFrame:
        """``file_hash, collection_name`` of the files a collection holds (O-43)."""
        return self.files(collection).select("file_hash", F.lit(collection).alias("collection_name"))


def _seqs(rows: DataFrame, key: str) -> DataFrame:
    """The first and last run that has each key."""
    return rows.groupBy(key).agg(F.min("seq").alias("first"), F.max("seq").alias("last"))


def _some(rows: DataFrame) -> bool:
    return bool(rows.limit(1).count())


def _fields(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def conform_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to a schema; absent columns are null."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
