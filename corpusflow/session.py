"""Session helpers.

Library code never creates a session; it receives one. ``local_session`` is
for tests and the benchmark only. ``checkpoint_dir`` reads the cluster's
``spark.checkpoint.dir`` and only falls back to a scratch folder when the
setting is absent (local tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "corpusflow", event_log_dir: str | None = None) -> SparkSession:
    """A local session configured like a small cluster (AQE on, UI off, UTC).

    ``event_log_dir`` turns on Spark's event log there (stage and task times
    without the web UI; read them with ``tools/stage_times.py``).
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # call-site capture for error messages costs ~10 ms per Column call
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    )
    if event_log_dir:
        os.makedirs(event_log_dir, exist_ok=True)
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster; a scratch one only if unset."""
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="corpusflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for materialised tables."""
    base = checkpoint_dir(spark)
    if "://" in base:
        return base.rstrip("/") + "/" + name
    return os.path.join(base, name)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a staged folder that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_table(df: DataFrame, path: str) -> None:
    """Write a table in place of what lies at ``path``.

    The shuffle files of the write go as soon as it is done, as nothing reads them
    again. Else they stay until the driver happens to collect its garbage, and the
    disk holds those of a whole run.
    """
    spark = df.sparkSession
    before = spark.conf.get(_RELEASE)
    spark.conf.set(_RELEASE, "true")
    try:
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_RELEASE, before)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``corpusflow`` importable by Python workers (once per application).

    The package is zipped from the driver's copy, placed in the shared
    checkpoint folder and added with ``addPyFile``, which is how code reaches
    executors on a cluster. Functions passed to ``mapInPandas`` refer to
    ``corpusflow`` modules by name, so workers must be able to import them.
    """
    import hashlib
    import io
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _dirs, files in os.walk(pkg):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    data = buf.getvalue()
    name = f"corpusflow-{hashlib.md5(data).hexdigest()[:12]}.zip"
    target = scratch_path(spark, f"pylib/{name}")
    # written through the Hadoop file system of the shared folder (no local temp copy)
    jvm = sc._jvm
    dst = jvm.org.apache.hadoop.fs.Path(target)
    fs = dst.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(dst):
        out = fs.create(dst, True)
        try:
            out.write(bytearray(data))
        finally:
            out.close()
    sc.addPyFile(target)
    _SHIPPED.add(app)
