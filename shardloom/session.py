"""Session helpers: building a session, the shared checkpoint folder, and
materialising an intermediate result so later stages do not recompute it.

On a cluster the checkpoint folder is the shared one named by
``spark.checkpoint.dir``; it is read from the session and only set here when
nothing is configured (local tests).
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(
    app: str = "shardloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
) -> SparkSession:
    """Session with the settings this library relies on (AQE on, UTC)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Token rows are wide (up to ~64k ids x 2 arrays): keep Arrow batches small.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.parquet.columnarReaderBatchSize", str(WIDE_ROW_BATCH))
        .config("spark.ui.enabled", "false")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


#: Parquet reader batch (rows) for token tables: a row holds up to ~64k ids in
#: two arrays (~0.5 MB), so Spark's default 4,096-row batch could need ~2 GB
#: per task.  256 rows keep a batch near 128 MB in the worst case.
WIDE_ROW_BATCH = 256


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only if unset.

    A folder of this machine is chosen for ``local`` masters alone; elsewhere
    executors could not read it, so a missing setting is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        master = sc.master or ""
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="shardloom-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/shardloom/{name}-{uuid.uuid4().hex}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``shardloom`` importable in Python workers (once per context).

    Operators that run Python on executors (tokenizer, ``.npy`` source,
    stream state) pickle references to this package.  When the package is
    not installed on the executors, it is zipped and added with
    ``addPyFile`` - the runtime form of ``--py-files``: Spark serves the
    archive to every executor and puts it on the workers' path.
    """
    import os
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    fd, archive = tempfile.mkstemp(prefix="shardloom-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(archive)
    _SHIPPED.add(app)


def materialize(df: DataFrame, name: str = "stage", compression: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    This cuts lineage (a lost executor re-reads files instead of re-running
    tokenisation) and keeps column pruning for later narrow projections.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return spark.read.parquet(path)


#: With this setting Spark deletes the shuffle files of a query at its end, else when the driver collects its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes inside leave no shuffle files: what they wrote is read from then on."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def _stored_names(df: DataFrame) -> set[str]:
    found = (re.search(r"/shardloom/([^/]+-[0-9a-f]{32})/[^/]+$", f) for f in df.inputFiles())
    return {m[1] for m in found if m}


def drop_stored(df: DataFrame, keep: DataFrame | None = None) -> None:
    """Delete the tables that ``materialize`` stored for ``df``, but for those that
    ``keep`` reads; only for one whose last reader is done."""
    from pyarrow import fs as pafs

    from shardloom.sources.npy import _fs

    fs, base = _fs(f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/shardloom")
    for name in _stored_names(df) - (_stored_names(keep) if keep is not None else set()):
        if fs.get_file_info(f"{base}/{name}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{base}/{name}")
