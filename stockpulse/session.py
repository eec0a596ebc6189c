"""Session construction and the checkpoint directory contract."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "stockpulse", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, configuring it if needed.

    On a cluster the directory must come from ``spark.checkpoint.dir`` (a
    shared file system).  Only a local-mode session without that setting gets
    a private scratch directory, as tests do.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared directory on a cluster")
    path = tempfile.mkdtemp(prefix="stockpulse-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


#: Spark's own bound of a batch for Python tasks, and the one that ``bound_batches`` sets.
BATCH_BYTES, DEFAULT_BATCH_BYTES, SMALL_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m"


def bound_batches(spark: SparkSession) -> None:
    """Let Spark hand texts to Python tasks in batches of about 8 MB instead of 64 MB; a value set by the user stays.

    A task holds its batch several times over (Arrow buffers on both sides,
    which grow by doubling, and Python's strings), so the batch and not the
    table decides what the Python side of an executor takes.  All rows still
    go through, in more batches.
    """
    if spark.conf.get(BATCH_BYTES) == DEFAULT_BATCH_BYTES:
        spark.conf.set(BATCH_BYTES, SMALL_BATCH)


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Cut the lineage of ``df``: write it once as Parquet under the reliable
    checkpoint directory and continue from the written table.

    One job (``Dataset.checkpoint`` on an unpersisted frame computes the plan
    twice: once for the eager count and again to write the files), a
    columnar re-read with column pruning, and file-size statistics that AQE
    uses for its join decisions.  The directory is shared storage on a
    cluster, so a lost executor only recomputes its own write tasks.  The
    shuffle files of the job go when it ends.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{label}-{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        df.write.mode("errorifexists").parquet(path)
    _TABLES.append(path)
    return spark.read.parquet(path)


#: Spark's setting that removes an execution's shuffle files at its end; otherwise they stay until the driver's JVM collects their plan.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession):
    """Let the writes made meanwhile remove their shuffle files: what they wrote is all that is read of them again."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


_TABLES: list[str] = []


def keep_until_release(path: str) -> str:
    """Have a folder that is written otherwise removed with the materialized tables."""
    _TABLES.append(path)
    return path


def release(*tables: DataFrame | str) -> None:
    """Remove tables (as ``materialize`` returned them) or folders of this process that nothing reads any more."""
    for table in tables:
        names = {table.rstrip("/").rsplit("/", 1)[1]} if isinstance(table, str) else {f.rsplit("/", 2)[1] for f in table.inputFiles()}
        for path in [p for p in _TABLES if p.rsplit("/", 1)[1] in names]:
            _TABLES.remove(path)
            _delete(path)


def _delete(path: str) -> None:
    jvm = SparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(at, True)


def release_tables() -> None:
    """Remove the tables written by ``materialize`` in this process; frames that read them can't be used afterwards.

    Runs when the process ends; long sessions may call it between batches.
    """
    while _TABLES and SparkContext._jvm is not None:
        _delete(_TABLES.pop())


@atexit.register
def _release_at_exit() -> None:
    with contextlib.suppress(Exception):   # the JVM may be gone already
        release_tables()
