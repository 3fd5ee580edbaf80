"""Session construction and the shared scratch/checkpoint folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings the engine relies on; a cluster session may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    master: str | None = None,
    app: str = "locus",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the operator (a folder every executor
    can reach). Only a session that runs in this one process (tests, bench)
    and has none set gets a private folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder"
            )
        root = tempfile.mkdtemp(prefix="locus-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


# Paths given out inside the scratch scope of this context: loads that run side
# by side each have their own. ``together`` hands it to its worker threads.
_SCOPE: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared folder (Spark's writers
    create it)."""
    path = f"{checkpoint_root(spark)}/locus-scratch/{name}-{uuid.uuid4().hex[:12]}"
    return delete_with_scope(path)


def delete_with_scope(path: str) -> str:
    """Have ``path`` deleted at the end of the current scratch scope, if any."""
    scope = _SCOPE.get()
    if scope is not None:
        scope.append(path)
    return path


def keep_after_scope(path: str) -> None:
    """Take ``path`` out of the current scratch scope: it is published."""
    scope = _SCOPE.get()
    if scope is not None and path in scope:
        scope.remove(path)


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of ``path``, whatever store it is in."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return bool(fs.exists(p))


def remove_path(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def colocated_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` (same application, catalog and settings) that
    plans a join of bucketed tables without a shuffle when their bucket column
    is only one of the join's keys. For keys that no value of the bucket column
    makes hot: one bucket is one task."""
    session = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            session.conf.set(k, v)
    session.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return session


# Spark keeps a query's shuffle files until the driver's garbage collector meets
# its plan, by which time a load of many queries holds those of all of them.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Per session: how many blocks are open, and the setting before the first.
_CLEANING: dict[str, tuple[int, str]] = {}
_CLEANING_LOCK = threading.Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a query that runs inside go at its end. Blocks may
    nest and run side by side: the last one puts the session's setting back."""
    session = spark._jsparkSession.sessionUUID()
    with _CLEANING_LOCK:
        n, before = _CLEANING.get(session, (0, ""))
        if not n:
            before = spark.conf.get(SHUFFLE_CLEANUP, "false")
            spark.conf.set(SHUFFLE_CLEANUP, "true")
        _CLEANING[session] = (n + 1, before)
    try:
        yield
    finally:
        with _CLEANING_LOCK:
            n, before = _CLEANING.pop(session)
            if n > 1:
                _CLEANING[session] = (n - 1, before)
            else:
                spark.conf.set(SHUFFLE_CLEANUP, before)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch tables written inside are deleted at the end, shuffle files at
    that of their query: for jobs whose results are published elsewhere by then."""
    paths: list[str] = []
    token = _SCOPE.set(paths)
    try:
        with shuffles_dropped(spark):
            yield
    finally:
        _SCOPE.reset(token)
        for path in paths:
            remove_path(spark, path)


def written(df, name: str):
    """``materialize``, with the folder: for a table that goes (``remove_path``)
    as soon as nothing reads it any more."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def materialize(df, name: str):
    """Cut lineage: write ``df`` as parquet below the shared folder, read it
    back. Computes the plan once (a reliable checkpoint computes it twice),
    survives executor loss, and gives the planner exact size statistics."""
    return written(df, name)[0]
