"""Session factory and the shared scratch location."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings the engine relies on for right results, whatever the cluster defaults are.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# How the engine writes its tables: densely, and without keeping the shuffle files they were made from.
_LEAN = {
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
_temporary: ContextVar[list[str] | None] = ContextVar("_temporary", default=None)


def create_session(app_name: str, shared: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC dates, dynamic partition overwrite and adaptive execution.

    `shared` is a folder that the driver and all executors see, for tables between steps; a cluster
    needs it here or in `spark.checkpoint.dir`. Shuffle width is left to adaptive coalescing.
    """
    builder = SparkSession.builder.appName(app_name)
    settings = {
        **RESULT_SETTINGS,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **({CHECKPOINT_CONF: shared} if shared else {}),
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and every executor can see.

    `spark.checkpoint.dir`, else the context's checkpoint folder. Only a local master, where all
    tasks share one disk, falls back to a temporary folder; a cluster without a shared folder is
    refused, since executors would write to disks of their own.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tickermill-"))
    return context.getCheckpointDir().rstrip("/")


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tickermill/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new path of this application under the shared folder."""
    return f"{_own_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> bool:
    """Delete what this application has stored between steps; call it when all results are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def lean_writes(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are compressed densely, and the shuffle files of a write go when it ends.

    Without it they stay until the driver happens to collect its garbage, many times the size of the tables.
    """
    before = {key: spark.conf.get(key) for key in _LEAN}
    for key, value in _LEAN.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files that nothing refers to any more, those of finished micro-batches."""
    spark._jvm.System.gc()


def delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[list[str]]:
    """Tables `stored` inside are deleted at the end, when all that reads them must have been written.

    If it fails they stay, so that it can be looked at and repeated from there. Gives the list of their folders.
    """
    paths: list[str] = []
    token = _temporary.set(paths)
    try:
        yield paths
    finally:
        _temporary.reset(token)
    for path in paths:
        delete(spark, path)


def stored_alone(spark: SparkSession, make: Callable[[], DataFrame], purpose: str) -> DataFrame:
    """`stored(make())`, after which the tables that were stored to make it are deleted."""
    with temporary_tables(spark) as paths:
        table = stored(make(), purpose)
        own = paths.pop()
    outer = _temporary.get()
    if outer is not None:
        outer.append(own)
    return table


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows as a written table: computed once, of known size, safe from recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    with lean_writes(spark):
        df.write.parquet(path)
    paths = _temporary.get()
    if paths is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)
