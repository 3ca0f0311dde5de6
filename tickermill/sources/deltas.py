"""Changes to a table as small folders of their own, merged when read and folded in once a run.

A micro-batch writes what it brings and nothing else, so its cost follows the batch and not the day it
belongs to. Readers merge the changes with the table by the logical key; `compact` folds them into the
touched partitions and then removes them. Every step can be repeated: the same folder is replaced
by the same rows, and merging rows that are already in the table changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from tickermill import schemas
from tickermill.functions.coercion import conform
from tickermill.operators.dedup import first_in_place, with_places
from tickermill.session import delete, lean_writes, stored, temporary_tables
from tickermill.sources.tables import exists, read_table, touched_rows, write_table


def _folder(name: str, warehouse: str) -> str:
    return f"{warehouse.rstrip('/')}/{schemas.table(name).name}_delta"


def append_delta(df: DataFrame, name: str, warehouse: str, batch: str, even: bool = True) -> None:
    """Write the rows of one batch; the same batch written again replaces itself.

    Without `even` the tasks that hold the rows write them, and no payload is shuffled for files of even size.
    """
    rows = conform(df, name)
    with lean_writes(df.sparkSession):
        (rows.hint("rebalance") if even else rows).write.mode("overwrite").parquet(f"{_folder(name, warehouse)}/{batch}")


def pending(spark: SparkSession, name: str, warehouse: str) -> list[str]:
    """Folders of complete batches that are not folded in yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_folder(name, warehouse))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    folders = [status.getPath() for status in files.listStatus(path)]
    done = [f for f in folders if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS"))]
    return sorted(f.toString() for f in done)


def _changes(spark: SparkSession, name: str, folders: list[str]) -> DataFrame:
    return spark.read.schema(schemas.struct(name)).parquet(*folders)


def _merged(
    changes: DataFrame, kept: DataFrame | None, name: str, values: list[Column], ties: list[Column]
) -> DataFrame:
    """The first row per key of both, chosen where the rows lie."""
    placed = with_places(changes)
    if kept is not None:
        placed = placed.unionByName(with_places(kept))
    return first_in_place(placed, schemas.key_columns(name), values, ties)


def read_current(
    spark: SparkSession, name: str, warehouse: str, values: list[Column], ties: list[Column]
) -> DataFrame:
    """The table with its pending changes: per key the row with the largest `values`, then `ties`."""
    folders = pending(spark, name, warehouse)
    if not folders:
        return read_table(spark, name, warehouse)
    kept = read_table(spark, name, warehouse) if exists(spark, name, warehouse) else None
    return _merged(_changes(spark, name, folders), kept, name, values, ties)


def compact(spark: SparkSession, name: str, warehouse: str, values: list[Column], ties: list[Column]) -> int:
    """Fold the pending changes into the partitions they touch, remove them, return the rows written.

    Batches that arrive meanwhile stay for the next time. If it stops between the two steps, the next
    call merges the same rows again, with the same result.
    """
    folders = pending(spark, name, warehouse)
    if not folders:
        return 0
    changes = _changes(spark, name, folders)
    kept = touched_rows(changes, name, warehouse) if exists(spark, name, warehouse) else None
    with temporary_tables(spark):
        merged = _merged(changes, kept, name, values, ties)
        # Staged, as a scan of the table cannot be written over it; a write that fails can be repeated from there.
        written = write_table(merged if kept is None else stored(merged, "staged"), name, warehouse)
    for folder in folders:
        delete(spark, folder)
    return written
