"""Partitioned Parquet tables: pruned reads, idempotent writes, keyed upserts."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickermill import schemas
from tickermill.functions.coercion import conform
from tickermill.operators.dedup import top_per_key
from tickermill.session import lean_writes, stored, temporary_tables

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def read_table(spark: SparkSession, name: str, warehouse: str, path: str | None = None) -> DataFrame:
    """Whole table with the declared schema, so partition values stay strings."""
    return spark.read.schema(schemas.struct(name)).parquet(
        path or schemas.location(name, warehouse)
    )


def exists(spark: SparkSession, name: str, warehouse: str) -> bool:
    """Whether the table's folder is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(schemas.location(name, warehouse))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def read_partition(spark: SparkSession, name: str, column: str, value: str, warehouse: str) -> DataFrame:
    """One partition, read from the base path so that its column is kept; other folders are pruned."""
    return read_table(spark, name, warehouse).where(F.col(column) == value)


def partition_folders(spark: SparkSession, name: str, path: str) -> list[tuple[str, str]]:
    """(value, folder) of the partitions below `path`, from the folder listing; no data file is opened."""
    (column,) = schemas.partition_columns(name)
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    folders = [status.getPath() for status in files.listStatus(root)]
    prefix = f"{column}="
    return sorted((unquote(f.getName()[len(prefix) :]), f.toString()) for f in folders if f.getName().startswith(prefix))


def partition_values(spark: SparkSession, name: str, warehouse: str) -> list[str]:
    """Partition values from the folder listing, in order.

    The folder of rows without a value is left out, and escaped characters are restored.
    """
    folders = partition_folders(spark, name, schemas.location(name, warehouse))
    return [value for value, _ in folders if value != NO_VALUE]


def latest_partition(spark: SparkSession, name: str, warehouse: str) -> DataFrame:
    """Newest partition; the value is a literal, so only its folder is scanned."""
    (column,) = schemas.partition_columns(name)
    values = partition_values(spark, name, warehouse)
    df = read_table(spark, name, warehouse)
    return df.where(F.col(column) == values[-1]) if values else df.limit(0)


def write_table(
    df: DataFrame, name: str, warehouse: str, mode: str = "overwrite", path: str | None = None
) -> int:
    """Write rows in the declared layout and return how many.

    `overwrite` replaces only the partitions that occur in `df`. No rows, no change. The
    rebalance hint makes files of even size: a partition with most of the rows is split over
    tasks and small ones are merged.
    """
    return write_observed(df, name, warehouse, {}, mode, path)["n"]


def write_observed(
    df: DataFrame,
    name: str,
    warehouse: str,
    observed: dict[str, Column],
    mode: str = "overwrite",
    path: str | None = None,
) -> dict[str, int]:
    """`write_table` that returns the named aggregates of the rows, taken while they are written, and `n`."""
    partition = schemas.partition_columns(name)
    counted = Observation()
    rows = conform(df, name).hint("rebalance", *partition).observe(
        counted, F.count("*").alias("n"), *[value.alias(key) for key, value in observed.items()]
    )
    writer = rows.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition:
        writer = writer.partitionBy(*partition)
    with lean_writes(df.sparkSession):
        writer.parquet(path or schemas.location(name, warehouse))
    return counted.get


def upsert_table(
    df: DataFrame, name: str, warehouse: str, newest: list[Column] | None = None
) -> int:
    """Merge rows into the touched partitions by the table's logical key.

    Rows of other keys in the same partitions stay. With `newest`, the first row per key in
    that order wins among stored and new rows; otherwise the new row wins. Writing the same
    input again changes nothing. The input is evaluated once, into the shared folder; its
    partition values (one per touched partition) become literals, so only those folders are read.
    The merged rows are staged as well: a write that fails half-way can be repeated from there. What
    was stored for it is deleted when the write has succeeded.
    """
    with temporary_tables(df.sparkSession):
        return _upsert(df, name, warehouse, newest)


def _upsert(df: DataFrame, name: str, warehouse: str, newest: list[Column] | None) -> int:
    keys = schemas.key_columns(name)
    if not partition_values(df.sparkSession, name, warehouse):
        incoming, kept = conform(df, name), None
        merged = incoming.withColumn("_rank", F.lit(0))
    else:
        incoming = stored(conform(df, name), "incoming")
        kept = touched_rows(incoming, name, warehouse).withColumn("_rank", F.lit(1))
        merged = incoming.withColumn("_rank", F.lit(0)).unionByName(kept)
    order = [*(newest or []), F.col("_rank")]
    # All columns close the order, so that equal keys resolve the same way on every run.
    order += [F.col(c).desc_nulls_last() for c in schemas.columns(name) if c not in keys]
    winners = top_per_key(merged, keys, order).select(*schemas.columns(name))
    return write_table(winners if kept is None else stored(winners, "staged"), name, warehouse)


def touched_rows(incoming: DataFrame, name: str, warehouse: str) -> DataFrame:
    """Stored rows of the partitions that occur in `incoming`; the others are pruned."""
    (partition,) = schemas.partition_columns(name)
    values = [row[0] for row in incoming.select(partition).distinct().collect()]
    present = F.col(partition).isin([value for value in values if value is not None])
    if None in values:
        present = present | F.col(partition).isNull()
    return read_table(incoming.sparkSession, name, warehouse).where(present)
