"""Labelled rows for the classifiers: who may learn from what, and bounded samples of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS_PER_DOUBLING = 32  # so a bin is 2 % wider than the one before


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds (null ids: null)."""
    return F.crc32(doc_id.cast("string")) % folds


def one_label(labels: DataFrame, label_column: str) -> DataFrame:
    """(doc_id, label) with label 0 or 1; of repeated rows of a doc_id the larger label counts."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_column).cast("int").alias("label"))
    return own.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))


def sample(rows: DataFrame, by: str, size: int) -> DataFrame:
    """(by, doc_id) of at most `size` ids of every value of `by`: those with the smallest hashes.

    Repeats of an id count once. A histogram of the hashes, finer towards the small ones, is counted in
    the tasks that hold the rows; it tells up to where `size` ids lie, and only those are ranked. So a
    task ranks little more than `size` ids however many rows have the same `by`. Rows without an id or
    without a value of `by` are left out.
    """
    ids = rows.select(by, "doc_id").where(F.col(by).isNotNull() & F.col("doc_id").isNotNull()).distinct()
    ids = ids.withColumn("__hash", F.xxhash64("doc_id"))
    above = F.col("__hash").cast("double") + 2.0**63  # the hash counted from the smallest one
    ids = ids.withColumn("__bin", F.floor(F.log2(above + 1) * BINS_PER_DOUBLING).cast("int"))
    bins = ids.groupBy(by, "__bin").agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(by).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    last = bins.where(F.col("__before") < size).groupBy(by).agg(F.max("__bin").alias("__last"))
    few = ids.join(F.broadcast(last), by).where("__bin <= __last")  # one row for every value of `by`
    place = F.row_number().over(Window.partitionBy(by).orderBy("__hash", "doc_id"))
    return few.withColumn("__place", place).where(F.col("__place") <= size).select(by, "doc_id")


def one_text(rows: DataFrame, keys: list[str], text_column: str = "text") -> DataFrame:
    """One row for every value of `keys`, with the text whose hash is smallest (null only if there is no other)."""
    text = F.col(text_column)
    least = F.min(F.when(text.isNotNull(), F.struct(F.xxhash64(text).alias("hash"), text.alias("text"))))
    return rows.groupBy(*keys).agg(least["text"].alias(text_column))
