"""Newest-row selection and anti-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickermill.session import stored

# Where a row lies in its Parquet file.
PLACE = ["_file", "_row"]
# Rows of a file that one bitmap of places covers, as Spark's bitmap functions have it.
BITMAP_ROWS = 32768


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int = 1) -> DataFrame:
    """First `k` rows per key.

    `row_number() <= k` makes Spark keep only `k` rows per key in each map task before the
    shuffle, so a key that holds much of the table still sends few rows to its reducer.
    """
    position = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("posicao", position).where(F.col("posicao") <= k)


def newest_envelope_first() -> list[Column]:
    """Newest collection first; a missing `coletado_em` sorts oldest.

    Equal times are decided by status and by the payload's digest, so that reruns agree and no payload
    is sorted.
    """
    return [value.desc_nulls_last() for value in (*newest_envelope_values(), *newest_envelope_ties())]


def newest_envelope_values() -> list[Column]:
    """What decides between envelopes without a look at the payload; the largest is the newest."""
    return [F.coalesce(F.col("coletado_em"), F.lit("")), F.col("http_status")]


def newest_envelope_ties() -> list[Column]:
    """What decides between envelopes of equal time and status; the largest counts."""
    return [F.sha2(F.col("payload_json"), 256), F.col("fonte"), F.col("modulos_solicitados"), F.col("coletado_em")]


def latest_envelopes(envelopes: DataFrame) -> DataFrame:
    """Newest collection per (ticker, data_coleta)."""
    return top_per_key(envelopes, ["ticker", "data_coleta"], newest_envelope_first()).drop(
        "posicao"
    )


def with_places(files: DataFrame) -> DataFrame:
    """Rows read from Parquet files with the place of each in them."""
    return files.select(
        "*", F.col("_metadata.file_path").alias(PLACE[0]), F.col("_metadata.row_index").alias(PLACE[1])
    )


def first_in_place(placed: DataFrame, keys: list[str], values: list[Column], ties: list[Column]) -> DataFrame:
    """Row with the largest `values` per key, then the largest `ties`, of rows `with_places`; wide columns stay
    where they lie.

    Keys that occur once are not compared at all. The others are compared by `values`, and by `ties`
    only where these are equal; what travels are keys, values and places. Rows that lose are written as
    bitmaps of their places, a bit for each row of the files, and the result is a scan without them: the
    bitmaps are broadcast, so no wide row is shuffled. NULL is the smallest value, and a key like any other.
    """
    found = placed.select(*keys, F.struct(*values).alias("_value"), *PLACE)
    double = stored(
        found.groupBy(*keys).agg(F.max("_value").alias("_best"), F.count("*").alias("_n")).where("_n > 1").drop("_n"),
        "double",
    )
    rivals = _with_keys(found, double, keys)
    best = F.col("_value").eqNullSafe(F.col("_best"))
    tied = stored(
        rivals.where(best).groupBy(*keys, "_best").agg(F.count("*").alias("_n")).where("_n > 1").drop("_n"), "tied"
    )
    behind = rivals.where(~best).select(*PLACE)
    if not tied.isEmpty():
        # Only here wide columns are looked at, each in its task; the members of `ties` travel.
        looked = placed.select(*keys, F.struct(*values).alias("_value"), F.struct(*ties).alias("_tie"), *PLACE)
        equal = stored(_with_keys(looked, tied, keys).where(best).select(*keys, "_tie", *PLACE), "equal")
        order = [F.col("_tie").desc(), *PLACE]
        winners = top_per_key(equal, keys, order).select(*PLACE)
        behind = behind.unionByName(equal.select(*PLACE).join(winners, PLACE, "left_anti"))
    return _without(placed, behind).drop(*PLACE)


def _without(placed: DataFrame, places: DataFrame) -> DataFrame:
    """Rows whose place is not among `places`."""
    file, row = PLACE
    bits = F.expr(f"bitmap_construct_agg({row} % {BITMAP_ROWS})").alias("_bits")
    maps = stored(places.groupBy(F.col(file).alias("_in"), F.expr(f"{row} div {BITMAP_ROWS}").alias("_map")).agg(bits), "superseded")
    here = (F.col(file) == F.col("_in")) & (F.expr(f"{row} div {BITMAP_ROWS}") == F.col("_map"))
    byte = F.conv(F.hex(F.expr(f"substring(_bits, int({row} % {BITMAP_ROWS} div 8) + 1, 1)")), 16, 10).cast("int")
    named = F.getbit(byte, F.expr(f"int({row} % 8)")) == 1
    return placed.join(F.broadcast(maps), here, "left").where(F.col("_bits").isNull() | ~named).select(*placed.columns)


def _with_keys(rows: DataFrame, chosen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are chosen, with the chosen columns; null equals null."""
    renamed = chosen.withColumnsRenamed({key: f"_{key}" for key in keys})
    on = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    return rows.join(renamed, on).drop(*[f"_{key}" for key in keys])


def latest_stored_envelopes(placed: DataFrame) -> DataFrame:
    """`latest_envelopes` of rows `with_places`: payloads are neither sorted nor shuffled for the choice."""
    return first_in_place(placed, ["ticker", "data_coleta"], newest_envelope_values(), newest_envelope_ties())


def not_yet_ingested(incoming: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows whose keys are not stored yet."""
    return incoming.join(stored.select(*keys), keys, "left_anti")
