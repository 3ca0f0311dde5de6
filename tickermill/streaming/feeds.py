"""Structured Streaming ingestion: tick feed and raw envelopes from JSON-line folders.

Offsets in the checkpoint replace the destructive queue reads: a restarted query goes on where
the last committed batch ended.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickermill import schemas
from tickermill.functions.coercion import conform
from tickermill.operators.dedup import newest_envelope_ties, newest_envelope_values
from tickermill.plans.medallion import bronze_rows
from tickermill.session import release_shuffles, stored, temporary_tables
from tickermill.sources.deltas import append_delta, compact, read_current
from tickermill.sources.landing import CORRUPT, REPLAY, STREAM, read_landing, rejected_lines
from tickermill.sources.tables import write_table

_STATE_CODEC, STATE_CODEC = "spark.sql.streaming.stateStore.compression.codec", "zstd"


def _whole_columns(table: str) -> list[str]:
    return [n for n, kind in schemas.logical_types(table).items() if kind in ("inteiro", "longo")]


def _json_stream(spark: SparkSession, folder: str, table: str, files_per_batch: int) -> DataFrame:
    """Messages with text leaves (coerced later); malformed lines are kept apart, not fatal.

    Leaves of integer columns stay variants, which still tell a number from its text.
    """
    whole = _whole_columns(table)
    leaf = lambda name: T.VariantType() if name in whole else T.StringType()
    layout = T.StructType([T.StructField(c, leaf(c)) for c in schemas.columns(table)])
    return (
        spark.readStream.schema(layout.add(CORRUPT, T.StringType()))
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(folder)
    )


def _whole_numbers(messages: DataFrame, table: str) -> DataFrame:
    """Integer columns: numbers are cut to whole ones, text counts only if it is a whole number."""
    return messages.withColumns(
        {
            n: F.expr(
                f"CASE schema_of_variant({n}) WHEN 'STRING' THEN try_cast(try_variant_get({n}, '$', 'string') AS BIGINT)"
                f" ELSE coalesce(try_variant_get({n}, '$', 'bigint'), try_cast(try_variant_get({n}, '$', 'double') AS BIGINT)) END"
            )
            for n in _whole_columns(table)
        }
    )


def well_formed(messages: DataFrame) -> DataFrame:
    return messages.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def malformed(messages: DataFrame) -> DataFrame:
    """The rejected lines (`linha`) beside what could be read of them, for a quarantine sink.

    Spark refuses to read the rejected text without any other column.
    """
    return messages.where(F.col(CORRUPT).isNotNull()).withColumnRenamed(CORRUPT, "linha")


def append_ticks(
    spark: SparkSession, folder: str, path: str, checkpoint: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Append all pending ticks to the price table and stop. Several batches a day are normal
    for an event feed, so nothing is overwritten; the sink's log makes reruns add nothing."""
    messages = well_formed(_json_stream(spark, folder, schemas.PRICES, files_per_batch))
    ticks = conform(_whole_numbers(messages, schemas.PRICES), schemas.PRICES)
    return (
        ticks.writeStream.format("parquet")
        .partitionBy(*schemas.partition_columns(schemas.PRICES))
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(availableNow=True)
        .start()
    )


def quarantine(
    spark: SparkSession, folder: str, table: str, path: str, checkpoint: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Append all pending malformed lines of a feed to a reject folder and stop.

    It reads the same files as the feed with a checkpoint of its own, so both see every line once.
    """
    rejects = malformed(_json_stream(spark, folder, table, files_per_batch))
    return (
        rejects.writeStream.format("json")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(availableNow=True)
        .start()
    )


def _keep(batch: DataFrame, batch_id: int, warehouse: str, checkpoint: str, even: bool = True) -> None:
    """Rows of a micro-batch beside bronze, under the name of its checkpoint and number."""
    release_shuffles(batch.sparkSession)
    name = f"{hashlib.sha256(checkpoint.encode()).hexdigest()[:12]}-{batch_id:09d}"
    append_delta(batch, schemas.BRONZE, warehouse, name, even)


def ingest_envelopes(
    spark: SparkSession,
    folder: str,
    warehouse: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    rejects: str | None = None,
) -> StreamingQuery:
    """Take in pending envelopes and stop; a batch is acknowledged after its write.

    Each batch is written beside bronze, so its cost follows the batch; `current_envelopes` reads both
    and `compact_envelopes` merges them once a run. A batch that is run again after a failure replaces
    itself. With `rejects`, the malformed lines of each batch are written there, in a folder per batch
    that a repeated batch replaces.
    """
    messages = _json_stream(spark, folder, schemas.BRONZE, files_per_batch)

    def take(batch: DataFrame, batch_id: int) -> None:
        with temporary_tables(spark):
            if rejects:
                batch = stored(batch, "batch")
                malformed(batch).select("linha").write.mode("overwrite").json(f"{rejects}/batch={batch_id}")
            # The scan packs small files, so its tasks hold even shares as they are.
            _keep(_whole_numbers(well_formed(batch), schemas.BRONZE), batch_id, warehouse, checkpoint, even=False)

    return (
        messages.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_newest_envelopes(
    spark: SparkSession,
    folder: str,
    warehouse: str,
    checkpoint: str,
    delay: str = "30 days",
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Like `ingest_envelopes`, but the newest envelope per (ticker, run date) is held in the state store.

    A batch writes only keys whose newest envelope it has changed; repeated and older collections leave
    no trace, without a look at stored rows. State of a run date is dropped, and envelopes of that
    date ignored, once a run date that is later by more than `delay` has been seen. Envelopes without
    a run date belong to the day they arrive on.
    """
    messages = _whole_numbers(well_formed(_json_stream(spark, folder, schemas.BRONZE, files_per_batch)), schemas.BRONZE)
    # The order of `newest_envelope_first`: NULL is the smallest member of a struct.
    values = {f"_v{i}": v for i, v in enumerate([*newest_envelope_values(), *newest_envelope_ties()])}
    newest = F.struct(
        *[value.alias(name) for name, value in values.items()],
        "http_status", "payload_json", "fonte", "coletado_em", "modulos_solicitados",
    )
    day = F.coalesce(F.col("data_coleta").try_cast("timestamp"), F.current_timestamp())
    held = (
        messages.withColumn("_day", day)
        .withWatermark("_day", delay)
        .groupBy("ticker", "data_coleta", F.window("_day", "1 day"))
        .agg(F.max(newest).alias("_newest"))
        .select("ticker", "data_coleta", "_newest.*")
        .drop(*values)
    )
    query = (
        held.writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: _keep(batch, batch_id, warehouse, checkpoint))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    # A checkpoint keeps the codec that its first query started with.
    before = spark.conf.get(_STATE_CODEC)
    spark.conf.set(_STATE_CODEC, STATE_CODEC)
    try:
        return query.start()
    finally:
        spark.conf.set(_STATE_CODEC, before)


def current_envelopes(spark: SparkSession, warehouse: str) -> DataFrame:
    """Bronze with the batches that have come in since it was last compacted; the newest collection wins."""
    return read_current(spark, schemas.BRONZE, warehouse, newest_envelope_values(), newest_envelope_ties())


def compact_envelopes(spark: SparkSession, warehouse: str) -> int:
    """Merge the batches taken in into bronze: once a run, over the days they touch. Rows written."""
    return compact(spark, schemas.BRONZE, warehouse, newest_envelope_values(), newest_envelope_ties())


def load_bronze(
    spark: SparkSession,
    source: str,
    folder: str,
    warehouse: str,
    run_date: str | None = None,
    checkpoint: str | None = None,
    rejects: str | None = None,
) -> None:
    """Fill bronze from the live feed (`stream`) or from the stored landing files (`replay`).

    With `rejects`, lines that are no JSON are stored there.
    """
    mode = source.strip().lower()
    if mode == STREAM:
        ingest_envelopes(spark, folder, warehouse, checkpoint, rejects=rejects).awaitTermination()
        compact_envelopes(spark, warehouse)
    elif mode == REPLAY:
        write_table(bronze_rows(read_landing(spark, folder, run_date)), schemas.BRONZE, warehouse)
        if rejects:
            rejected_lines(spark, folder, run_date).select("linha").write.mode("overwrite").json(rejects)
    else:
        raise ValueError(f"unknown input {source!r}; use {STREAM} or {REPLAY}")
