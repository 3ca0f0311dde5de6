"""Raw JSON landing zone, kept outside the table folders, and the bronze envelope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickermill import schemas
from tickermill.functions.indicators import REQUESTED_MODULES
from tickermill.operators.dedup import not_yet_ingested

STREAM, REPLAY = "stream", "replay"
CORRUPT = "_corrupt_record"


def envelope(
    ticker: Column, payload: Column, source: Column, status: Column, run_date: Column, collected: Column
) -> list[Column]:
    """Bronze columns around a payload struct; a failed fetch has a NULL payload."""
    return [
        ticker.alias("ticker"),
        F.when(payload.isNotNull(), F.to_json(payload)).alias("payload_json"),
        status.cast("int").alias("http_status"),
        F.lit(REQUESTED_MODULES).alias("modulos_solicitados"),
        source.alias("fonte"),
        collected.alias("coletado_em"),
        run_date.alias("data_coleta"),
    ]


def write_landing(envelopes: DataFrame, landing: str) -> None:
    """Envelopes as JSON lines under `data_coleta=` folders; a rerun replaces its dates only."""
    (
        envelopes.hint("rebalance", "data_coleta")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("data_coleta")
        .json(landing)
    )


def read_landing(spark: SparkSession, landing: str, run_date: str | None = None) -> DataFrame:
    """Envelopes of one date (or all): one JSON document per line, any number of files."""
    df = _lines(spark, landing, run_date)
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected_lines(spark: SparkSession, landing: str, run_date: str | None = None) -> DataFrame:
    """Lines that are no JSON document (`linha`) beside what could be read of them, for quarantine."""
    df = _lines(spark, landing, run_date).where(F.col(CORRUPT).isNotNull())
    return df.withColumnRenamed(CORRUPT, "linha")


def _lines(spark: SparkSession, landing: str, run_date: str | None) -> DataFrame:
    """Every line that is not blank as an envelope, or as a rejected text beside empty columns."""
    fields = [f for f in schemas.struct(schemas.BRONZE).fields if f.name != "data_coleta"]
    layout = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
    lines = spark.read.schema("value STRING, data_coleta STRING").text(landing)
    if run_date is not None:
        lines = lines.where(F.col("data_coleta") == run_date)
    parsed = F.from_json("value", layout, {"columnNameOfCorruptRecord": CORRUPT})
    rows = lines.where(F.trim("value") != "").select(parsed.alias("line"), "data_coleta")
    return rows.select(*[f"line.{name}" for name in layout.names], "data_coleta")


def only_new(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Envelopes whose (ticker, data_coleta) has not been ingested yet."""
    return not_yet_ingested(incoming, stored, schemas.key_columns(schemas.BRONZE))
