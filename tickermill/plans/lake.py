"""Builds the stored layers once per session and data folder, with the engine's own sinks."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from tickermill import schemas
from tickermill.plans import derive, medallion
from tickermill.session import shared_dir, stored, temporary_tables
from tickermill.sources import tables

_built: dict[tuple[str, str], str] = {}
_parsed: dict[tuple[str, str], DataFrame] = {}
_collected: dict[tuple[str, str], DataFrame] = {}


def scratch(spark: SparkSession, folder: str, purpose: str) -> str:
    """Folder of this application under the shared checkpoint folder."""
    digest = hashlib.sha256(folder.encode()).hexdigest()[:12]
    return f"{shared_dir(spark)}/tickermill/{spark.sparkContext.applicationId}/{digest}/{purpose}"


def collected(spark: SparkSession, folder: str) -> DataFrame:
    """The raw envelopes as they were collected, repeated collections included, stored once."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _collected:
        _collected[key] = stored(derive.envelopes(spark, folder), "collected")
    return _collected[key]


def warehouse(spark: SparkSession, folder: str) -> str:
    """Warehouse with bronze, silver, series and gold derived from the tables in `folder`.

    The reports are questions to stored tables, so the layers are written once and then read
    back with partition pruning. A written layer also cuts the lineage of the next one.
    """
    key = (spark.sparkContext.applicationId, folder)
    if key not in _built:
        root, envelopes = scratch(spark, folder, "warehouse"), collected(spark, folder)
        with temporary_tables(spark):
            tables.write_table(medallion.stored_bronze_rows(envelopes), schemas.BRONZE, root)
        with temporary_tables(spark):
            rows, _ = medallion.parsed(tables.read_table(spark, schemas.BRONZE, root))
            tables.write_table(medallion.silver_of(rows), schemas.SILVER, root)
            series = medallion.series_of(rows)
            tables.upsert_table(series, schemas.SERIES, root, newest=medallion.newest_run_first())
        with temporary_tables(spark):
            silver = tables.read_table(spark, schemas.SILVER, root)
            tables.write_table(medallion.gold_rows(silver), schemas.GOLD, root)
        _built[key] = root
    return _built[key]


def parsed(spark: SparkSession, folder: str) -> DataFrame:
    """The envelopes of the warehouse's bronze with their payload parsed, stored for those who ask for them."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _parsed:
        bronze = tables.read_table(spark, schemas.BRONZE, warehouse(spark, folder))
        _parsed[key], _ = medallion.parsed(bronze)
    return _parsed[key]
