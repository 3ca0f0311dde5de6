"""One run from raw envelopes to scored, registered layers, with its summary."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickermill import schemas
from tickermill.functions.guards import blank_to_null
from tickermill.operators import scoring
from tickermill.plans import evolution, medallion
from tickermill.session import temporary_tables
from tickermill.sources import catalog, tables


@dataclass(frozen=True)
class RunSummary:
    """What a run has written, counted while it was written; `grades` has every grade."""

    run_date: str
    envelopes: int = 0
    rows: int = 0
    eligible: int = 0
    sessions: int = 0
    scored: int = 0
    grades: dict[str, int] = field(default_factory=dict)


GRADES = [letter for _, letter in scoring.GRADES] + [scoring.LOWEST_GRADE, scoring.NO_GRADE]


def run_day(
    spark: SparkSession,
    envelopes: DataFrame,
    warehouse: str,
    run_date: str,
    database: str | None = None,
    buckets: int | None = None,
) -> RunSummary:
    """Bronze, silver, series, gold and score changes of one run date, and with `database` registration and the view.

    With `buckets` as well, the run's silver and gold are also stored by ticker (`catalog.store_bucketed_run`).

    Of `envelopes`, those of `run_date` and those without a date are taken. A payload is parsed once. All
    writes can be repeated: the same envelopes give the same tables. No envelopes, no change.
    """
    day = F.coalesce(blank_to_null(F.col("data_coleta")), F.lit(run_date))
    own = envelopes.withColumn("data_coleta", day).where(F.col("data_coleta") == run_date)
    collected = tables.write_table(medallion.bronze_rows(own), schemas.BRONZE, warehouse)
    if not collected:
        return RunSummary(run_date)
    bronze = tables.read_partition(spark, schemas.BRONZE, "data_coleta", run_date, warehouse)
    with temporary_tables(spark):
        parsed, sessions = medallion.parsed(bronze, run_date)
        rows = tables.write_observed(
            medallion.silver_of(parsed), schemas.SILVER, warehouse, {"eligible": F.count_if("elegivel_score")}
        )
        dates = [row[0] for row in _merge_series(parsed, warehouse).collect()]
    silver = tables.read_partition(spark, schemas.SILVER, "data_coleta", run_date, warehouse)
    with temporary_tables(spark):
        graded = tables.write_observed(
            medallion.gold_rows(silver),
            schemas.GOLD,
            warehouse,
            {"scored": F.count("score_final"), **{f"nota_{g}": F.count_if(F.col("nota") == g) for g in GRADES}},
        )
    gold = tables.read_partition(spark, schemas.GOLD, "data_referencia", run_date, warehouse)
    evolution.merge_run(gold, warehouse, run_date)
    if database is not None:
        touched = {schemas.BRONZE: [run_date], schemas.SILVER: [run_date], schemas.SERIES: dates, schemas.GOLD: [run_date]}
        for name, values in touched.items():
            catalog.register_table(spark, name, warehouse, database, values)
        catalog.create_screener_view(spark, database)
        if buckets is not None:
            for name, layer in ((schemas.SILVER, silver), (schemas.GOLD, gold)):
                catalog.store_bucketed_run(layer, name, warehouse, run_date, buckets, database)
    grades = {g: graded[f"nota_{g}"] for g in GRADES}
    return RunSummary(run_date, collected, rows["n"], rows["eligible"], sessions, graded["scored"], grades)


def _merge_series(parsed: DataFrame, warehouse: str) -> DataFrame:
    """Merge the run's daily prices into the series; the sessions (calendar days) they touch."""
    rows = medallion.series_of(parsed)
    tables.upsert_table(rows, schemas.SERIES, warehouse, newest=medallion.newest_run_first())
    return rows.select("data_pregao").distinct()
