"""Bronze to silver to gold as DataFrame chains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tickermill import schemas
from tickermill.functions import indicators, series
from tickermill.functions.categories import with_categories
from tickermill.functions.coercion import conform
from tickermill.operators.dedup import latest_envelopes, latest_stored_envelopes, top_per_key, with_places
from tickermill.operators.scoring import score_universe
from tickermill.session import stored

# Fixed value: the source of generated series.
SYNTHETIC = "sintetico"


def bronze_rows(envelopes: DataFrame) -> DataFrame:
    """Newest envelope per (ticker, data_coleta) in the bronze layout."""
    return latest_envelopes(conform(envelopes, schemas.BRONZE))


def stored_bronze_rows(envelopes: DataFrame) -> DataFrame:
    """`bronze_rows` of envelopes that are read from Parquet files, where the payloads stay in place."""
    return latest_stored_envelopes(with_places(envelopes)).select(*schemas.columns(schemas.BRONZE))


def silver_rows(bronze: DataFrame, run_date: str = "") -> DataFrame:
    """Typed indicators, one row per run and normalised ticker: the newest collection wins."""
    return _newest_of(indicators.indicators(bronze, run_date))


def _newest_of(rows: DataFrame) -> DataFrame:
    order = ["coletado_em", *[c for c in schemas.columns(schemas.SILVER) if c != "coletado_em"]]
    newest = [F.col(c).desc_nulls_last() for c in order]
    return top_per_key(rows, ["ticker", "data_coleta"], newest).select(*rows.columns)


def parsed(bronze: DataFrame, run_date: str = "") -> tuple[DataFrame, int]:
    """The envelopes with their payload parsed, as a written table, and the number of daily prices in it.

    Both silver and the series are made from it, so each text is parsed once.
    """
    counted = Observation()
    dated = F.size(F.filter("_points", lambda point: point["date"].isNotNull()))
    rows = indicators.parsed_envelopes(bronze, run_date)
    table = stored(rows.observe(counted, F.sum(F.coalesce(dated, F.lit(0))).alias("n")), "parsed")
    return table, counted.get["n"] or 0


def silver_of(envelopes: DataFrame) -> DataFrame:
    """`silver_rows` from a `parsed` table.

    Only tickers that occur twice in a run are compared; all other rows stay in their task.
    """
    keys = ["_ticker", "data_coleta"]
    double = stored(envelopes.groupBy(*keys).count().where("count > 1").drop("count"), "double")
    single = indicators.indicators_of(envelopes.join(double, keys, "left_anti"))
    return single.unionByName(_newest_of(indicators.indicators_of(envelopes.join(double, keys, "left_semi"))))


def series_of(envelopes: DataFrame) -> DataFrame:
    """`series_rows` from a `parsed` table."""
    return series.price_rows(envelopes, "_points")


def series_rows(bronze: DataFrame, run_date: str = "") -> DataFrame:
    return indicators.price_series(bronze, run_date)


def newest_run_first() -> list[Column]:
    """Order for merging series: a session keeps the values of the newest run that has it, but no
    synthetic source replaces a real one."""
    made_up = F.coalesce(F.col("fonte") == SYNTHETIC, F.lit(False))
    return [made_up.asc(), F.col("data_coleta").desc_nulls_last()]


def gold_rows(silver: DataFrame, ranges: int | None = None) -> DataFrame:
    """Scored and labelled rows; labels come after the score because one of them uses it.

    Ranking writes small tables while the plan is built and reads `silver` several times, so
    pass the stored table.
    """
    labelled = with_categories(score_universe(silver, ranges))
    return conform(
        labelled.withColumn("data_referencia", F.col("data_coleta")), schemas.GOLD
    )
