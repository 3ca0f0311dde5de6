"""Daily price series kept as an array inside each payload: metrics in the row, or exploded rows.

The array holds one requested range of sessions (about 63 points), so it stays in its row and
the metrics need no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickermill import schemas
from tickermill.functions.coercion import conform
from tickermill.functions.guards import finite, number, safe_multiply, sane

# Fixed values.
SESSIONS_PER_YEAR = 252
LIQUIDITY_SESSIONS = 42
MIN_SERIES_POINTS = 20
LIQUIDITY_MEASURED = "serie_brapi_3mo"
LIQUIDITY_SAMPLE_TOO_SMALL = "amostra_insuficiente"

POINT_FIELDS = ("date", "open", "high", "low", "close", "volume", "adjustedClose")
POINT_DDL = ", ".join(f"{name}: STRING" for name in POINT_FIELDS)


def valid_points(history: Column) -> Column:
    """Array of points as text to numeric points; points without a valid close are dropped."""
    numeric = F.transform(
        history, lambda point: F.struct(*[number(point[name]).alias(name) for name in POINT_FIELDS])
    )
    return F.filter(numeric, lambda point: point["close"].isNotNull())


def parsed_one_by_one(texts: Column) -> Column:
    """Points of an array of JSON texts; what is no object becomes an empty point."""
    return F.transform(texts, lambda text: F.from_json(text, f"STRUCT<{POINT_DDL}>"))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, value: total + value)


def with_series_metrics(df: DataFrame, points: str) -> DataFrame:
    """Add point count, mean traded value and annualised volatility from an array of points.

    Points are used in array order. Fewer than 20 points give NULL metrics, and so do fewer
    than 19 returns for the volatility.
    """
    recent = F.slice(
        F.col(points),
        F.greatest(F.col("pontos_serie") - (LIQUIDITY_SESSIONS - 1), F.lit(1)),
        F.lit(LIQUIDITY_SESSIONS),
    )
    enough = F.col("pontos_serie") >= MIN_SERIES_POINTS
    staged = (
        df.withColumn("pontos_serie", F.coalesce(F.size(points), F.lit(0)))
        .withColumns(
            {
                "_traded": F.filter(
                    F.transform(recent, lambda p: safe_multiply(p["close"], p["volume"])),
                    lambda value: value.isNotNull(),
                ),
                "_prices": F.filter(
                    F.transform(F.col(points), lambda p: F.coalesce(p["adjustedClose"], p["close"])),
                    lambda price: price > 0,
                ),
            }
        )
        .withColumn(
            "_returns",
            F.when(
                enough & (F.size("_prices") >= MIN_SERIES_POINTS),
                F.zip_with(
                    F.slice("_prices", F.lit(2), F.size("_prices") - 1),
                    F.slice("_prices", F.lit(1), F.size("_prices") - 1),
                    lambda after, before: after / before - 1.0,
                ),
            ),
        )
        .withColumn("_mean", _total(F.col("_returns")) / F.size("_returns"))
        .withColumn(
            "_variance",
            _total(F.transform("_returns", lambda r: (r - F.col("_mean")) * (r - F.col("_mean"))))
            / (F.size("_returns") - 1),
        )
    )
    measured = enough & (F.size("_traded") > 0)
    return staged.withColumns(
        {
            "liquidez_2meses": F.when(measured, finite(_total(F.col("_traded")) / F.size("_traded"))),
            "liquidez_2meses_origem": F.when(measured, LIQUIDITY_MEASURED).otherwise(
                LIQUIDITY_SAMPLE_TOO_SMALL
            ),
            "volatilidade_anualizada": sane(
                "volatilidade_anualizada",
                finite(F.sqrt("_variance") * F.sqrt(F.lit(float(SESSIONS_PER_YEAR)))),
            ),
        }
    ).drop("_traded", "_prices", "_returns", "_mean", "_variance")


def epoch_to_date(epoch_seconds: Column) -> Column:
    """UTC calendar date as text, whatever the session time zone is."""
    days = F.floor(epoch_seconds / 86400).try_cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days).cast("string")


def price_rows(df: DataFrame, points: str) -> DataFrame:
    """One `silver_precos_brapi` row per point that has a date."""
    exploded = df.select("ticker", "data_coleta", "fonte", F.explode(points).alias("p"))
    return conform(
        exploded.where(F.col("p.date").isNotNull()).select(
            "ticker",
            F.col("p.open").alias("abertura"),
            F.col("p.high").alias("maxima"),
            F.col("p.low").alias("minima"),
            F.col("p.close").alias("fechamento"),
            F.col("p.adjustedClose").alias("fechamento_ajustado"),
            F.col("p.volume").alias("volume"),
            "data_coleta",
            "fonte",
            epoch_to_date(F.col("p.date")).alias("data_pregao"),
        ),
        schemas.SERIES,
    )
