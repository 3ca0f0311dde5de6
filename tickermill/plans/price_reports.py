"""Queries over the price feed (`precos_acoes`).

Ties are decided by the columns in `TIEBREAK` that the feed has, so every result is repeatable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickermill.operators.dedup import top_per_key

TIEBREAK = ("evento_ts", "event_id", "data_pregao")


def _tiebreak(prices: DataFrame) -> list[Column]:
    return [F.col(name).desc_nulls_last() for name in TIEBREAK if name in prices.columns]


def sample_rows(prices: DataFrame, n: int = 10) -> DataFrame:
    return prices.limit(n)


def events_per_day(prices: DataFrame) -> DataFrame:
    return (
        prices.groupBy("data_pregao")
        .agg(F.count("*").alias("qtd_eventos"))
        .orderBy(F.col("data_pregao").desc_nulls_last())
    )


def last_close(prices: DataFrame) -> DataFrame:
    latest = top_per_key(
        prices, ["ticker"], [F.col("evento_ts").desc_nulls_last(), *_tiebreak(prices)[1:]]
    )
    return latest.select("ticker", "data_pregao", "fechamento", "evento_ts").orderBy(
        F.col("ticker").asc_nulls_last()
    )


def intraday_moves(prices: DataFrame, n: int = 10) -> DataFrame:
    """Largest open-to-close moves; a zero open gives no move."""
    change = F.round(
        F.try_divide(F.col("fechamento") - F.col("abertura"), F.col("abertura")) * 100, 2
    )
    return (
        prices.withColumn("variacao_pct", change)
        .orderBy(F.col("variacao_pct").desc_nulls_last(), *_tiebreak(prices))
        .select("ticker", "data_pregao", "abertura", "fechamento", "variacao_pct")
        .limit(n)
    )


def period_stats(prices: DataFrame) -> DataFrame:
    """Mean, extremes and total per ticker; the mean is summed exactly, whatever the row order."""
    total = F.sum(F.col("fechamento").try_cast("decimal(28,6)")).cast("double")
    return (
        prices.groupBy("ticker")
        .agg(
            F.round(F.try_divide(total, F.count("fechamento")), 2).alias("preco_medio"),
            F.round(F.max("maxima"), 2).alias("maxima_periodo"),
            F.round(F.min("minima"), 2).alias("minima_periodo"),
            F.sum("volume").alias("volume_total"),
        )
        .orderBy(F.col("volume_total").desc_nulls_last(), "ticker")
    )


def peak_volume_day(prices: DataFrame) -> DataFrame:
    top = top_per_key(prices, ["ticker"], [F.col("volume").desc_nulls_last(), *_tiebreak(prices)])
    return top.select("ticker", "data_pregao", "volume").orderBy(
        F.col("volume").desc_nulls_last(), "ticker"
    )
