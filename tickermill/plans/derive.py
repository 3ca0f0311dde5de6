"""Market data derived from general-purpose tables (`part`, `lineitem`, `events`).

Gives every layer of the engine realistic input with missing values, failed fetches, malformed
payloads and repeated collections, in proportion to the tables it reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickermill.functions.indicators import (
    FINANCIAL_NUMBERS,
    REQUESTED_MODULES,
    ROOT_NUMBERS,
    STATISTICS_NUMBERS,
)

# One row per part and shipping year. The text runs unchanged on any engine with ANSI CASE,
# `%` and DECIMAL sums; literals with an exponent are DOUBLE.
ASSETS_SQL = """
WITH sold AS (
  SELECT l_partkey AS k, CAST(year(l_shipdate) AS BIGINT) AS y,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(15,2))
                  * CAST(1 - CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(4,2))) AS DOUBLE) AS revenue,
         CAST(SUM(CAST(l_quantity AS DECIMAL(15,2))) AS DOUBLE) AS qty,
         CAST(SUM(CAST(l_discount AS DECIMAL(15,2))) AS DOUBLE) / COUNT(*) AS disc,
         CAST(SUM(CAST(l_tax AS DECIMAL(15,2))) AS DOUBLE) / COUNT(*) AS tax
  FROM {lineitem} GROUP BY 1, 2
),
base AS (
  SELECT k, y, revenue, qty, disc, tax, p_name, p_brand, p_type, p_retailprice AS price,
         CAST(p_size AS DOUBLE) AS sz, revenue / 1000e0 - 80e0 AS eps,
         500000e0 * CAST(p_size AS DOUBLE) * (1 + k % 4) AS shares
  FROM sold JOIN {part} ON p_partkey = k
),
named AS (
  SELECT *, 'P' || CAST(k AS STRING) || 'X' ||
         CASE k % 10 WHEN 0 THEN '11' WHEN 1 THEN '34' WHEN 2 THEN '3' WHEN 3 THEN '3'
                     WHEN 4 THEN '3' ELSE '4' END AS symbol,
         CASE WHEN k % 53 = 0 THEN 'failed' WHEN k % 59 = 0 THEN 'junk' ELSE 'ok' END AS fetched
  FROM base
)
SELECT k, y, fetched, symbol, CAST(y AS STRING) || '-12-31' AS data_coleta,
  CASE WHEN k % 61 = 0 THEN lower(symbol) || ' ' ELSE symbol END AS ticker,
  CASE WHEN k % 500 = 7 THEN 'rare4' WHEN k % 100 = 13 THEN 'rare20'
       WHEN k % 21 = 0 AND y % 2 = 1 THEN 'brapi'
       WHEN k % 3 = 0 THEN 'sintetico' WHEN k % 71 = 0 THEN NULL WHEN k % 71 = 1 THEN ''
       ELSE 'brapi' END AS fonte,
  CASE WHEN k % 23 = 0 THEN NULL WHEN k % 23 = 1 THEN '' ELSE p_name END AS "longName",
  p_name || ' SA' AS "shortName",
  CASE WHEN k % 500 = 13 THEN 'Banco Raro' WHEN k % 41 = 0 OR k % 100 = 13 THEN NULL
       WHEN k % 17 = 0 THEN 'Micro ' || p_brand WHEN p_type = 'PROMO' THEN 'Banco Promo'
       ELSE p_type END AS sector,
  CASE WHEN k % 83 = 0 THEN NULL WHEN k % 19 = 0 THEN 'Seguradoras' ELSE p_brand END AS industry,
  CASE WHEN k % 29 <> 0 THEN price END AS "r_regularMarketPrice",
  shares * price * 1.05e0 AS "r_marketCap",
  CASE WHEN k % 3 <> 1 AND k % 89 <> 0 THEN eps END AS "r_earningsPerShare",
  CASE WHEN k % 3 <> 0 THEN shares * price * 1.3e0 END AS "k_enterpriseValue",
  CASE WHEN k % 4 <> 1 THEN 5e0 + sz / 10e0 END AS "k_enterpriseToEbitda",
  CASE WHEN k % 18 <> 0 THEN disc * 1.9e0 END AS "k_profitMargins",
  CASE WHEN k % 8 <> 3 THEN shares END AS "k_sharesOutstanding",
  CASE WHEN k % 16 <> 3 THEN shares END AS "k_impliedSharesOutstanding",
  CASE k % 50 WHEN 1 THEN 'abc' WHEN 2 THEN 'true' WHEN 3 THEN '2.5d' WHEN 4 THEN 'NaN'
              ELSE CAST(sz / 25e0 AS STRING) END AS "k_beta",
  CASE WHEN k % 67 = 0 THEN NULL WHEN k % 73 = 0 THEN -qty ELSE 200e0 + 10e0 * sz + qty END
    AS "k_bookValue",
  CASE WHEN k % 41 <> 5 THEN shares * eps END AS "k_netIncomeToCommon",
  CASE WHEN k % 89 <> 0 THEN eps END AS "k_trailingEps",
  CASE WHEN k % 6 <> 4 AND k % 89 <> 0 THEN eps END AS "k_earningsPerShare",
  CASE WHEN k % 32 <> 3 THEN shares * price * 0.97e0 END AS "k_marketCap",
  CASE WHEN k % 43 = 0 THEN 0.2e0 WHEN k % 47 = 0 THEN 1.5e0 WHEN k % 10 = 9 THEN NULL
       ELSE tax * 1.5e0 END AS "k_dividendYield",
  CASE WHEN k % 20 = 9 THEN tax * 1.4e0 END AS "k_yield",
  CASE WHEN k % 14 = 0 THEN disc * 1.9e0 END AS "k_returnOnEquity",
  CASE WHEN k % 58 = 0 THEN price * 1.01e0 END AS "f_currentPrice",
  CASE WHEN k % 37 <> 0 THEN shares * tax * 5000e0 END AS "f_totalCash",
  CASE WHEN k % 31 <> 0 THEN shares * sz * 20e0 END AS "f_totalDebt",
  CASE WHEN k % 6 <> 0 THEN shares * qty * 5e0 * (disc * 4e0 - 0.05e0) END AS "f_ebitda",
  CASE WHEN k % 97 = 0 THEN 0e0 ELSE shares * qty * 5e0 END AS "f_totalRevenue",
  CASE WHEN k % 5 <> 2 THEN sz / 30e0 END AS "f_debtToEquity",
  CASE WHEN k % 13 <> 0 THEN 0.5e0 + qty / 80e0 END AS "f_currentRatio",
  tax * 2e0 AS "f_returnOnAssets",
  CASE WHEN k % 7 <> 0 THEN disc * 2e0 END AS "f_returnOnEquity",
  CASE WHEN k % 15 <> 0 THEN shares * qty * 1.5e0 END AS "f_grossProfits",
  CASE WHEN k % 5 <> 0 THEN disc * 6e0 END AS "f_grossMargins",
  CASE WHEN k % 12 <> 0 THEN disc * 4e0 - 0.05e0 END AS "f_ebitdaMargins",
  CASE WHEN k % 11 = 0 THEN NULL WHEN k % 101 = 0 THEN 1.5e0 ELSE disc * 3e0 - 0.02e0 END
    AS "f_operatingMargins",
  CASE WHEN k % 9 <> 0 THEN disc * 2e0 END AS "f_profitMargins",
  CASE WHEN k % 23 <> 5 THEN (disc - 0.04e0) * 5e0 END AS "f_revenueGrowth"
FROM named
"""


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ticks(spark: SparkSession, folder: str) -> DataFrame:
    """`precos_acoes` rows from `events`; `evento_ts` stays a timestamp, `event_id` breaks ties."""
    k = F.get_json_object("props", "$.k").cast("int")
    opened = (k + 1).cast("double")
    return load(spark, folder, "events").select(
        F.concat(F.lit("U"), F.col("user_id")).alias("ticker"),
        opened.alias("abertura"),
        F.greatest(opened, F.col("value")).alias("maxima"),
        F.least(opened, F.col("value")).alias("minima"),
        F.col("value").alias("fechamento"),
        (k.cast("long") * 1000).alias("volume"),
        F.col("ts").alias("evento_ts"),
        F.date_format("ts", "yyyy-MM-dd").alias("data_pregao"),
        "event_id",
    )


def daily_bars(spark: SparkSession, folder: str) -> DataFrame:
    """One bar per user and day: the day's last tick with the day's total volume.

    Ticks jump by hundreds of percent, so most series are damped to the volatility of a stock.
    """
    moment = F.struct("evento_ts", "event_id")
    return (
        ticks(spark, folder)
        .groupBy(F.substring("ticker", 2, 20).cast("long").alias("k"), "data_pregao")
        .agg(
            F.max_by("abertura", moment).alias("open"),
            F.max("maxima").alias("high"),
            F.min("minima").alias("low"),
            F.max_by("fechamento", moment).alias("close"),
            F.sum("volume").alias("volume"),
        )
        .withColumn("date", F.unix_date(F.to_date("data_pregao")) * 86400 + 43200)
        .withColumn(
            "close",
            F.when(F.col("k") % 37 == 5, F.col("close")).otherwise(
                F.lit(100.0) + F.col("close") * (F.lit(0.01) * (1 + F.col("k") % 5))
            ),
        )
        .withColumn("adjustedClose", F.when(F.col("k") % 2 == 0, F.col("close") * 0.98))
    )


def series_per_asset(spark: SparkSession, folder: str) -> DataFrame:
    """Bars nested per asset in date order: one bar per day of the feed's month, so bounded."""
    bar = F.struct("date", "open", "high", "low", "close", "volume", "adjustedClose")
    return (
        daily_bars(spark, folder)
        .groupBy("k")
        .agg(F.sort_array(F.collect_list(bar)).alias("historicalDataPrice"))
    )


def assets(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(
        ASSETS_SQL.replace('"', "`"),
        part=load(spark, folder, "part"),
        lineitem=load(spark, folder, "lineitem"),
    )


def envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """Raw envelopes: JSON payload per part and year, every fourth one collected twice."""
    c = F.col
    joined = assets(spark, folder).join(series_per_asset(spark, folder), "k", "left")
    again = F.array(
        F.struct(F.lit(1.0).alias("factor"), F.lit("T18:00:00+00:00").alias("time")),
        F.struct(F.lit(2.0).alias("factor"), F.lit("T08:00:00+00:00").alias("time")),
    )
    collected = joined.withColumn(
        "_copy", F.explode(F.when(c("k") % 4 == 0, again).otherwise(F.slice(again, 1, 1)))
    )
    payload = F.struct(
        c("symbol"),
        c("shortName"),
        c("longName"),
        (c("r_regularMarketPrice") * c("_copy.factor")).alias("regularMarketPrice"),
        *[c(f"r_{name}").alias(name) for name in ROOT_NUMBERS if name != "regularMarketPrice"],
        F.struct("sector", "industry").alias("summaryProfile"),
        F.struct(*[c(f"k_{name}").alias(name) for name in STATISTICS_NUMBERS]).alias(
            "defaultKeyStatistics"
        ),
        F.struct(*[c(f"f_{name}").alias(name) for name in FINANCIAL_NUMBERS]).alias(
            "financialData"
        ),
        c("historicalDataPrice"),
    )
    return collected.select(
        "ticker",
        F.when(c("fetched") == "junk", "not json")
        .when(c("fetched") == "ok", F.to_json(payload))
        .alias("payload_json"),
        F.when(c("fetched") == "failed", 401).otherwise(200).alias("http_status"),
        F.lit(REQUESTED_MODULES).alias("modulos_solicitados"),
        "fonte",
        F.concat("data_coleta", "_copy.time").alias("coletado_em"),
        "data_coleta",
    )
