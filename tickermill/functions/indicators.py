"""Quote payload (JSON text) to typed fundamental indicators with provenance.

Each stage is a `withColumns` over plain columns of the stage before, so that a value used
several times is computed once; everything is row-local and needs no shuffle.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickermill import schemas
from tickermill.functions import categories, series
from tickermill.functions.coercion import conform
from tickermill.functions.guards import (
    SANITY_BOUNDS,
    blank_to_null,
    finite,
    finite_sql,
    first_valid,
    parse_number_sql,
    safe_divide,
    safe_multiply,
    sane,
    strip,
)

# Payload fields read, tax rate, labels and coverage rule.
ROOT_NUMBERS = ("regularMarketPrice", "marketCap", "earningsPerShare")
STATISTICS_NUMBERS = (
    "enterpriseValue", "enterpriseToEbitda", "profitMargins", "sharesOutstanding",
    "impliedSharesOutstanding", "beta", "bookValue", "netIncomeToCommon", "trailingEps",
    "earningsPerShare", "marketCap", "dividendYield", "yield", "returnOnEquity",
)
FINANCIAL_NUMBERS = (
    "currentPrice", "totalCash", "totalDebt", "ebitda", "totalRevenue", "debtToEquity",
    "currentRatio", "returnOnAssets", "returnOnEquity", "grossProfits", "grossMargins",
    "ebitdaMargins", "operatingMargins", "profitMargins", "revenueGrowth",
)
INCOME_TAX_RATE = 0.34
DEFAULT_SOURCE = "brapi"
REQUESTED_MODULES = "defaultKeyStatistics,financialData,summaryProfile"
UNAVAILABLE = "indisponivel"
CORE_FIELDS = (
    "preco_lucro", "preco_valor_patrimonial", "psr", "preco_ativo", "ev_ebit", "roe", "roic",
    "margem_liquida", "margem_ebit", "divida_liquida_patrimonio", "divida_liquida_ebitda",
    "liq_corrente", "dividend_yield",
)
MIN_CORE_COVERAGE = 0.30


def _strings(names) -> str:
    return ", ".join(f"`{name}`: STRING" for name in names)


# Number leaves stay STRING: a DOUBLE leaf would reject numeric text, and a variant would
# accept booleans.
PAYLOAD_DDL = (
    "symbol STRING, shortName STRING, longName STRING, "
    + ", ".join(f"{name} STRING" for name in ROOT_NUMBERS)
    + ", summaryProfile STRUCT<sector: STRING, industry: STRING>"
    + f", defaultKeyStatistics STRUCT<{_strings(STATISTICS_NUMBERS)}>"
    + f", financialData STRUCT<{_strings(FINANCIAL_NUMBERS)}>"
    + f", historicalDataPrice ARRAY<STRUCT<{series.POINT_DDL}>>"
)

_LEAVES = {
    **{f"r_{name}": f"_payload.{name}" for name in ROOT_NUMBERS},
    **{f"k_{name}": f"_payload.defaultKeyStatistics.`{name}`" for name in STATISTICS_NUMBERS},
    **{f"f_{name}": f"_payload.financialData.`{name}`" for name in FINANCIAL_NUMBERS},
}

# The volatility is bounded where it is computed, in the series.
_BOUNDED = [name for name in SANITY_BOUNDS if name != "volatilidade_anualizada"]


def parse_payload(bronze: DataFrame, run_date: str = "") -> DataFrame:
    """Bronze envelopes with the payload parsed once; bad or missing JSON gives empty fields.

    Rows without a run date take `run_date`, or today's date in UTC.
    """
    run_date = run_date or datetime.now(timezone.utc).date().isoformat()
    return bronze.select(
        "ticker",
        F.coalesce(blank_to_null(F.col("fonte")), F.lit(DEFAULT_SOURCE)).alias("fonte"),
        "coletado_em",
        F.coalesce(blank_to_null(F.col("data_coleta")), F.lit(run_date)).alias("data_coleta"),
        F.from_json("payload_json", PAYLOAD_DDL).alias("_payload"),
        "payload_json",
    ).withColumn("_points", _points())


def _points():
    """Valid points of the series. One element that is no object nulls the whole typed array; only
    such payloads are read once more, element by element."""
    typed = F.col("_payload.historicalDataPrice")
    odd = typed.isNull() & F.col("payload_json").contains('"historicalDataPrice"')
    texts = F.from_json("payload_json", "historicalDataPrice ARRAY<STRING>")["historicalDataPrice"]
    return series.valid_points(F.coalesce(typed, F.when(odd, series.parsed_one_by_one(texts))))


def _origin(present, label: str):
    return F.when(present.isNotNull(), label).otherwise(UNAVAILABLE)


def _zero(column):
    return F.coalesce(column, F.lit(0.0))


def parsed_envelopes(bronze: DataFrame, run_date: str = "") -> DataFrame:
    """All that the layers need of a payload, as typed columns: numbers, names and the series' points.

    `ticker` is the envelope's, `_ticker` the normalised one. Written once, it saves the second parse of
    the texts when both indicators and series are made.
    """
    c = F.col
    raw = parse_payload(bronze, run_date).select(
        "ticker",
        F.upper(
            strip(
                F.coalesce(blank_to_null(c("ticker")), blank_to_null(c("_payload.symbol")), F.lit(""))
            )
        ).alias("_ticker"),
        F.coalesce(
            blank_to_null(c("_payload.longName")), blank_to_null(c("_payload.shortName"))
        ).alias("nome_longo"),
        blank_to_null(c("_payload.summaryProfile.sector")).alias("setor"),
        blank_to_null(c("_payload.summaryProfile.industry")).alias("industria"),
        "fonte",
        "coletado_em",
        "data_coleta",
        "_points",
        *[F.expr(f"{parse_number_sql(path)} AS {name}") for name, path in _LEAVES.items()],
    )
    # A step of its own, so that each text is parsed once.
    return raw.selectExpr(
        *[name for name in raw.columns if name not in _LEAVES],
        *[f"{finite_sql(name)} AS {name}" for name in _LEAVES],
    )


def indicators(bronze: DataFrame, run_date: str = "") -> DataFrame:
    """One `silver_indicadores_fundamentalistas` row per envelope, failed fetches included."""
    return indicators_of(parsed_envelopes(bronze, run_date))


def indicators_of(parsed: DataFrame) -> DataFrame:
    """`indicators` from `parsed_envelopes`."""
    c = F.col
    inputs = parsed.withColumns(
        {
            "ticker": c("_ticker"),
            "cotacao": first_valid(c("r_regularMarketPrice"), c("f_currentPrice")),
            "lpa": first_valid(
                c("r_earningsPerShare"), c("k_earningsPerShare"), c("k_trailingEps")
            ),
            "vpa": c("k_bookValue"),
            "acoes_emitidas": first_valid(
                c("k_sharesOutstanding"), c("k_impliedSharesOutstanding")
            ),
            "receita_total": c("f_totalRevenue"),
            "divida_total": c("f_totalDebt"),
            "caixa_total": c("f_totalCash"),
            "lucro_liquido": c("k_netIncomeToCommon"),
            "_margin": c("f_operatingMargins"),
        }
    )
    amounts = inputs.withColumns(
        {
            # Recomputed from the quote: the ready-made market values lag behind it.
            "valor_mercado": first_valid(
                safe_multiply(c("cotacao"), c("acoes_emitidas")),
                c("k_marketCap"),
                c("r_marketCap"),
            ),
            "patrimonio_liquido": safe_multiply(c("vpa"), c("acoes_emitidas")),
            "ebit_estimado": safe_multiply(c("receita_total"), c("_margin")),
            "ebitda": first_valid(
                c("f_ebitda"), safe_multiply(c("receita_total"), c("f_ebitdaMargins"))
            ),
            "ativo_total_estimado": safe_divide(c("lucro_liquido"), c("f_returnOnAssets")),
            "_net_debt": c("divida_total") - _zero(c("caixa_total")),
        }
    ).withColumns(
        {
            "enterprise_value": first_valid(
                c("k_enterpriseValue"),
                finite(
                    c("valor_mercado") + _zero(c("divida_total")) - _zero(c("caixa_total"))
                ),
            ),
            "_capital": _zero(c("divida_total")) + c("patrimonio_liquido"),
            "_ebit_after_tax": safe_multiply(c("ebit_estimado"), F.lit(1.0 - INCOME_TAX_RATE)),
        }
    )
    unavailable = F.lit(None).cast("double")
    ratios = amounts.withColumns(
        {
            "preco_lucro": safe_divide(c("cotacao"), c("lpa")),
            "preco_valor_patrimonial": safe_divide(c("cotacao"), c("vpa")),
            "psr": safe_divide(c("valor_mercado"), c("receita_total")),
            "dividend_yield": first_valid(c("k_dividendYield"), c("k_yield")),
            "preco_ativo": safe_divide(c("valor_mercado"), c("ativo_total_estimado")),
            "preco_capital_giro": unavailable,
            "preco_ebit": safe_divide(c("valor_mercado"), c("ebit_estimado")),
            "preco_ativo_circ_liquido": unavailable,
            "ev_ebit": safe_divide(c("enterprise_value"), c("ebit_estimado")),
            "ev_ebitda": first_valid(
                c("k_enterpriseToEbitda"), safe_divide(c("enterprise_value"), c("ebitda"))
            ),
            "margem_bruta": first_valid(
                c("f_grossMargins"), safe_divide(c("f_grossProfits"), c("receita_total"))
            ),
            "margem_ebit": c("_margin"),
            "margem_liquida": first_valid(c("f_profitMargins"), c("k_profitMargins")),
            "liq_corrente": c("f_currentRatio"),
            "roic": safe_divide(c("_ebit_after_tax"), c("_capital")),
            "roe": first_valid(
                c("f_returnOnEquity"),
                c("k_returnOnEquity"),
                safe_divide(c("lucro_liquido"), c("patrimonio_liquido")),
            ),
            "divida_liquida_patrimonio": safe_divide(c("_net_debt"), c("patrimonio_liquido")),
            "cresc_receita_5a": unavailable,
            "margem_ebitda": first_valid(
                c("f_ebitdaMargins"), safe_divide(c("ebitda"), c("receita_total"))
            ),
            "divida_bruta_patrimonio": first_valid(
                c("f_debtToEquity"), safe_divide(c("divida_total"), c("patrimonio_liquido"))
            ),
            "divida_liquida_ebitda": safe_divide(c("_net_debt"), c("ebitda")),
            "cresc_receita_12m": c("f_revenueGrowth"),
            "retorno_sobre_ativos": c("f_returnOnAssets"),
            "beta": c("k_beta"),
        }
    )
    # Bounds come last, so no formula above sees a bounded input.
    bounded = ratios.withColumns(
        {name: sane(name, c(name)) for name in _BOUNDED}
    )
    labelled = series.with_series_metrics(bounded, "_points").withColumns(
        {
            "classe_ativo": categories.asset_class(c("ticker")),
            "setor_financeiro": categories.is_financial(c("setor"), c("industria")),
            "lucro_negativo": F.coalesce(c("lpa") <= 0, F.lit(False)),
            "preco_ativo_origem": _origin(c("ativo_total_estimado"), "estimado_por_roa"),
            "roic_origem": _origin(c("roic"), "ebit_pos_ir_sobre_capital"),
            "dividend_yield_origem": _origin(c("dividend_yield"), DEFAULT_SOURCE),
            "cresc_receita_origem": _origin(c("cresc_receita_12m"), "proxy_12m"),
        }
    )
    return conform(with_eligibility(labelled), schemas.SILVER)


def with_eligibility(df: DataFrame) -> DataFrame:
    """Coverage of the core fields and whether, and if not why not, a row may be scored."""
    filled = F.expr(" + ".join(f"INT({name} IS NOT NULL)" for name in CORE_FIELDS))
    return (
        df.withColumn("cobertura_campos_pct", filled / F.lit(float(len(CORE_FIELDS))))
        .withColumn(
            "motivo_inelegibilidade",
            F.when(
                F.col("classe_ativo").isin(*categories.UNSUPPORTED_CLASSES), "classe_nao_suportada"
            )
            .when(F.col("cotacao").isNull(), "sem_cotacao")
            .when(F.col("cobertura_campos_pct") < MIN_CORE_COVERAGE, "dados_insuficientes"),
        )
        .withColumn("elegivel_score", F.col("motivo_inelegibilidade").isNull())
    )


def price_series(bronze: DataFrame, run_date: str = "") -> DataFrame:
    """Daily price rows of every payload; parses only the series part of the JSON."""
    return series.price_rows(parse_payload(bronze, run_date), "_points")
