"""Qualitative labels: asset class, financial sector, size, risk and investor profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickermill.functions.guards import strip

# Labels, keyword list and cut-offs.
COMMON_SHARE = "ACAO_ON"
PREFERRED_SHARE = "ACAO_PN"
UNIT_OR_FUND = "UNIT_OU_FII"
DEPOSITARY_RECEIPT = "BDR"
OTHER_CLASS = "OUTRO"
UNSUPPORTED_CLASSES = (DEPOSITARY_RECEIPT, UNIT_OR_FUND, OTHER_CLASS)

FINANCIAL_KEYWORDS = (
    "financ", "banco", "bancar", "seguro", "segurad", "previdenc", "credito", "capitaliza",
)

SIZE_LIMITS = ((2_000_000_000, "MICRO"), (10_000_000_000, "SMALL"), (50_000_000_000, "MID"))
LARGEST_SIZE = "LARGE"
RISK_LIMITS = ((0.25, "BAIXO"), (0.40, "MEDIO"))
HIGHEST_RISK = "ALTO"
LOWEST_RISK = "BAIXO"
DIVIDEND_YIELD_MIN = 0.06
VALUE_VALUATION_MIN = 70.0
VALUE_SOLIDITY_MIN = 60.0
GROWTH_REVENUE_MIN = 0.15


def ladder(value: Column, limits, top: str) -> Column:
    """Label of the first limit above the value, else `top`; NULL stays NULL."""
    label = F.when(value.isNull(), F.lit(None).cast("string"))
    for limit, name in limits:
        label = label.when(value < limit, name)
    return label.otherwise(top)


def asset_class(ticker: Column) -> Column:
    """Class from the trailing digits of the ticker."""
    suffix = F.regexp_extract(F.upper(strip(ticker)), r"(\d+)$", 1)
    return (
        F.when(suffix == "3", COMMON_SHARE)
        .when(suffix.isin("4", "5", "6", "7", "8"), PREFERRED_SHARE)
        .when(suffix == "11", UNIT_OR_FUND)
        .when(suffix.rlike(r"^3\d$"), DEPOSITARY_RECEIPT)
        .otherwise(OTHER_CLASS)
    )


def is_financial(sector: Column, industry: Column) -> Column:
    text = F.lower(F.concat_ws(" ", sector, industry))
    return text.rlike("|".join(FINANCIAL_KEYWORDS))


def size_bucket(market_value: Column) -> Column:
    return ladder(F.when(market_value > 0, market_value), SIZE_LIMITS, LARGEST_SIZE)


def risk_bucket(volatility: Column) -> Column:
    return ladder(volatility, RISK_LIMITS, HIGHEST_RISK)


def investor_profile(
    dividend_yield: Column, risk: Column, valuation: Column, solidity: Column, growth: Column
) -> Column:
    """First matching thesis; a missing risk never blocks a rule."""
    return (
        F.when(
            (dividend_yield >= DIVIDEND_YIELD_MIN) & ~risk.eqNullSafe(F.lit(HIGHEST_RISK)),
            "DIVIDENDOS",
        )
        .when((valuation >= VALUE_VALUATION_MIN) & (solidity >= VALUE_SOLIDITY_MIN), "VALOR")
        .when(
            (growth >= GROWTH_REVENUE_MIN) & ~risk.eqNullSafe(F.lit(LOWEST_RISK)), "CRESCIMENTO"
        )
        .otherwise("ESPECULATIVO")
    )


def with_categories(scored: DataFrame) -> DataFrame:
    """Add the four labels to scored rows; a class already present wins."""
    known_class = F.col("classe_ativo") if "classe_ativo" in scored.columns else F.lit(None)
    risk = F.col("perfil_risco")
    return scored.withColumns(
        {
            "classe_ativo": F.coalesce(
                F.when(known_class != "", known_class), asset_class(F.col("ticker"))
            ),
            "porte": size_bucket(F.col("valor_mercado")),
            "perfil_risco": risk_bucket(F.col("volatilidade_anualizada")),
        }
    ).withColumn(
        "perfil_investidor",
        F.when(
            ~F.col("elegivel_score").eqNullSafe(F.lit(False)),
            investor_profile(
                F.col("dividend_yield"),
                risk,
                F.col("score_valuation"),
                F.col("score_solidez"),
                F.col("cresc_receita_12m"),
            ),
        ),
    )
