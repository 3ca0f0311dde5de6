"""Questions asked of the silver and gold tables.

Functions that answer for one run take the rows of that run; read them with
`tables.latest_partition`, or narrow any DataFrame with `latest`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickermill.functions.formatting import heat_level
from tickermill.operators.dedup import top_per_key
from tickermill.operators.scoring import SIGNALS, technical_signal

# Output names of the coverage report and of the two feeds.
COVERAGE_LABELS = {
    "preco_lucro": "preco_lucro",
    "preco_valor_patrimonial": "p_vp",
    "psr": "psr",
    "dividend_yield": "div_yield",
    "preco_ativo": "p_ativo",
    "preco_capital_giro": "p_cap_giro",
    "preco_ebit": "p_ebit",
    "preco_ativo_circ_liquido": "p_acl",
    "ev_ebit": "ev_ebit",
    "ev_ebitda": "ev_ebitda",
    "margem_bruta": "mrg_bruta",
    "margem_ebit": "mrg_ebit",
    "margem_liquida": "mrg_liq",
    "liq_corrente": "liq_corr",
    "roic": "roic",
    "roe": "roe",
    "liquidez_2meses": "liq_2m",
    "patrimonio_liquido": "patrim_liq",
    "divida_liquida_patrimonio": "div_liq_patrim",
    "cresc_receita_5a": "cresc_5a",
}
REAL_FEED, SYNTHETIC_FEED = "brapi (real)", "producer (sintetico)"
PILLARS = (
    ("score_valuation", "Valuation"),
    ("score_rentabilidade", "Rentabilidade"),
    ("score_solidez", "Solidez"),
    ("score_dividendos", "Dividendos"),
)

_c = F.col


def latest(df: DataFrame, column: str) -> DataFrame:
    """Rows of the largest value of a partition column, as a scalar subquery."""
    return df.where(_c(column) == df.agg(F.max(column)).scalar())


def run_census(gold: DataFrame) -> DataFrame:
    return (
        gold.groupBy("data_referencia")
        .agg(
            F.count("*").alias("ativos"),
            F.count("score_final").alias("com_score"),
            F.count_if(_c("fonte") == "brapi").alias("dados_reais"),
            F.count_if(_c("fonte") == "sintetico").alias("dados_sinteticos"),
        )
        .orderBy(_c("data_referencia").desc_nulls_last())
    )


def ranking(gold_run: DataFrame) -> DataFrame:
    return gold_run.orderBy(_c("score_final").desc_nulls_last(), "ticker").select(
        "ticker",
        "nota",
        F.round("score_final", 1).alias("score"),
        F.round("score_valuation", 0).alias("valuation"),
        F.round("score_rentabilidade", 0).alias("rentabilidade"),
        F.round("score_solidez", 0).alias("solidez"),
        F.round("score_dividendos", 0).alias("dividendos"),
        "setor",
        "porte",
        "perfil_risco",
        "perfil_investidor",
        "grupo_usado",
        "n_grupo",
        "confianca",
        "fonte",
    )


def best_per_sector(gold_run: DataFrame, k: int = 3) -> DataFrame:
    best = top_per_key(
        gold_run.where(_c("score_final").isNotNull()),
        ["setor"],
        [_c("score_final").desc_nulls_last(), _c("ticker").asc()],
        k,
    )
    return best.orderBy(_c("setor").asc_nulls_last(), "posicao").select(
        "setor", "ticker", "nota", F.round("score_final", 1).alias("score"), "perfil_investidor"
    )


def screener_listing(screener: DataFrame) -> DataFrame:
    return screener.orderBy(_c("Score").desc_nulls_last(), "Papel")


def grade_distribution(gold_run: DataFrame) -> DataFrame:
    return (
        gold_run.groupBy("nota")
        .agg(
            F.count("*").alias("ativos"),
            F.round(F.min("score_final"), 1).alias("score_min"),
            F.round(F.max("score_final"), 1).alias("score_max"),
        )
        .orderBy(_c("nota").asc_nulls_last())
    )


def indicator_coverage(silver_run: DataFrame) -> DataFrame:
    return silver_run.agg(
        F.count("*").alias("total"),
        *[F.count(name).alias(label) for name, label in COVERAGE_LABELS.items()],
    )


def provenance(silver_run: DataFrame) -> DataFrame:
    return silver_run.orderBy(_c("cobertura_campos_pct").desc_nulls_last(), "ticker").select(
        "ticker",
        "fonte",
        "preco_ativo_origem",
        "roic_origem",
        "dividend_yield_origem",
        "liquidez_2meses_origem",
        "cresc_receita_origem",
        "pontos_serie",
        F.round("cobertura_campos_pct", 2).alias("cobertura"),
        "motivo_inelegibilidade",
    )


def below_graham(gold_run: DataFrame) -> DataFrame:
    return (
        gold_run.where("flag_graham")
        .orderBy(_c("margem_seguranca").desc_nulls_last(), "ticker")
        .select(
            "ticker",
            F.round("cotacao", 2).alias("cotacao"),
            F.round("valor_graham", 2).alias("valor_graham"),
            F.round(_c("margem_seguranca") * 100, 1).alias("margem_seguranca_pct"),
            "nota",
            "fonte",
        )
    )


def below_bazin(gold_run: DataFrame) -> DataFrame:
    discount = F.round((F.try_divide(_c("preco_teto_bazin"), _c("cotacao")) - 1) * 100, 1)
    return (
        gold_run.where("flag_bazin")
        .select(
            "ticker",
            F.round("cotacao", 2).alias("cotacao"),
            F.round("preco_teto_bazin", 2).alias("preco_teto"),
            discount.alias("desconto_pct"),
            "nota",
            "perfil_investidor",
        )
        .orderBy(_c("desconto_pct").desc_nulls_last(), "ticker")
    )


def magic_formula_best(gold_run: DataFrame, silver_run: DataFrame, n: int = 10) -> DataFrame:
    g, i = gold_run.alias("g"), silver_run.alias("i")
    on = (_c("i.ticker") == _c("g.ticker")) & (_c("i.data_coleta") == _c("g.data_referencia"))
    return (
        g.where(_c("rank_magic_formula").isNotNull())
        .join(i, on, "inner")
        .select(
            "g.ticker",
            "g.rank_magic_formula",
            F.round("i.ev_ebit", 2).alias("ev_ebit"),
            F.round(_c("i.roic") * 100, 1).alias("roic_pct"),
            "g.nota",
            "g.fonte",
        )
        .orderBy(_c("rank_magic_formula").asc_nulls_last(), "ticker")
        .limit(n)
    )


def flag_screen(gold_run: DataFrame) -> DataFrame:
    return (
        gold_run.where("flag_pl_barato AND flag_roe_bom AND flag_endiv_ok")
        .orderBy(_c("score_final").desc_nulls_last(), "ticker")
        .select(
            "ticker", "nota", F.round("score_final", 1).alias("score"), "setor", "perfil_investidor"
        )
    )


def score_evolution(gold: DataFrame) -> DataFrame:
    """Score change between runs; a ticker has one row per run, so the windows stay small."""
    runs = W.partitionBy("ticker").orderBy("data_referencia")
    return (
        gold.where(_c("score_final").isNotNull())
        .select(
            "ticker",
            "data_referencia",
            F.round("score_final", 1).alias("score"),
            "nota",
            F.round(_c("score_final") - F.lag("score_final").over(runs), 1).alias("variacao"),
        )
        .orderBy("ticker", _c("data_referencia").desc_nulls_last())
    )


def idempotency_check(silver: DataFrame) -> DataFrame:
    """Rows against distinct tickers per run; they differ if a rerun has duplicated rows."""
    return (
        silver.groupBy("data_coleta", "ticker")
        .agg(F.count("*").alias("_n"))
        .groupBy("data_coleta")
        .agg(F.sum("_n").alias("linhas"), F.count("ticker").alias("tickers"))
        .orderBy(_c("data_coleta").desc_nulls_last())
    )


def silver_summary(silver: DataFrame, series: DataFrame) -> DataFrame:
    """Rows, rows that may be scored and daily prices per run."""
    rows = silver.groupBy("data_coleta").agg(
        F.count("*").alias("linhas"), F.count_if("elegivel_score").alias("elegiveis")
    )
    prices = series.groupBy("data_coleta").agg(F.count("*").alias("_n"))
    return (
        rows.join(prices, "data_coleta", "left")
        .select("data_coleta", "linhas", "elegiveis", F.coalesce("_n", F.lit(0)).alias("pregoes"))
        .orderBy(_c("data_coleta").desc_nulls_last())
    )


def series_coverage(real_series: DataFrame, ticks: DataFrame) -> DataFrame:
    """Sessions per ticker of the real series beside those of the tick feed."""
    days = ticks.groupBy("ticker", "data_pregao").agg(F.lit(1).alias("_one"))

    def span(df: DataFrame, label: str) -> DataFrame:
        return df.groupBy("ticker").agg(
            F.count("data_pregao").alias("pregoes"),
            F.min("data_pregao").alias("de"),
            F.max("data_pregao").alias("ate"),
        ).select(F.lit(label).alias("origem"), "ticker", "pregoes", "de", "ate")

    return (
        span(real_series.select("ticker", "data_pregao"), REAL_FEED)
        .unionByName(span(days, SYNTHETIC_FEED))
        .orderBy("origem", _c("ticker").asc_nulls_last())
    )


def dashboard_extract(gold_run: DataFrame, silver_run: DataFrame) -> DataFrame:
    """Gold rows with six silver indicators and the technical signal, best score first."""
    extra = silver_run.select(
        "ticker",
        "data_coleta",
        "preco_lucro",
        "preco_valor_patrimonial",
        "dividend_yield",
        "roe",
        "divida_liquida_patrimonio",
        _c("liquidez_2meses").alias("_liquidez"),
    ).alias("i")
    g = gold_run.alias("g")
    on = (_c("i.ticker") == _c("g.ticker")) & (_c("i.data_coleta") == _c("g.data_referencia"))
    gold_columns = [
        "ticker",
        "nota",
        "score_final",
        "score_valuation",
        "score_rentabilidade",
        "score_solidez",
        "score_dividendos",
        "setor",
        "porte",
        "perfil_risco",
        "perfil_investidor",
        "confianca",
        "cobertura_indicadores_pct",
        "grupo_usado",
        "n_grupo",
        "margem_seguranca",
        "valor_graham",
        "preco_teto_bazin",
        "cotacao",
        "elegivel_score",
        "fonte",
        "rank_magic_formula",
        "data_referencia",
    ]
    return (
        g.join(extra, on, "left")
        .select(
            *[f"g.{name}" for name in gold_columns],
            "preco_lucro",
            "preco_valor_patrimonial",
            "dividend_yield",
            "roe",
            "divida_liquida_patrimonio",
            _c("_liquidez").alias("liquidez_2meses"),
        )
        .withColumn("sinal", technical_signal())
        .orderBy(_c("score_final").desc_nulls_last(), "ticker")
    )


def dashboard_kpis(extract: DataFrame) -> DataFrame:
    """Universe size, scored rows, rows with real data and rows per signal, zeros included."""
    return extract.agg(
        F.count("*").alias("ativos"),
        F.count("score_final").alias("com_score"),
        F.count_if(_c("fonte") == "brapi").alias("dados_reais"),
        *[F.count_if(_c("sinal") == s).alias(f"sinal_{s.lower()}") for s in SIGNALS],
    )


def signal_counts(extract: DataFrame) -> DataFrame:
    """Rows per signal; all four labels appear."""
    labels = F.explode(F.array(*[F.lit(s) for s in SIGNALS]))
    spark = extract.sparkSession
    fixed = spark.range(1).select(labels.alias("sinal"))
    counts = extract.groupBy("sinal").agg(F.count("*").alias("_n"))
    return (
        fixed.join(counts, "sinal", "left")
        .select("sinal", F.coalesce("_n", F.lit(0)).alias("ativos"))
        .orderBy("sinal")
    )


def dashboard_heatmap(extract: DataFrame) -> DataFrame:
    """One cell per scored row and pillar, with its colour step (0 = no data)."""
    cells = F.array(
        *[
            F.struct(F.lit(label).alias("pilar"), _c(name).alias("valor"))
            for name, label in PILLARS
        ]
    )
    return (
        extract.where(_c("score_final").isNotNull())
        .select("ticker", F.inline(cells))
        .withColumn("faixa", heat_level(_c("valor")))
    )
