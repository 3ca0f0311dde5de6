"""One SQL statement per registered query."""

from __future__ import annotations

from oracle.layers import _CLASS, over
from tickermill import schemas
from tickermill.operators.scoring import SIGNALS
from tickermill.plans.reports import COVERAGE_LABELS, PILLARS
from tickermill.sources.catalog import SCREENER_COLUMNS


def r(x: str, places: int) -> str:
    """Half-up rounding of the shortest decimal form of a double, which is what Spark rounds."""
    return f"CAST(ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {places}) AS DOUBLE)"


def _columns(name: str, alias: str = "") -> str:
    return ", ".join(alias + c for c in schemas.columns(name))


_BY_TICKER = "SELECT *, ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY {order}) AS rn FROM tick"
_TIES = "evento_ts DESC, event_id DESC, data_pregao DESC"

# Every session with the values of the newest run that has it, real sources before made-up ones.
_NEWEST_SESSION = (
    "SELECT *, ROW_NUMBER() OVER (PARTITION BY ticker, data_pregao "
    "ORDER BY fonte = 'sintetico', data_coleta DESC) AS rn "
    "FROM price_row"
)

CENSUS = """
SELECT data_referencia, COUNT(*) AS ativos, COUNT(score_final) AS com_score,
       COUNT(*) FILTER (WHERE fonte = 'brapi') AS dados_reais,
       COUNT(*) FILTER (WHERE fonte = 'sintetico') AS dados_sinteticos
FROM gold GROUP BY data_referencia
"""

SCREENER = (
    "SELECT "
    + ", ".join(f'{side}.{name} AS "{label}"' for side, name, label in SCREENER_COLUMNS)
    + " FROM silver_run i LEFT JOIN gold_run g "
    "ON g.ticker = i.ticker AND g.data_referencia = i.data_coleta"
)

# Bronze after replay or streaming: newest copy per key has the single price.
BRONZE_SUMMARY = """
SELECT data_coleta, COUNT(*) AS linhas,
  COUNT(CASE WHEN fetched <> 'failed' THEN 1 END) AS com_payload,
  data_coleta || 'T18:00:00+00:00' AS ultima_coleta,
  CAST(SUM(CASE WHEN fetched = 'ok' THEN CAST("r_regularMarketPrice" AS DECIMAL(18,2)) END) AS DOUBLE)
    AS soma_precos
FROM asset GROUP BY data_coleta
"""

MIDRANKS = """
SELECT data_coleta, fonte, ticker, metrica, n_valores, percentil FROM ranked
WHERE grupo_usado <> 'universo' OR n_grupo >= 5
"""

MAGIC_POSITIONS = """
SELECT data_coleta, fonte, ticker, metrica, posicao_densa FROM (
  SELECT *, DENSE_RANK() OVER (PARTITION BY data_coleta, fonte, metrica ORDER BY v) AS posicao_densa,
         COUNT(*) OVER (PARTITION BY data_coleta, fonte, metrica) AS n
  FROM (
    SELECT data_coleta, fonte, ticker, 'ev_ebit' AS metrica, ev_ebit AS v FROM silver
    WHERE elegivel_score AND ev_ebit IS NOT NULL AND roic IS NOT NULL
    UNION ALL
    SELECT data_coleta, fonte, ticker, 'roic' AS metrica, -roic AS v FROM silver
    WHERE elegivel_score AND ev_ebit IS NOT NULL AND roic IS NOT NULL
  )
) WHERE n >= 2
"""

_EXTRACT = (
    "ticker nota score_final score_valuation score_rentabilidade score_solidez score_dividendos "
    "setor porte perfil_risco perfil_investidor confianca cobertura_indicadores_pct grupo_usado "
    "n_grupo margem_seguranca valor_graham preco_teto_bazin cotacao elegivel_score fonte "
    "rank_magic_formula data_referencia preco_lucro preco_valor_patrimonial dividend_yield roe "
    "divida_liquida_patrimonio liquidez_2meses sinal"
)

ORACLE: dict[str, str] = {
    "price_sample": over(
        "SELECT ticker, abertura, maxima, minima, fechamento, volume, evento_ts, data_pregao, event_id "
        "FROM tick ORDER BY event_id LIMIT 10",
        "tick",
    ),
    "events_per_day": over(
        "SELECT data_pregao, COUNT(*) AS qtd_eventos FROM tick GROUP BY data_pregao", "tick"
    ),
    "last_close": over(
        "SELECT ticker, data_pregao, fechamento, evento_ts FROM "
        f"({_BY_TICKER.format(order='evento_ts DESC, event_id DESC')}) WHERE rn = 1",
        "tick",
    ),
    "intraday_moves": over(
        "SELECT ticker, data_pregao, abertura, fechamento, "
        f"{r('(fechamento - abertura) / abertura * 100', 2)} AS variacao_pct FROM tick "
        f"ORDER BY variacao_pct DESC, {_TIES} LIMIT 10",
        "tick",
    ),
    "period_stats": over(
        "SELECT ticker, "
        f"{r('CAST(SUM(CAST(fechamento AS DECIMAL(28,6))) AS DOUBLE) / COUNT(*)', 2)} AS preco_medio, "
        f"{r('MAX(maxima)', 2)} AS maxima_periodo, {r('MIN(minima)', 2)} AS minima_periodo, "
        "CAST(SUM(volume) AS BIGINT) AS volume_total FROM tick GROUP BY ticker",
        "tick",
    ),
    "peak_volume_day": over(
        "SELECT ticker, data_pregao, volume FROM "
        f"({_BY_TICKER.format(order='volume DESC, ' + _TIES)}) WHERE rn = 1",
        "tick",
    ),
    "numeric_guards": """
        SELECT l_orderkey, l_linenumber, numero, numero / NULLIF(l_discount, 0) AS razao,
          CASE WHEN numero = 0 THEN 0e0 WHEN abs(numero) <= 1 THEN numero * 1e308 END AS produto,
          COALESCE(numero, l_tax) AS primeiro,
          CASE WHEN numero + l_linenumber BETWEEN 0 AND 50 THEN numero + l_linenumber END AS limitado
        FROM (SELECT *, CASE WHEN l_linenumber > 4 THEN l_quantity END AS numero FROM lineitem)""",
    "coerced_rows": """
        SELECT CAST(l_orderkey AS VARCHAR) AS ticker,
          CASE WHEN l_linenumber <> 1 THEN l_extendedprice END AS abertura,
          CASE WHEN l_quantity > 25 THEN 1e0 ELSE 0e0 END AS maxima, NULLIF(l_tax, 0) AS minima,
          CAST(NULL AS DOUBLE) AS fechamento,
          CAST(trunc(l_quantity * CAST(-1.9 AS DOUBLE)) AS BIGINT) AS volume,
          CAST(CAST(l_extendedprice AS DOUBLE) * 1000 AS VARCHAR) AS evento_ts, strftime(l_shipdate, '%Y-%m-%d') AS data_pregao
        FROM lineitem""",
    "display_labels": """
        SELECT l_orderkey, l_linenumber,
          replace(format('{:,.1f}', CAST(l_quantity AS DOUBLE) * 1234e0), ',', ' ') || ' un' AS fixo,
          CASE WHEN l_tax > 0 THEN format('{:.0f}', CAST(l_discount AS DOUBLE) * 100e0) || '%' ELSE '–' END AS parcela,
          CASE l_linenumber WHEN 1 THEN '–' WHEN 2 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' mi'
            WHEN 3 THEN '-' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '.2 bi'
            ELSE replace(format('{:,}', CAST(l_quantity * 1234 AS BIGINT)), ',', ' ') END AS valor
        FROM lineitem""",
    "raw_envelopes": """
        SELECT 'S' || s_suppkey AS ticker, CAST(CASE WHEN s_suppkey % 5 = 0 THEN 401 ELSE 200 END AS INTEGER) AS http_status,
          'defaultKeyStatistics,financialData,summaryProfile' AS modulos_solicitados, 'brapi' AS fonte,
          '2026-10-01T08:00:00' AS coletado_em, '2026-10-01' AS data_coleta,
          CASE WHEN s_suppkey % 5 <> 0 THEN s_name END AS simbolo
        FROM supplier""",
    "bronze_partition": over(
        f"SELECT * FROM ({BRONZE_SUMMARY}) WHERE data_coleta = (SELECT d FROM ("
        "SELECT data_coleta AS d, ROW_NUMBER() OVER (ORDER BY data_coleta) - 1 AS i, COUNT(*) OVER () AS n "
        "FROM (SELECT DISTINCT data_coleta FROM asset)) WHERE i = n // 2)",
        "asset",
    ),
    "asset_categories": over(
        f"""SELECT symbol, data_coleta, {_CLASS.replace('ticker', 'symbol')} AS classe_ativo,
          COALESCE(regexp_matches(lower(concat_ws(' ', sector, industry)), 'banco|seguro|segurad'), FALSE)
            AS setor_financeiro,
          CASE WHEN k_marketCap < 2e9 THEN 'MICRO' WHEN k_marketCap < 1e10 THEN 'SMALL'
               WHEN k_marketCap < 5e10 THEN 'MID' WHEN k_marketCap IS NOT NULL THEN 'LARGE' END AS porte,
          CASE WHEN f_returnOnEquity * 3 < 0.25e0 THEN 'BAIXO' WHEN f_returnOnEquity * 3 < 0.4e0
               THEN 'MEDIO' WHEN f_returnOnEquity IS NOT NULL THEN 'ALTO' END AS perfil_risco,
          CASE WHEN f_currentRatio IS NULL THEN 0 WHEN f_currentRatio * 25 < 20 THEN 1
               WHEN f_currentRatio * 25 < 40 THEN 2 WHEN f_currentRatio * 25 < 55 THEN 3
               WHEN f_currentRatio * 25 < 70 THEN 4 WHEN f_currentRatio * 25 < 85 THEN 5 ELSE 6 END
            AS faixa,
          CASE WHEN r_earningsPerShare IS NULL THEN '' WHEN r_earningsPerShare > 0 THEN 'delta-pos'
               ELSE 'delta-neg' END AS classe_margem
        FROM asset""",
        "asset",
    ),
    "bronze_latest": over(
        """SELECT ticker, CASE WHEN fetched = 'failed' THEN 401 ELSE 200 END AS http_status,
          'defaultKeyStatistics,financialData,summaryProfile' AS modulos_solicitados, fonte,
          data_coleta || 'T18:00:00+00:00' AS coletado_em, data_coleta,
          CASE WHEN fetched = 'ok' THEN "r_regularMarketPrice" END AS preco FROM asset""",
        "asset",
    ),
    "silver_indicators": over(f"SELECT {_columns(schemas.SILVER)} FROM silver", "silver"),
    "silver_prices": over(f"SELECT {_columns(schemas.SERIES)} FROM price_row", "price_row"),
    "peer_groups": over(
        "SELECT s.data_coleta, s.ticker, s.fonte, p.grupo_usado, "
        "CAST(COALESCE(p.n_grupo, 0) AS INTEGER) AS n_grupo "
        "FROM silver s LEFT JOIN peer p USING (data_coleta, fonte, ticker)",
        "silver",
        "peer",
    ),
    "peer_midranks": over(MIDRANKS, "ranked"),
    "peer_midranks_split": over(MIDRANKS, "ranked"),
    "magic_positions": over(MAGIC_POSITIONS, "silver"),
    "magic_positions_split": over(MAGIC_POSITIONS, "silver"),
    "gold_scores": over(f"SELECT {_columns(schemas.GOLD)} FROM gold", "gold"),
    "gold_scores_split": over(f"SELECT {_columns(schemas.GOLD)} FROM gold", "gold"),
    "ingest_guard": over(
        "SELECT ticker, data_coleta FROM asset WHERE data_coleta >= (SELECT d FROM ("
        "SELECT data_coleta AS d, ROW_NUMBER() OVER (ORDER BY data_coleta) - 1 AS i, COUNT(*) OVER () AS n "
        "FROM (SELECT DISTINCT data_coleta FROM asset)) WHERE i = n // 2)",
        "asset",
    ),
    "landing_replay": over(BRONZE_SUMMARY, "asset"),
    "tick_stream": over(
        "SELECT data_pregao, COUNT(*) AS qtd_eventos, "
        "CAST(SUM(volume) FILTER (WHERE event_id % 14 <> 0) AS BIGINT) AS volume_total, "
        "MAX(fechamento) AS maior_fechamento, COUNT(DISTINCT ticker) AS tickers "
        "FROM tick GROUP BY data_pregao",
        "tick",
    ),
    "envelope_stream": over(BRONZE_SUMMARY, "asset"),
    "envelope_state": over(BRONZE_SUMMARY, "asset"),
    "partition_rewrite": over(CENSUS, "gold"),
    "series_upsert": over(
        f"SELECT {_columns(schemas.SERIES)} FROM ({_NEWEST_SESSION}) WHERE rn = 1", "price_row"
    ),
    "catalog_census": over(CENSUS, "gold"),
    "screener_view": over(SCREENER, "silver_run", "gold_run"),
    "run_census": over(CENSUS, "gold"),
    "ranking": over(
        f"""SELECT ticker, nota, {r("score_final", 1)} AS score, {r("score_valuation", 0)} AS valuation,
          {r("score_rentabilidade", 0)} AS rentabilidade, {r("score_solidez", 0)} AS solidez,
          {r("score_dividendos", 0)} AS dividendos, setor, porte, perfil_risco, perfil_investidor,
          grupo_usado, n_grupo, confianca, fonte FROM gold_run""",
        "gold_run",
    ),
    "best_per_sector": over(
        f"""SELECT setor, ticker, nota, {r("score_final", 1)} AS score, perfil_investidor FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY setor ORDER BY score_final DESC, ticker) AS posicao
          FROM gold_run WHERE score_final IS NOT NULL) WHERE posicao <= 3""",
        "gold_run",
    ),
    "screener_listing": over(SCREENER, "silver_run", "gold_run"),
    "grade_distribution": over(
        f"""SELECT nota, COUNT(*) AS ativos, {r("MIN(score_final)", 1)} AS score_min,
          {r("MAX(score_final)", 1)} AS score_max FROM gold_run GROUP BY nota""",
        "gold_run",
    ),
    "indicator_coverage": over(
        "SELECT COUNT(*) AS total, "
        + ", ".join(f"COUNT({name}) AS {label}" for name, label in COVERAGE_LABELS.items())
        + " FROM silver_run",
        "silver_run",
    ),
    "provenance": over(
        f"""SELECT ticker, fonte, preco_ativo_origem, roic_origem, dividend_yield_origem,
          liquidez_2meses_origem, cresc_receita_origem, pontos_serie,
          {r("cobertura_campos_pct", 2)} AS cobertura, motivo_inelegibilidade FROM silver_run""",
        "silver_run",
    ),
    "below_graham": over(
        f"""SELECT ticker, {r("cotacao", 2)} AS cotacao, {r("valor_graham", 2)} AS valor_graham,
          {r("margem_seguranca * 100", 1)} AS margem_seguranca_pct, nota, fonte
        FROM gold_run WHERE flag_graham""",
        "gold_run",
    ),
    "below_bazin": over(
        f"""SELECT ticker, {r("cotacao", 2)} AS cotacao, {r("preco_teto_bazin", 2)} AS preco_teto,
          {r("(preco_teto_bazin / cotacao - 1) * 100", 1)} AS desconto_pct, nota, perfil_investidor
        FROM gold_run WHERE flag_bazin""",
        "gold_run",
    ),
    "magic_formula_best": over(
        f"""SELECT g.ticker, g.rank_magic_formula, {r("i.ev_ebit", 2)} AS ev_ebit,
          {r("i.roic * 100", 1)} AS roic_pct, g.nota, g.fonte
        FROM gold_run g JOIN silver_run i ON i.ticker = g.ticker AND i.data_coleta = g.data_referencia
        WHERE g.rank_magic_formula IS NOT NULL ORDER BY g.rank_magic_formula, g.ticker LIMIT 10""",
        "gold_run",
        "silver_run",
    ),
    "flag_screen": over(
        f"""SELECT ticker, nota, {r("score_final", 1)} AS score, setor, perfil_investidor
        FROM gold_run WHERE flag_pl_barato AND flag_roe_bom AND flag_endiv_ok""",
        "gold_run",
    ),
    "score_evolution": over(
        f"""SELECT ticker, data_referencia, {r("score_final", 1)} AS score, nota,
          {r("score_final - antes", 1)} AS variacao FROM (
          SELECT *, LAG(score_final) OVER (PARTITION BY ticker ORDER BY data_referencia) AS antes
          FROM gold WHERE score_final IS NOT NULL)""",
        "gold",
    ),
    "score_changes": over(
        f"""SELECT ticker, data_referencia, {r("score_final", 1)} AS score, nota,
          {r("score_final - antes", 1)} AS variacao FROM (
          SELECT *, LAG(score_final) OVER (PARTITION BY ticker ORDER BY data_referencia) AS antes
          FROM gold WHERE score_final IS NOT NULL)""",
        "gold",
    ),
    "idempotency_check": over(
        "SELECT data_coleta, COUNT(*) AS linhas, COUNT(DISTINCT ticker) AS tickers "
        "FROM silver GROUP BY data_coleta",
        "silver",
    ),
    "run_day": over(
        CENSUS.rstrip().replace(
            "FROM gold", "FROM gold WHERE data_referencia IN (SELECT DISTINCT data_referencia FROM gold ORDER BY 1 DESC LIMIT 2)"
        ),
        "gold",
    ),
    "silver_summary": over(
        """SELECT s.data_coleta, s.linhas, s.elegiveis, COALESCE(p.n, 0) AS pregoes FROM (
          SELECT data_coleta, COUNT(*) AS linhas, COUNT(*) FILTER (WHERE elegivel_score) AS elegiveis
          FROM silver GROUP BY data_coleta) s
        LEFT JOIN (SELECT data_coleta, COUNT(*) AS n FROM price_row GROUP BY data_coleta) p
        USING (data_coleta)""",
        "silver",
        "price_row",
    ),
    "series_coverage": over(
        """SELECT 'brapi (real)' AS origem, upper(trim(b.ticker, E' \\t\\n')) AS ticker, COUNT(*) AS pregoes,
          MIN(b.data_pregao) AS de, MAX(b.data_pregao) AS ate
        FROM (""" + _NEWEST_SESSION + """) b WHERE b.rn = 1 AND b.fonte = 'brapi' GROUP BY 2
        UNION ALL
        SELECT 'producer (sintetico)' AS origem, ticker, COUNT(DISTINCT data_pregao) AS pregoes,
          MIN(data_pregao) AS de, MAX(data_pregao) AS ate FROM tick GROUP BY ticker""",
        "price_row",
        "tick",
    ),
    "rejected_lines": over(
        "SELECT CASE WHEN event_id % 10 = 0 THEN 'rejeitada' ELSE 'aceita' END AS linha, COUNT(*) AS n "
        "FROM tick GROUP BY 1",
        "tick",
    ),
    "latest_with_dateless": over(
        "SELECT data_coleta, fonte, COUNT(*) AS linhas FROM silver "
        "WHERE data_coleta = (SELECT MAX(data_coleta) FROM silver) GROUP BY data_coleta, fonte",
        "silver",
    ),
    "dashboard_extract": over("SELECT " + ", ".join(_EXTRACT.split()) + " FROM extract", "extract"),
    "dashboard_kpis": over(
        "SELECT COUNT(*) AS ativos, COUNT(score_final) AS com_score, "
        "COUNT(*) FILTER (WHERE fonte = 'brapi') AS dados_reais, "
        + ", ".join(
            f"COUNT(*) FILTER (WHERE sinal = '{s}') AS sinal_{s.lower()}" for s in SIGNALS
        )
        + " FROM extract",
        "extract",
    ),
    "signal_counts": over(
        "SELECT v.sinal, COUNT(e.sinal) AS ativos FROM (VALUES "
        + ", ".join(f"('{s}')" for s in SIGNALS)
        + ") v(sinal) LEFT JOIN extract e ON e.sinal = v.sinal GROUP BY v.sinal",
        "extract",
    ),
    "dashboard_heatmap": over(
        "\nUNION ALL\n".join(
            f"""SELECT ticker, '{label}' AS pilar, {name} AS valor,
          CASE WHEN {name} IS NULL THEN 0 WHEN {name} < 20 THEN 1 WHEN {name} < 40 THEN 2
               WHEN {name} < 55 THEN 3 WHEN {name} < 70 THEN 4 WHEN {name} < 85 THEN 5 ELSE 6 END AS faixa
        FROM extract WHERE score_final IS NOT NULL"""
            for name, label in PILLARS
        ),
        "extract",
    ),
}

