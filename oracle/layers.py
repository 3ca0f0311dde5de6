"""CTEs that recompute every layer from the raw tables, written the plain way (no split ranks)."""

from __future__ import annotations

from oracle.constants import (
    BANDS,
    CORE_FIELDS,
    FINANCIAL_KEYWORDS,
    METRIC_WEIGHTS,
    PILLAR_WEIGHTS,
    SANITY_BOUNDS,
)
from tickermill.plans.derive import ASSETS_SQL
from tickermill.schemas import EXTRA_INDICATORS, SCREENER_INDICATORS

INDICATORS = SCREENER_INDICATORS + EXTRA_INDICATORS


def d(value: float) -> str:
    return f"CAST({value!r} AS DOUBLE)"


def div(a: str, b: str) -> str:
    return f"(({a}) / NULLIF({b}, 0))"


LEAVES = [
    line.split('AS "')[1].split('"')[0] for line in ASSETS_SQL.splitlines() if 'AS "' in line
]

TICK = """
SELECT 'U' || user_id AS ticker, CAST(n + 1 AS DOUBLE) AS abertura,
       greatest(CAST(n + 1 AS DOUBLE), value) AS maxima, least(CAST(n + 1 AS DOUBLE), value) AS minima,
       value AS fechamento, n * 1000 AS volume, ts AS evento_ts,
       strftime(ts, '%Y-%m-%d') AS data_pregao, event_id, user_id AS k
FROM (SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS n FROM events)
"""

BAR = """
SELECT k, data_pregao, MAX(CASE WHEN rn = 1 THEN abertura END) AS abertura, MAX(maxima) AS maxima,
       MIN(minima) AS minima, MAX(CASE WHEN rn = 1 THEN last_close END) AS fechamento,
       MAX(CASE WHEN rn = 1 AND k % 2 = 0 THEN last_close * 0.98e0 END) AS fechamento_ajustado,
       CAST(SUM(volume) AS BIGINT) AS volume
FROM (
  SELECT *, CASE WHEN k % 37 = 5 THEN fechamento
                 ELSE 100e0 + fechamento * (0.01e0 * (1 + k % 5)) END AS last_close,
         ROW_NUMBER() OVER (PARTITION BY k, data_pregao ORDER BY evento_ts DESC, event_id DESC) AS rn
  FROM tick
) GROUP BY k, data_pregao
"""

METRIC = """
SELECT p.k, p.n AS pontos, CASE WHEN p.n >= 20 THEN p.liquidity END AS liquidity,
       CASE WHEN p.n >= 20 AND r.m >= 19 THEN r.vol END AS vol
FROM (
  SELECT k, MAX(n) AS n, AVG(CASE WHEN i > n - 42 THEN fechamento * volume END) AS liquidity
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY k ORDER BY data_pregao) AS i,
               COUNT(*) OVER (PARTITION BY k) AS n FROM bar) GROUP BY k
) p LEFT JOIN (
  SELECT k, COUNT(r) AS m, stddev_samp(r) * sqrt(252e0) AS vol
  FROM (SELECT k, price / LAG(price) OVER (PARTITION BY k ORDER BY data_pregao) - 1 AS r
        FROM (SELECT k, data_pregao, COALESCE(fechamento_ajustado, fechamento) AS price FROM bar)
        WHERE price > 0)
  GROUP BY k
) r ON r.k = p.k
"""

_text = [name for name in LEAVES if name not in ("longName", "shortName", "k_beta")]
LEAF = (
    "SELECT k, y, upper(trim(ticker)) AS ticker, ticker AS raw_ticker, data_coleta,\n"
    "  COALESCE(NULLIF(fonte, ''), 'brapi') AS fonte,\n"
    "  CASE WHEN ok THEN COALESCE(NULLIF(\"longName\", ''), \"shortName\") END AS nome_longo,\n"
    "  CASE WHEN ok THEN sector END AS setor, CASE WHEN ok THEN industry END AS industria,\n"
    "  CASE WHEN ok AND k % 50 NOT IN (1, 2, 3, 4) THEN CAST(k_beta AS DOUBLE) END AS k_beta,\n"
    + ",\n".join(f'  CASE WHEN ok THEN "{name}" END AS "{name}"' for name in _text)
    + ",\n  ok FROM (SELECT *, fetched = 'ok' AS ok FROM asset)"
)

AMOUNT = """
SELECT *, COALESCE(cotacao * acoes_emitidas, k_marketCap, r_marketCap) AS valor_mercado,
  vpa * acoes_emitidas AS patrimonio_liquido, receita_total * f_operatingMargins AS ebit_estimado,
  COALESCE(f_ebitda, receita_total * f_ebitdaMargins) AS ebitda,
  lucro_liquido / NULLIF(f_returnOnAssets, 0) AS ativo_total_estimado,
  divida_total - COALESCE(caixa_total, 0e0) AS net_debt
FROM (
  SELECT *, COALESCE(r_regularMarketPrice, f_currentPrice) AS cotacao,
    COALESCE(r_earningsPerShare, k_earningsPerShare, k_trailingEps) AS lpa, k_bookValue AS vpa,
    COALESCE(k_sharesOutstanding, k_impliedSharesOutstanding) AS acoes_emitidas,
    f_totalRevenue AS receita_total, f_totalDebt AS divida_total, f_totalCash AS caixa_total,
    k_netIncomeToCommon AS lucro_liquido
  FROM leaf
)
"""

_RATIOS = {
    "preco_lucro": div("cotacao", "lpa"),
    "preco_valor_patrimonial": div("cotacao", "vpa"),
    "psr": div("valor_mercado", "receita_total"),
    "dividend_yield": "COALESCE(k_dividendYield, k_yield)",
    "preco_ativo": div("valor_mercado", "ativo_total_estimado"),
    "preco_capital_giro": "CAST(NULL AS DOUBLE)",
    "preco_ebit": div("valor_mercado", "ebit_estimado"),
    "preco_ativo_circ_liquido": "CAST(NULL AS DOUBLE)",
    "ev_ebit": div("enterprise_value", "ebit_estimado"),
    "ev_ebitda": f"COALESCE(k_enterpriseToEbitda, {div('enterprise_value', 'ebitda')})",
    "margem_bruta": f"COALESCE(f_grossMargins, {div('f_grossProfits', 'receita_total')})",
    "margem_ebit": "f_operatingMargins",
    "margem_liquida": "COALESCE(f_profitMargins, k_profitMargins)",
    "liq_corrente": "f_currentRatio",
    "roic": div(
        f"ebit_estimado * {d(1.0 - 0.34)}", "COALESCE(divida_total, 0e0) + patrimonio_liquido"
    ),
    "roe": f"COALESCE(f_returnOnEquity, k_returnOnEquity, {div('lucro_liquido', 'patrimonio_liquido')})",
    "liquidez_2meses": "ROUND(liquidity, 2)",
    "divida_liquida_patrimonio": div("net_debt", "patrimonio_liquido"),
    "cresc_receita_5a": "CAST(NULL AS DOUBLE)",
    "margem_ebitda": f"COALESCE(f_ebitdaMargins, {div('ebitda', 'receita_total')})",
    "divida_bruta_patrimonio": f"COALESCE(f_debtToEquity, {div('divida_total', 'patrimonio_liquido')})",
    "divida_liquida_ebitda": div("net_debt", "ebitda"),
    "cresc_receita_12m": "f_revenueGrowth",
    "retorno_sobre_ativos": "f_returnOnAssets",
    "volatilidade_anualizada": "ROUND(vol, 9)",
    "beta": "k_beta",
}


def _bounded(name: str) -> str:
    formula = _RATIOS.get(name, name)
    if name not in SANITY_BOUNDS:
        return f"{formula} AS {name}"
    low, high = SANITY_BOUNDS[name]
    return f"CASE WHEN {formula} BETWEEN {d(low)} AND {d(high)} THEN {formula} END AS {name}"


def _present(name: str, label: str) -> str:
    return f"CASE WHEN {name} IS NOT NULL THEN '{label}' ELSE 'indisponivel' END"


_suffix = "regexp_extract(ticker, '([0-9]+)$', 1)"
_CLASS = (
    f"CASE WHEN {_suffix} = '3' THEN 'ACAO_ON' WHEN {_suffix} IN ('4','5','6','7','8') THEN 'ACAO_PN' "
    f"WHEN {_suffix} = '11' THEN 'UNIT_OU_FII' WHEN regexp_matches({_suffix}, '^3[0-9]$') THEN 'BDR' "
    "ELSE 'OUTRO' END"
)
_filled = " + ".join(f"CASE WHEN {name} IS NOT NULL THEN 1 ELSE 0 END" for name in CORE_FIELDS)

RATIO = (
    "SELECT ticker, nome_longo, setor, industria, fonte, data_coleta, ok, k,\n  "
    + ",\n  ".join(_bounded(name) for name in INDICATORS)
    + ",\n  CAST(COALESCE(pontos, 0) AS INTEGER) AS pontos_serie\nFROM (\n"
    "  SELECT a.*, m.pontos, m.liquidity, m.vol,\n"
    "    COALESCE(k_enterpriseValue, valor_mercado + COALESCE(divida_total, 0e0)\n"
    "             - COALESCE(caixa_total, 0e0)) AS enterprise_value\n"
    "  FROM amount a LEFT JOIN metric m ON m.k = a.k AND a.ok\n)"
)

SILVER = f"""
SELECT *, CAST(motivo_inelegibilidade IS NULL AS BOOLEAN) AS elegivel_score FROM (
  SELECT *, CASE WHEN classe_ativo IN ('BDR', 'UNIT_OU_FII', 'OUTRO') THEN 'classe_nao_suportada'
                 WHEN cotacao IS NULL THEN 'sem_cotacao'
                 WHEN cobertura_campos_pct < 0.30e0 THEN 'dados_insuficientes' END
            AS motivo_inelegibilidade
  FROM (
    SELECT *, {_CLASS} AS classe_ativo,
      regexp_matches(lower(concat_ws(' ', setor, industria)), '{"|".join(FINANCIAL_KEYWORDS)}')
        AS setor_financeiro,
      COALESCE(lpa <= 0, FALSE) AS lucro_negativo,
      ({_filled}) / 13e0 AS cobertura_campos_pct,
      {_present("ativo_total_estimado", "estimado_por_roa")} AS preco_ativo_origem,
      {_present("roic", "ebit_pos_ir_sobre_capital")} AS roic_origem,
      {_present("dividend_yield", "brapi")} AS dividend_yield_origem,
      CASE WHEN liquidez_2meses IS NOT NULL THEN 'serie_brapi_3mo' ELSE 'amostra_insuficiente' END
        AS liquidez_2meses_origem,
      {_present("cresc_receita_12m", "proxy_12m")} AS cresc_receita_origem,
      data_coleta || 'T18:00:00+00:00' AS coletado_em
    FROM ratio
  )
)
"""

PRICE_ROW = """
SELECT l.raw_ticker AS ticker, b.abertura, b.maxima, b.minima, b.fechamento, b.fechamento_ajustado,
       b.volume, l.data_coleta, l.fonte, b.data_pregao
FROM leaf l JOIN bar b ON b.k = l.k WHERE l.ok
"""

PEER = """
SELECT *, CASE WHEN setor <> '' AND n_setor >= 5 THEN 'setor' WHEN n_macro >= 5 THEN 'macro'
               ELSE 'universo' END AS grupo_usado,
       CASE WHEN setor <> '' AND n_setor >= 5 THEN n_setor WHEN n_macro >= 5 THEN n_macro
            ELSE n_universo END AS n_grupo
FROM (
  SELECT *, COUNT(*) OVER (PARTITION BY data_coleta, fonte, setor) AS n_setor,
         COUNT(*) OVER (PARTITION BY data_coleta, fonte, setor_financeiro) AS n_macro,
         COUNT(*) OVER (PARTITION BY data_coleta, fonte) AS n_universo
  FROM silver WHERE elegivel_score
)
"""

LONG = "\nUNION ALL\n".join(
    f"SELECT data_coleta, fonte, setor, setor_financeiro, ticker, grupo_usado, n_grupo, "
    f"'{name}' AS metrica, {'' if good > bad else '-'}{name} AS v FROM peer WHERE {name} IS NOT NULL"
    for name, (bad, good) in BANDS.items()
)


def _midrank(keys: str) -> str:
    over = f"PARTITION BY data_coleta, fonte, metrica{keys}"
    return (
        f"(RANK() OVER ({over} ORDER BY v) - 1 + 0.5e0 * COUNT(*) OVER ({over}, v)) "
        f"/ COUNT(*) OVER ({over})",
        f"COUNT(*) OVER ({over})",
    )


_levels = {
    "setor": _midrank(", setor"),
    "macro": _midrank(", setor_financeiro"),
    "universo": _midrank(""),
}
RANKED = (
    "SELECT *, CASE grupo_usado "
    + " ".join(f"WHEN '{level}' THEN {p}" for level, (p, _) in _levels.items())
    + " END AS percentil, CASE grupo_usado "
    + " ".join(f"WHEN '{level}' THEN {n}" for level, (_, n) in _levels.items())
    + " END AS n_valores FROM long"
)

PERCENT = (
    "SELECT data_coleta, fonte, ticker, "
    + ", ".join(f"MAX(CASE WHEN metrica = '{m}' THEN percentil END) AS p_{m}" for m in BANDS)
    + " FROM ranked WHERE n_grupo >= 5 AND n_valores >= 5 GROUP BY data_coleta, fonte, ticker"
)

MAGIC = """
SELECT data_coleta, fonte, ticker, CAST(r_ev + r_roic AS INTEGER) AS rank_magic_formula FROM (
  SELECT *, DENSE_RANK() OVER (PARTITION BY data_coleta, fonte ORDER BY ev_ebit) AS r_ev,
         DENSE_RANK() OVER (PARTITION BY data_coleta, fonte ORDER BY roic DESC) AS r_roic,
         COUNT(*) OVER (PARTITION BY data_coleta, fonte) AS n
  FROM silver WHERE elegivel_score AND ev_ebit IS NOT NULL AND roic IS NOT NULL
) WHERE n >= 2
"""


def _band(name: str) -> str:
    bad, good = BANDS[name]
    rules = [f"WHEN {name} IS NULL THEN NULL"]
    if name in ("preco_lucro", "preco_valor_patrimonial", "ev_ebit", "psr", "preco_ativo"):
        rules.append(f"WHEN {name} <= 0 THEN 0e0")
    if name == "divida_liquida_ebitda":
        rules.append(f"WHEN {name} < 0 AND ebitda <= 0 THEN 0e0")
    if name in ("divida_liquida_ebitda", "divida_liquida_patrimonio"):
        rules.append(f"WHEN {name} < 0 THEN 100e0")
    if name == "dividend_yield":
        rules.append(f"WHEN {name} > 0.15e0 THEN 100e0")
    line = f"100e0 * ({name} - {d(bad)}) / {d(good - bad)}"
    return f"CASE {' '.join(rules)} ELSE greatest(0e0, least(100e0, {line})) END"


def _mean(pairs: list[tuple[str, str]], total: str, minimum: str) -> tuple[str, str]:
    present = " + ".join(f"CASE WHEN {v} IS NOT NULL THEN {w} ELSE 0e0 END" for w, v in pairs)
    weighted = " + ".join(f"CASE WHEN {v} IS NOT NULL THEN {w} * {v} ELSE 0e0 END" for w, v in pairs)
    share = f"(({present}) / {total})"
    return f"CASE WHEN {share} >= {minimum} AND ({present}) > 0 THEN ({weighted}) / ({present}) END", share


def _pillar(name: str) -> str:
    pairs, totals = [], [0.0, 0.0]
    for metric, (standard, financial) in METRIC_WEIGHTS[name].items():
        pairs.append((f"(CASE WHEN setor_financeiro THEN {d(financial)} ELSE {d(standard)} END)", f"n_{metric}"))
        totals = [totals[0] + standard, totals[1] + financial]
    total = f"(CASE WHEN setor_financeiro THEN {d(totals[1])} ELSE {d(totals[0])} END)"
    return _mean(pairs, total, "0.5e0")[0] + f" AS score_{name}"


NOTE = (
    "SELECT s.*, p.grupo_usado, CAST(COALESCE(p.n_grupo, 0) AS INTEGER) AS n_grupo, g.rank_magic_formula,\n"
    + ",\n".join(
        f"  CASE WHEN s.elegivel_score THEN CASE WHEN x.p_{m} IS NOT NULL "
        f"THEN 0.7e0 * b_{m} + 0.3e0 * (x.p_{m} * 100e0) ELSE b_{m} END END AS n_{m}"
        for m in BANDS
    )
    + "\nFROM (SELECT *, " + ", ".join(f"{_band(m)} AS b_{m}" for m in BANDS) + " FROM silver) s\n"
    "LEFT JOIN peer p USING (data_coleta, fonte, ticker)\n"
    "LEFT JOIN pct x USING (data_coleta, fonte, ticker)\n"
    "LEFT JOIN magic g USING (data_coleta, fonte, ticker)"
)

_score, _coverage = _mean(
    [(d(w), f"score_{name}") for name, w in PILLAR_WEIGHTS.items()], "1e0", "0.6e0"
)
SCORED = f"""
SELECT *, {_score} AS score_final, {_coverage} AS cobertura_indicadores_pct FROM (
  SELECT *, {", ".join(_pillar(name) for name in PILLAR_WEIGHTS)} FROM note
)
"""

FORMULA = """
SELECT *, cotacao < preco_teto_bazin AS flag_bazin, margem_seguranca > 0 AS flag_graham FROM (
  SELECT *, (valor_graham - cotacao) / NULLIF(cotacao, 0) AS margem_seguranca FROM (
    SELECT *, CASE WHEN lpa > 0 AND vpa > 0 THEN sqrt(22.5e0 * lpa * vpa) END AS valor_graham,
      CASE WHEN dividend_yield_origem = 'brapi' THEN cotacao * dividend_yield / 0.06e0 END
        AS preco_teto_bazin,
      preco_lucro > 0 AND preco_lucro <= 15 AS flag_pl_barato,
      preco_valor_patrimonial > 0 AND preco_valor_patrimonial <= 1.5e0 AS flag_pvp_barato,
      roe >= 0.15e0 AS flag_roe_bom, divida_liquida_patrimonio <= 1 AS flag_endiv_ok,
      liq_corrente >= 1.5e0 AS flag_liquidez_ok, dividend_yield > 0.15e0 AS flag_dy_suspeito
    FROM scored
  )
)
"""

GOLD = """
SELECT *, CASE WHEN elegivel_score THEN
    CASE WHEN dividend_yield >= 0.06e0 AND perfil_risco IS DISTINCT FROM 'ALTO' THEN 'DIVIDENDOS'
         WHEN score_valuation >= 70 AND score_solidez >= 60 THEN 'VALOR'
         WHEN cresc_receita_12m >= 0.15e0 AND perfil_risco IS DISTINCT FROM 'BAIXO' THEN 'CRESCIMENTO'
         ELSE 'ESPECULATIVO' END END AS perfil_investidor
FROM (
  SELECT *, data_coleta AS data_referencia,
    CASE WHEN setor_financeiro THEN 'financeiro' ELSE 'padrao' END AS perfil_pesos,
    CASE WHEN score_final IS NULL THEN 'SD' WHEN score_final >= 80 THEN 'A'
         WHEN score_final >= 65 THEN 'B' WHEN score_final >= 50 THEN 'C'
         WHEN score_final >= 35 THEN 'D' ELSE 'E' END AS nota,
    CASE WHEN cobertura_indicadores_pct >= 0.8e0 THEN 'alta'
         WHEN cobertura_indicadores_pct >= 0.6e0 THEN 'media' ELSE 'baixa' END AS confianca,
    CASE WHEN valor_mercado <= 0 THEN NULL WHEN valor_mercado < 2e9 THEN 'MICRO'
         WHEN valor_mercado < 10e9 THEN 'SMALL' WHEN valor_mercado < 50e9 THEN 'MID'
         WHEN valor_mercado IS NOT NULL THEN 'LARGE' END AS porte,
    CASE WHEN volatilidade_anualizada < 0.25e0 THEN 'BAIXO'
         WHEN volatilidade_anualizada < 0.4e0 THEN 'MEDIO'
         WHEN volatilidade_anualizada IS NOT NULL THEN 'ALTO' END AS perfil_risco
  FROM formula
)
"""

SILVER_RUN = "SELECT * FROM silver WHERE data_coleta = (SELECT MAX(data_coleta) FROM silver)"
GOLD_RUN = "SELECT * FROM gold WHERE data_referencia = (SELECT MAX(data_referencia) FROM gold)"

SIGNAL = """
SELECT *, CASE WHEN score_final IS NULL OR elegivel_score IS NOT DISTINCT FROM FALSE THEN 'SEM_DADOS'
    WHEN score_final < 50 OR margem_seguranca < -0.2e0 THEN 'FRACO'
    WHEN score_final >= 65 AND confianca IS DISTINCT FROM 'baixa'
         AND (margem_seguranca IS NULL OR margem_seguranca > 0) THEN 'FORTE'
    ELSE 'NEUTRO' END AS sinal
FROM gold_run
"""

LAYERS = {
    "tick": (TICK, ()),
    "bar": (BAR, ("tick",)),
    "metric": (METRIC, ("bar",)),
    "asset": (ASSETS_SQL.replace("{part}", "part").replace("{lineitem}", "lineitem"), ()),
    "leaf": (LEAF, ("asset",)),
    "amount": (AMOUNT, ("leaf",)),
    "ratio": (RATIO, ("amount", "metric")),
    "silver": (SILVER, ("ratio",)),
    "price_row": (PRICE_ROW, ("leaf", "bar")),
    "peer": (PEER, ("silver",)),
    "long": (LONG, ("peer",)),
    "ranked": (RANKED, ("long",)),
    "pct": (PERCENT, ("ranked",)),
    "magic": (MAGIC, ("silver",)),
    "note": (NOTE, ("silver", "peer", "pct", "magic")),
    "scored": (SCORED, ("note",)),
    "formula": (FORMULA, ("scored",)),
    "gold": (GOLD, ("formula",)),
    "silver_run": (SILVER_RUN, ("silver",)),
    "gold_run": (GOLD_RUN, ("gold",)),
    "extract": (SIGNAL, ("gold_run",)),
}


def over(final: str, *needed: str) -> str:
    """`final` preceded by the CTEs it needs, in order."""
    wanted: set[str] = set()

    def add(name: str) -> None:
        if name not in wanted:
            wanted.add(name)
            for parent in LAYERS[name][1]:
                add(parent)

    for name in needed:
        add(name)
    ctes = ",\n".join(
        f"{name} AS MATERIALIZED ({LAYERS[name][0]})" for name in LAYERS if name in wanted
    )
    return f"WITH {ctes}\n{final}"
