"""Fundamental score of a whole universe as one DataFrame transform."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickermill.operators import magic, peers
from tickermill.operators.ranking import ranked
from tickermill.session import stored_alone

# Fixed values: (bad -> 0, good -> 100) reference points per metric.
BANDS = {
    "preco_lucro": (25.0, 4.0),
    "preco_valor_patrimonial": (4.0, 0.6),
    "psr": (5.0, 0.5),
    "ev_ebit": (20.0, 4.0),
    "preco_ativo": (2.0, 0.3),
    "roe": (0.00, 0.25),
    "roic": (0.00, 0.20),
    "margem_liquida": (0.00, 0.20),
    "margem_ebit": (0.00, 0.25),
    "divida_liquida_patrimonio": (2.0, 0.0),
    "divida_liquida_ebitda": (3.5, 0.0),
    "liq_corrente": (0.8, 2.5),
    "dividend_yield": (0.01, 0.08),
}
WORTHLESS_IF_NOT_POSITIVE = (
    "preco_lucro", "preco_valor_patrimonial", "ev_ebit", "psr", "preco_ativo",
)
BEST_IF_NEGATIVE = ("divida_liquida_patrimonio", "divida_liquida_ebitda")

# Pillar weights, and metric weights as (standard, financial) per pillar.
PILLAR_WEIGHTS = {"valuation": 0.30, "rentabilidade": 0.30, "solidez": 0.25, "dividendos": 0.15}
METRIC_WEIGHTS = {
    "valuation": {
        "preco_lucro": (0.30, 0.30),
        "preco_valor_patrimonial": (0.25, 0.25),
        "ev_ebit": (0.25, 0.25),
        "psr": (0.10, 0.10),
        "preco_ativo": (0.10, 0.10),
    },
    "rentabilidade": {
        "roe": (0.35, 0.45),
        "roic": (0.35, 0.25),
        "margem_liquida": (0.20, 0.30),
        "margem_ebit": (0.10, 0.0),
    },
    "solidez": {
        "divida_liquida_patrimonio": (0.40, 1.00),
        "divida_liquida_ebitda": (0.30, 0.0),
        "liq_corrente": (0.30, 0.0),
    },
    "dividendos": {"dividend_yield": (1.00, 1.00)},
}
BAND_SHARE = 0.70
PERCENTILE_SHARE = 0.30
MIN_PILLAR_COVERAGE = 0.50
MIN_SCORE_COVERAGE = 0.60
GRADES = ((80.0, "A"), (65.0, "B"), (50.0, "C"), (35.0, "D"))
LOWEST_GRADE = "E"
NO_GRADE = "SD"
CONFIDENCE = ((0.80, "alta"), (0.60, "media"))
LOW_CONFIDENCE = "baixa"
SUSPECT_YIELD = 0.15
BAZIN_TARGET_YIELD = 0.06
GRAHAM_CONSTANT = 22.5
STRONG_SCORE = 65.0
WEAK_SCORE = 50.0
EXPENSIVE_MARGIN = -0.20
STRONG, NEUTRAL, WEAK, NO_SIGNAL = "FORTE", "NEUTRO", "FRACO", "SEM_DADOS"
SIGNALS = (STRONG, NEUTRAL, WEAK, NO_SIGNAL)

ROW_ID = ["data_coleta", "fonte", "ticker"]
# The same for rows that have peers: the number of their run and source, and the ticker.
_PEER_ID = ["_in_universo", "ticker"]
DIRECTIONS = {name: (1 if good > bad else -1) for name, (bad, good) in BANDS.items()}


def band_sql(value: str, bad: float, good: float) -> str:
    """Linear between the two points, held to [0, 100]; NULL stays NULL.

    `least` and `greatest` skip NULLs, so the guard is needed.
    """
    if bad == good:
        raise ValueError("band reference points must differ")
    line = f"100D * ({value} - {bad}D) / {good - bad}D"
    return f"IF({value} IS NULL, NULL, greatest(0D, least(100D, {line})))"


def metric_band_sql(name: str, value: str | None = None, ebitda: str = "ebitda") -> str:
    """Band score with the economic exceptions; unknown metrics have none."""
    if name not in BANDS:
        return "CAST(NULL AS DOUBLE)"
    value = value or name
    rules = []
    if name in WORTHLESS_IF_NOT_POSITIVE:
        rules.append(f"WHEN {value} <= 0 THEN 0D")
    if name == "divida_liquida_ebitda":
        rules.append(f"WHEN {value} < 0 AND {ebitda} <= 0 THEN 0D")
    if name in BEST_IF_NEGATIVE:
        rules.append(f"WHEN {value} < 0 THEN 100D")
    if name == "dividend_yield":
        rules.append(f"WHEN {value} > {SUSPECT_YIELD}D THEN 100D")
    band = band_sql(value, *BANDS[name])
    return f"CASE {' '.join(rules)} ELSE {band} END" if rules else band


def note_sql(band: str, percentile: str) -> str:
    """Band blended with the peer percentile where there is one."""
    blend = f"{BAND_SHARE}D * {band} + {PERCENTILE_SHARE}D * ({percentile} * 100D)"
    return f"IF({percentile} IS NULL, {band}, {blend})"


def weighted_mean_sql(pairs: list[tuple[str, str]], total: str, minimum: float) -> tuple[str, str]:
    """(mean over present values, share of weight present); the mean is NULL below `minimum`.

    Weights are added in the order given: the cut-offs are hit exactly by real combinations.
    """
    present = " + ".join(f"IF({value} IS NULL, 0D, {weight})" for weight, value in pairs)
    weighted = " + ".join(f"IF({value} IS NULL, 0D, {weight} * {value})" for weight, value in pairs)
    share = f"(({present}) / {total})"
    mean = f"IF({share} >= {minimum}D AND {present} > 0, ({weighted}) / ({present}), NULL)"
    return mean, share


def pillar_sql(pillar: str, financial: str = "_financial", prefix: str = "_n_") -> str:
    """Pillar score from the metric notes, with the weights of the row's profile."""
    weights = METRIC_WEIGHTS[pillar]
    pairs = [
        (f"IF({financial}, {special}D, {standard}D)", f"{prefix}{name}")
        for name, (standard, special) in weights.items()
    ]
    totals = [reduce(add, (w[side] for w in weights.values())) for side in (0, 1)]
    total = f"IF({financial}, {totals[1]}D, {totals[0]}D)"
    return weighted_mean_sql(pairs, total, MIN_PILLAR_COVERAGE)[0]


def letter_grade(score: Column) -> Column:
    grade = F.when(score.isNull(), NO_GRADE)
    for cut, letter in GRADES:
        grade = grade.when(score >= cut, letter)
    return grade.otherwise(LOWEST_GRADE)


def confidence_level(coverage: Column) -> Column:
    level = None
    for cut, name in CONFIDENCE:
        level = F.when(coverage >= cut, name) if level is None else level.when(coverage >= cut, name)
    return level.otherwise(LOW_CONFIDENCE)


def with_classic_formulas(df: DataFrame) -> DataFrame:
    """Graham value and margin, Bazin ceiling and the screening flags (NULL in, NULL out)."""
    c = F.col
    return (
        df.withColumns(
            {
                "valor_graham": F.when(
                    (c("lpa") > 0) & (c("vpa") > 0),
                    F.sqrt(F.lit(GRAHAM_CONSTANT) * c("lpa") * c("vpa")),
                ),
                "preco_teto_bazin": F.when(
                    c("dividend_yield_origem") == "brapi",
                    c("cotacao") * c("dividend_yield") / F.lit(BAZIN_TARGET_YIELD),
                ),
                "flag_pl_barato": (c("preco_lucro") > 0) & (c("preco_lucro") <= 15),
                "flag_pvp_barato": (c("preco_valor_patrimonial") > 0)
                & (c("preco_valor_patrimonial") <= 1.5),
                "flag_roe_bom": c("roe") >= 0.15,
                "flag_endiv_ok": c("divida_liquida_patrimonio") <= 1.0,
                "flag_liquidez_ok": c("liq_corrente") >= 1.5,
                "flag_dy_suspeito": c("dividend_yield") > SUSPECT_YIELD,
            }
        )
        .withColumn(
            "margem_seguranca", F.try_divide(c("valor_graham") - c("cotacao"), c("cotacao"))
        )
        .withColumns(
            {
                "flag_graham": c("margem_seguranca") > 0,
                "flag_bazin": c("cotacao") < c("preco_teto_bazin"),
            }
        )
    )


def technical_signal() -> Column:
    """FRACO needs one bad sign, FORTE needs every good one; NULL eligibility, margin and
    confidence do not block."""
    score, margin = F.col("score_final"), F.col("margem_seguranca")
    return (
        F.when(
            score.isNull() | F.col("elegivel_score").eqNullSafe(F.lit(False)), NO_SIGNAL
        )
        .when(score < WEAK_SCORE, WEAK)
        .when(margin < EXPENSIVE_MARGIN, WEAK)
        .when(
            (score >= STRONG_SCORE)
            & ~F.col("confianca").eqNullSafe(F.lit(LOW_CONFIDENCE))
            & (margin.isNull() | (margin > 0)),
            STRONG,
        )
        .otherwise(NEUTRAL)
    )


def _peer_values(rows: DataFrame, ranges: int | None) -> DataFrame:
    """Per row: `_p_<metric>` percentiles and the Magic Formula rank.

    Both kinds of ranks are found in one pass. The narrow answers are brought together by row before
    they are spread to columns, so one shuffle of (id, metric, answer) rows does it.
    """
    values = peers.peer_values(rows, DIRECTIONS, _PEER_ID).unionByName(magic.candidates(rows, _PEER_ID))
    magical = F.col("nivel") == magic.LEVEL
    answer = F.when(magical & (F.col("n_valores") >= magic.MIN_CANDIDATES), F.col("posicao_densa").cast("double")).when(
        ~magical & (F.col("n_valores") >= peers.MIN_GROUP), peers.percentile()
    )
    code = F.when(magical, F.col("metrica") + len(BANDS)).otherwise(F.col("metrica")).cast("byte")
    answers = ranked(values, peers.RANK_KEYS, "valor", F.col("pergunta"), ranges).select(
        *_PEER_ID, code.alias("metrica"), answer.alias("resposta")
    )
    columns = [f"_p_{name}" for name in BANDS]
    magic_ranks = [f"max(IF(metrica = {len(BANDS) + i}, resposta, NULL))" for i in (0, 1)]
    return (
        answers.repartition(*_PEER_ID)
        .groupBy(*_PEER_ID)
        .agg(
            *[
                F.expr(f"max(IF(metrica = {i}, resposta, NULL)) AS {column}")
                for i, column in enumerate(columns)
            ],
            F.expr(f"INT({' + '.join(magic_ranks)}) AS rank_magic_formula"),
        )
    )


def score_universe(df: DataFrame, ranges: int | None = None) -> DataFrame:
    """Add score, grade, peer group, coverage, confidence, classic formulas and Magic Formula.

    Takes one row per (data_coleta, ticker); each run date is scored on its own. Rows that may
    not be scored keep their formulas and flags and get the "no data" defaults. Group cells and
    value ranges are written to the shared folder while the plan is built, which reads `df` more
    than once: pass a stored table.
    """
    rows = peers.with_groups(df)
    # Stored, so that the ranked values and their shuffles are gone when the wide rows are joined.
    answers = stored_alone(df.sparkSession, lambda: _peer_values(rows, ranges), "answers")
    with_peers = rows.join(answers, _PEER_ID, "left")
    bands = with_peers.selectExpr(
        "*",
        *[f"{metric_band_sql(name)} AS _b_{name}" for name in BANDS],
        "coalesce(elegivel_score, false) AS _ok",
        "coalesce(setor_financeiro, false) AS _financial",
    )
    notes = bands.selectExpr(
        "*",
        *[
            f"IF(_ok, {note_sql(f'_b_{name}', f'_p_{name}')}, NULL) AS _n_{name}"
            for name in BANDS
        ],
    )
    pillars = notes.selectExpr("*", *[f"{pillar_sql(p)} AS score_{p}" for p in PILLAR_WEIGHTS])
    score, coverage = weighted_mean_sql(
        [(f"{weight}D", f"score_{pillar}") for pillar, weight in PILLAR_WEIGHTS.items()],
        f"{reduce(add, PILLAR_WEIGHTS.values())}D",
        MIN_SCORE_COVERAGE,
    )
    scored = pillars.selectExpr(
        "*", f"{score} AS score_final", f"{coverage} AS cobertura_indicadores_pct"
    )
    graded = scored.withColumns(
        {
            "perfil_pesos": peers.weight_profile(),
            "nota": letter_grade(F.col("score_final")),
            "confianca": confidence_level(F.col("cobertura_indicadores_pct")),
        }
    )
    internal = [name for name in graded.columns if name.startswith("_")]
    return with_classic_formulas(graded.drop(*internal, "n_setor", "n_macro", "n_universo"))
