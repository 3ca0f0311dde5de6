"""Values of the checker, stated on its own so that a wrong constant of the engine shows up."""

# Fixed values: (bad, good) points per metric.
BANDS = {
    "preco_lucro": (25.0, 4.0),
    "preco_valor_patrimonial": (4.0, 0.6),
    "psr": (5.0, 0.5),
    "ev_ebit": (20.0, 4.0),
    "preco_ativo": (2.0, 0.3),
    "roe": (0.0, 0.25),
    "roic": (0.0, 0.2),
    "margem_liquida": (0.0, 0.2),
    "margem_ebit": (0.0, 0.25),
    "divida_liquida_patrimonio": (2.0, 0.0),
    "divida_liquida_ebitda": (3.5, 0.0),
    "liq_corrente": (0.8, 2.5),
    "dividend_yield": (0.01, 0.08),
}

# Pillar weights, and metric weights as (standard, financial).
PILLAR_WEIGHTS = {
    "valuation": 0.3,
    "rentabilidade": 0.3,
    "solidez": 0.25,
    "dividendos": 0.15,
}
METRIC_WEIGHTS = {
    "valuation": {
        "preco_lucro": (0.3, 0.3),
        "preco_valor_patrimonial": (0.25, 0.25),
        "ev_ebit": (0.25, 0.25),
        "psr": (0.1, 0.1),
        "preco_ativo": (0.1, 0.1),
    },
    "rentabilidade": {
        "roe": (0.35, 0.45),
        "roic": (0.35, 0.25),
        "margem_liquida": (0.2, 0.3),
        "margem_ebit": (0.1, 0.0),
    },
    "solidez": {
        "divida_liquida_patrimonio": (0.4, 1.0),
        "divida_liquida_ebitda": (0.3, 0.0),
        "liq_corrente": (0.3, 0.0),
    },
    "dividendos": {
        "dividend_yield": (1.0, 1.0),
    },
}

# Inclusive plausibility bounds.
SANITY_BOUNDS = {
    "preco_lucro": (-1000.0, 1000.0),
    "preco_valor_patrimonial": (-50.0, 100.0),
    "psr": (0.0, 100.0),
    "preco_ativo": (0.0, 100.0),
    "preco_ebit": (-1000.0, 1000.0),
    "ev_ebit": (-1000.0, 1000.0),
    "ev_ebitda": (-1000.0, 1000.0),
    "roe": (-5.0, 5.0),
    "roic": (-5.0, 5.0),
    "retorno_sobre_ativos": (-5.0, 5.0),
    "margem_bruta": (-10.0, 1.0),
    "margem_ebit": (-10.0, 1.0),
    "margem_liquida": (-10.0, 1.0),
    "margem_ebitda": (-10.0, 1.0),
    "liq_corrente": (0.0, 50.0),
    "divida_liquida_patrimonio": (-10.0, 50.0),
    "divida_bruta_patrimonio": (-10.0, 50.0),
    "divida_liquida_ebitda": (-50.0, 50.0),
    "dividend_yield": (0.0, 1.0),
    "cresc_receita_12m": (-1.0, 10.0),
    "volatilidade_anualizada": (0.0, 5.0),
}

# Fields that count for coverage, and words of financial sectors.
CORE_FIELDS = [
    "preco_lucro",
    "preco_valor_patrimonial",
    "psr",
    "preco_ativo",
    "ev_ebit",
    "roe",
    "roic",
    "margem_liquida",
    "margem_ebit",
    "divida_liquida_patrimonio",
    "divida_liquida_ebitda",
    "liq_corrente",
    "dividend_yield",
]
FINANCIAL_KEYWORDS = [
    "financ",
    "banco",
    "bancar",
    "seguro",
    "segurad",
    "previdenc",
    "credito",
    "capitaliza",
]
