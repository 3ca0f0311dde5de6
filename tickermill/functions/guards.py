"""Null, NaN and type guards as column expressions.

NaN in a DOUBLE column passes `isNotNull`, so every number is made finite or NULL once, where
it enters, and again after each product or quotient.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITY = float("inf")

# Inclusive plausibility bounds; a value outside becomes NULL.
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


def finite(value: Column) -> Column:
    """NaN and both infinities become NULL (Spark orders NaN above infinity)."""
    return F.when(F.abs(value) < F.lit(INFINITY), value)


def parse_number(text: Column) -> Column:
    """Text to double, not yet finite-guarded. Java's `1d`/`1f` suffixes are not numbers here."""
    return F.when(~F.lower(F.right(F.rtrim(text), F.lit(1))).isin("d", "f"), text.try_cast("double"))


def parse_number_sql(text: str) -> str:
    """`parse_number` as SQL text, for long generated column lists."""
    return f"IF(lower(right(rtrim({text}), 1)) IN ('d', 'f'), NULL, TRY_CAST({text} AS DOUBLE))"


def finite_sql(value: str) -> str:
    """`finite` as SQL text."""
    return f"IF(abs({value}) < DOUBLE('Infinity'), {value}, NULL)"


def number(text: Column) -> Column:
    """Finite double from JSON text; booleans, words, NaN and infinities become NULL."""
    return finite(parse_number(text))


def safe_divide(a: Column, b: Column) -> Column:
    return finite(F.try_divide(a, b))


def safe_multiply(a: Column, b: Column) -> Column:
    return finite(a * b)


def first_valid(*values: Column) -> Column:
    """First non-null of already guarded numbers."""
    return F.coalesce(*values)


def sane(name: str, value: Column) -> Column:
    bounds = SANITY_BOUNDS.get(name)
    return value if bounds is None else F.when(value.between(*bounds), value)


def blank_to_null(text: Column) -> Column:
    return F.when(text != "", text)


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only the space character."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")
