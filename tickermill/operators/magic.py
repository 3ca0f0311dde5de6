"""Magic Formula: dense rank by cheapness plus dense rank by return, per source and run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickermill.operators.peers import RANK_KEYS, is_eligible, metric_values
from tickermill.operators.ranking import ranked

MIN_CANDIDATES = 2
# Column to rank and sign: low EV/EBIT first, high ROIC first.
RANKED = {"ev_ebit": 1, "roic": -1}


# Beside the peer groups' levels, so that both can be ranked together.
LEVEL = 3


def candidates(rows: DataFrame, ids: list[str]) -> DataFrame:
    """Rows that compete, as `peers.peer_values` gives them: eligible ones that have both values."""
    both = is_eligible() & F.col("ev_ebit").isNotNull() & F.col("roic").isNotNull()
    return rows.where(both).select(
        *ids,
        F.lit(LEVEL).cast("byte").alias("nivel"),
        F.col("_in_universo").alias("grupo"),
        F.lit(True).alias("pergunta"),
        F.inline(metric_values(RANKED)),
    )


def dense_positions(rows: DataFrame, ids: list[str], ranges: int | None = None) -> DataFrame:
    """(ids, metrica, posicao_densa) of both ranks for eligible rows that have both values.

    `rows` come from `peers.with_groups`.
    """
    positions = ranked(candidates(rows, ids), RANK_KEYS, "valor", ranges=ranges)
    return positions.where(F.col("n_valores") >= MIN_CANDIDATES).select(*ids, "metrica", "posicao_densa")
