"""Display helpers of the dashboard as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
HEAT_BREAKS = (20.0, 40.0, 55.0, 70.0, 85.0)
DASH = "–"


def heat_level(value: Column) -> Column:
    """1 to 6 by the breaks, 0 without a value."""
    level = F.when(value.isNull(), 0)
    for step, limit in enumerate(HEAT_BREAKS, start=1):
        level = level.when(value < limit, step)
    return level.otherwise(len(HEAT_BREAKS) + 1)


def _spaced(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit(" "))


def fixed_label(value: Column, decimals: int = 1, suffix: str = "") -> Column:
    """Fixed decimals with thousands apart, or a dash."""
    label = F.concat(_spaced(F.format_number(value, decimals)), F.lit(suffix))
    return F.coalesce(label, F.lit(DASH))


def percent_label(value: Column, decimals: int = 0) -> Column:
    label = F.concat(F.format_number(value * 100, decimals), F.lit("%"))
    return F.coalesce(label, F.lit(DASH))


def compact_label(value: Column) -> Column:
    """Billions as "bi", millions as "mi", smaller amounts in full."""
    return (
        F.when(value.isNull(), DASH)
        .when(F.abs(value) >= 1e9, F.format_string("%.1f bi", value / 1e9))
        .when(F.abs(value) >= 1e6, F.format_string("%.0f mi", value / 1e6))
        .otherwise(_spaced(F.format_number(value, 0)))
    )


def margin_class(margin: Column) -> Column:
    return F.when(margin.isNull(), "").when(margin > 0, "delta-pos").otherwise("delta-neg")
