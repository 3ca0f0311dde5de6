"""Project any DataFrame onto a declared table schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tickermill import schemas
from tickermill.functions.guards import finite_sql, parse_number_sql


def coerce_sql(name: str, source: T.DataType, kind: str) -> str:
    """Column of any simple type as one of the logical types; what cannot be converted is NULL."""
    target = schemas.LOGICAL_TYPES[kind].simpleString()
    value = f"`{name}`"
    if isinstance(source, T.NullType):
        return f"CAST(NULL AS {target})"
    if kind == "decimal":
        if isinstance(source, T.DoubleType):
            return finite_sql(value)
        as_text = isinstance(source, T.StringType)
        return finite_sql(parse_number_sql(value) if as_text else f"TRY_CAST({value} AS DOUBLE)")
    if kind in ("inteiro", "longo"):
        return f"TRY_CAST({value} AS {target})"
    if isinstance(source, schemas.LOGICAL_TYPES[kind].__class__):
        return value
    if kind == "booleano":
        # Truthiness: any non-empty text and any non-zero number counts as true.
        return f"{value} <> ''" if isinstance(source, T.StringType) else f"{value} <> 0"
    if isinstance(source, T.BooleanType):
        return f"initcap(CAST({value} AS STRING))"
    if isinstance(source, T.FloatType | T.DoubleType):
        return _plain_number_sql(f"CAST({value} AS DOUBLE)")
    return f"CAST({value} AS STRING)"


def _plain_number_sql(value: str) -> str:
    """Text of a double without exponent where that is usual: from 1e-4 up to 1e16."""
    digits = f"CAST(TRY_CAST(CAST({value} AS STRING) AS DECIMAL(38,18)) AS STRING)"
    plain = f"regexp_replace(regexp_replace({digits}, '0+$', ''), '[.]$', '.0')"
    return f"IF(abs({value}) >= 1e-4 AND abs({value}) < 1e16, {plain}, CAST({value} AS STRING))"


def conform(df: DataFrame, table: str) -> DataFrame:
    """Same columns, order and types as the table: missing become NULL, extras are dropped."""
    present = {field.name: field.dataType for field in df.schema.fields}
    return df.selectExpr(
        *[
            f"{coerce_sql(name, present.get(name, T.NullType()), kind)} AS `{name}`"
            for name, kind in schemas.logical_types(table).items()
        ]
    )
