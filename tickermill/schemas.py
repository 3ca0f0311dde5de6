"""Schema registry: five tables, each with one partition column that comes last."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

DEFAULT_DATABASE = "default"

LOGICAL_TYPES = {
    "texto": T.StringType(),
    "decimal": T.DoubleType(),
    "inteiro": T.IntegerType(),
    "longo": T.LongType(),
    "booleano": T.BooleanType(),
}

# Table and column names, in the physical order of the stored files.
PRICES = "precos_acoes"
BRONZE = "bronze_fundamentos"
SILVER = "silver_indicadores_fundamentalistas"
SERIES = "silver_precos_brapi"
GOLD = "gold_classificacao_ativos"
SCREENER_VIEW = "gold_screener_fundamentus"

SCREENER_INDICATORS = [
    "cotacao",
    "preco_lucro",
    "preco_valor_patrimonial",
    "psr",
    "dividend_yield",
    "preco_ativo",
    "preco_capital_giro",
    "preco_ebit",
    "preco_ativo_circ_liquido",
    "ev_ebit",
    "ev_ebitda",
    "margem_bruta",
    "margem_ebit",
    "margem_liquida",
    "liq_corrente",
    "roic",
    "roe",
    "liquidez_2meses",
    "patrimonio_liquido",
    "divida_liquida_patrimonio",
    "cresc_receita_5a",
]

EXTRA_INDICATORS = [
    "lpa",
    "vpa",
    "valor_mercado",
    "margem_ebitda",
    "divida_bruta_patrimonio",
    "divida_liquida_ebitda",
    "cresc_receita_12m",
    "retorno_sobre_ativos",
    "volatilidade_anualizada",
    "beta",
    "enterprise_value",
    "ebit_estimado",
    "ebitda",
    "receita_total",
    "divida_total",
    "caixa_total",
    "lucro_liquido",
    "acoes_emitidas",
    "ativo_total_estimado",
]


@dataclass(frozen=True)
class Table:
    name: str
    data: tuple[tuple[str, str], ...]
    partition: tuple[tuple[str, str], ...]
    keys: tuple[str, ...]


_DECLARED = (
    (
        PRICES,
        [
            ("ticker", "texto"),
            ("abertura", "decimal"),
            ("maxima", "decimal"),
            ("minima", "decimal"),
            ("fechamento", "decimal"),
            ("volume", "longo"),
            ("evento_ts", "texto"),
        ],
        "data_pregao",
        (),
    ),
    (
        BRONZE,
        [
            ("ticker", "texto"),
            ("payload_json", "texto"),
            ("http_status", "inteiro"),
            ("modulos_solicitados", "texto"),
            ("fonte", "texto"),
            ("coletado_em", "texto"),
        ],
        "data_coleta",
        ("ticker", "data_coleta"),
    ),
    (
        SILVER,
        [
            ("ticker", "texto"),
            ("nome_longo", "texto"),
            ("setor", "texto"),
            ("industria", "texto"),
            *[(name, "decimal") for name in SCREENER_INDICATORS + EXTRA_INDICATORS],
            ("fonte", "texto"),
            ("classe_ativo", "texto"),
            ("setor_financeiro", "booleano"),
            ("elegivel_score", "booleano"),
            ("motivo_inelegibilidade", "texto"),
            ("lucro_negativo", "booleano"),
            ("cobertura_campos_pct", "decimal"),
            ("pontos_serie", "inteiro"),
            ("preco_ativo_origem", "texto"),
            ("roic_origem", "texto"),
            ("dividend_yield_origem", "texto"),
            ("liquidez_2meses_origem", "texto"),
            ("cresc_receita_origem", "texto"),
            ("coletado_em", "texto"),
        ],
        "data_coleta",
        ("ticker", "data_coleta"),
    ),
    (
        SERIES,
        [
            ("ticker", "texto"),
            ("abertura", "decimal"),
            ("maxima", "decimal"),
            ("minima", "decimal"),
            ("fechamento", "decimal"),
            ("fechamento_ajustado", "decimal"),
            ("volume", "longo"),
            ("data_coleta", "texto"),
            ("fonte", "texto"),
        ],
        "data_pregao",
        ("ticker", "data_pregao"),
    ),
    (
        GOLD,
        [
            ("ticker", "texto"),
            ("cotacao", "decimal"),
            ("score_final", "decimal"),
            ("nota", "texto"),
            ("score_valuation", "decimal"),
            ("score_rentabilidade", "decimal"),
            ("score_solidez", "decimal"),
            ("score_dividendos", "decimal"),
            ("grupo_usado", "texto"),
            ("n_grupo", "inteiro"),
            ("perfil_pesos", "texto"),
            ("cobertura_indicadores_pct", "decimal"),
            ("confianca", "texto"),
            ("setor", "texto"),
            ("industria", "texto"),
            ("classe_ativo", "texto"),
            ("porte", "texto"),
            ("perfil_risco", "texto"),
            ("perfil_investidor", "texto"),
            ("valor_mercado", "decimal"),
            ("volatilidade_anualizada", "decimal"),
            ("liquidez_2meses", "decimal"),
            ("valor_graham", "decimal"),
            ("margem_seguranca", "decimal"),
            ("flag_graham", "booleano"),
            ("preco_teto_bazin", "decimal"),
            ("flag_bazin", "booleano"),
            ("rank_magic_formula", "inteiro"),
            ("flag_pl_barato", "booleano"),
            ("flag_pvp_barato", "booleano"),
            ("flag_roe_bom", "booleano"),
            ("flag_endiv_ok", "booleano"),
            ("flag_liquidez_ok", "booleano"),
            ("flag_dy_suspeito", "booleano"),
            ("elegivel_score", "booleano"),
            ("fonte", "texto"),
        ],
        "data_referencia",
        ("ticker", "data_referencia"),
    ),
)


def declare(name: str, data, partition: str | None, keys=()) -> Table:
    """Build a table, refusing unknown logical types."""
    parts = ((partition, "texto"),) if partition else ()
    for column, kind in (*data, *parts):
        if kind not in LOGICAL_TYPES:
            raise ValueError(f"unknown logical type {kind!r} for column {column!r}")
    return Table(name, tuple(data), parts, tuple(keys))


TABLES = {row[0]: declare(*row) for row in _DECLARED}


def table(name: str) -> Table:
    if name not in TABLES:
        raise KeyError(f"table {name!r} is not registered; known: {sorted(TABLES)}")
    return TABLES[name]


def logical_types(name: str) -> dict[str, str]:
    spec = table(name)
    return dict(spec.data + spec.partition)


def columns(name: str) -> list[str]:
    return list(logical_types(name))


def data_columns(name: str) -> list[str]:
    return [column for column, _ in table(name).data]


def partition_columns(name: str) -> list[str]:
    return [column for column, _ in table(name).partition]


def key_columns(name: str) -> list[str]:
    return list(table(name).keys)


def struct(name: str) -> T.StructType:
    """Declared schema; readers pass it so that partition values stay strings."""
    return T.StructType(
        [T.StructField(column, LOGICAL_TYPES[kind]) for column, kind in logical_types(name).items()]
    )


def ddl(name: str) -> str:
    """Column list as DDL text, partition column last."""
    return ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in struct(name).fields)


def location(name: str, warehouse: str) -> str:
    return f"{warehouse.rstrip('/')}/{table(name).name}/"


def qualified(name: str, database: str = DEFAULT_DATABASE) -> str:
    return f"{database}.{table(name).name}"


def create_table_sql(
    name: str, warehouse: str, database: str = DEFAULT_DATABASE
) -> str:
    """External Parquet table over the stored files."""
    partition = partition_columns(name)
    partitioned = f"PARTITIONED BY ({', '.join(partition)})\n" if partition else ""
    return (
        f"CREATE TABLE IF NOT EXISTS {qualified(name, database)} ({ddl(name)})\n"
        f"USING parquet\n{partitioned}LOCATION '{location(name, warehouse)}'"
    )


# Tables of one row per run and ticker that are joined with each other run by run.
BUCKET_COLUMN = "ticker"


def bucketed(name: str, database: str = DEFAULT_DATABASE) -> str:
    """Name of the table's bucketed copy."""
    return f"{qualified(name, database)}_por_{BUCKET_COLUMN}"


def create_bucketed_sql(name: str, warehouse: str, buckets: int, database: str = DEFAULT_DATABASE) -> str:
    """External Parquet table in which each run lies in `buckets` files by ticker."""
    if buckets < 1:
        raise ValueError(f"buckets must be positive, not {buckets}")
    folder = f"{location(name, warehouse).rstrip('/')}_por_{BUCKET_COLUMN}/"
    return (
        f"CREATE TABLE IF NOT EXISTS {bucketed(name, database)} ({ddl(name)})\n"
        f"USING parquet\nPARTITIONED BY ({', '.join(partition_columns(name))})\n"
        f"CLUSTERED BY ({BUCKET_COLUMN}) SORTED BY ({BUCKET_COLUMN}) INTO {buckets} BUCKETS\n"
        f"LOCATION '{folder}'"
    )
