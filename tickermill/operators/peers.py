"""Peer groups: sector, else macro group, else the whole source; and midranks inside them.

Peers are eligible rows of the same run date and the same `fonte`. A row ranked at a wider level
is compared with all rows of that level, including rows whose own level is narrower, so each
level is ranked over its full membership and only the asking rows keep the answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickermill.operators.ranking import join_null_safe, ranked
from tickermill.session import stored

# Fixed values.
MIN_GROUP = 5
SECTOR, MACRO, UNIVERSE = "setor", "macro", "universo"
FINANCIAL, NON_FINANCIAL, STANDARD = "financeiro", "nao_financeiro", "padrao"

RUN = "data_coleta"
_CELL = [RUN, "fonte", "_setor", "_macro"]
_ASKED = ["_ask_universo", "_ask_macro"]
_GROUPS = ["_in_universo", "_in_macro", "_in_setor"]


def is_eligible() -> Column:
    return F.coalesce(F.col("elegivel_score"), F.lit(False))


def weight_profile() -> Column:
    return F.when(F.col("setor_financeiro"), FINANCIAL).otherwise(STANDARD)


def macro_group() -> Column:
    return F.when(F.col("setor_financeiro"), FINANCIAL).otherwise(NON_FINANCIAL)


def group_cells(df: DataFrame) -> DataFrame:
    """Eligible rows per (run, source, sector, macro), with group sizes and the level used.

    One aggregation of the rows, which is written; all the rest works on the cells, of which there
    are at most two per sector, source and run. The number of a group's smallest cell stands for
    the group, so that rows are ranked by two numbers instead of four texts.
    """
    counted = stored(df.where(is_eligible()).groupBy(*_CELL).agg(F.count("*").alias("_n")), "cells")
    cells = (
        counted.withColumn("_cell", F.monotonically_increasing_id())
        .withColumn("_in_universo", F.min("_cell").over(W.partitionBy(RUN, "fonte")))
        .withColumn("_in_macro", F.min("_cell").over(W.partitionBy(RUN, "fonte", "_macro")))
        .withColumn("_in_setor", F.min("_cell").over(W.partitionBy(RUN, "fonte", "_setor")))
        .withColumn("n_universo", F.sum("_n").over(W.partitionBy(RUN, "fonte")))
        .withColumn("n_macro", F.sum("_n").over(W.partitionBy(RUN, "fonte", "_macro")))
        .withColumn("n_setor", F.sum("_n").over(W.partitionBy(RUN, "fonte", "_setor")))
        .withColumn(
            "grupo_usado",
            F.when((F.col("_setor") != "") & (F.col("n_setor") >= MIN_GROUP), SECTOR)
            .when(F.col("n_macro") >= MIN_GROUP, MACRO)
            .otherwise(UNIVERSE),
        )
    )
    asking = lambda level, *keys: F.sum(
        F.when(F.col("grupo_usado") == level, F.col("_n")).otherwise(0)
    ).over(W.partitionBy(RUN, "fonte", *keys))
    return cells.withColumn("_ask_universo", asking(UNIVERSE)).withColumn(
        "_ask_macro", asking(MACRO, "_macro")
    ).drop("_cell")


def with_cell_keys(df: DataFrame) -> DataFrame:
    return df.withColumns({"_setor": F.coalesce("setor", F.lit("")), "_macro": macro_group()})


def choose_groups(df: DataFrame) -> DataFrame:
    """Add `grupo_usado` and `n_grupo`; ineligible rows get NULL and 0.

    The group cells are written to the shared folder when this is called: later steps join a table
    of known size, which Spark broadcasts only if it is small, instead of aggregating again.
    """
    return with_groups(df).drop("_setor", "_macro", "n_universo", "n_macro", "n_setor", *_ASKED, *_GROUPS)


def with_groups(df: DataFrame) -> DataFrame:
    """`choose_groups` with the keys and sizes of all levels kept, as `midranks` needs them."""
    keyed = with_cell_keys(df)
    return _attach(keyed, stored(group_cells(keyed), "cells").drop("_n"))


def _attach(keyed: DataFrame, cells: DataFrame) -> DataFrame:
    joined = join_null_safe(
        keyed.withColumn("_ok", is_eligible()),
        cells.withColumn("_ok", F.lit(True)),
        [*_CELL, "_ok"],
        "left",
    )
    size = (
        F.when(F.col("grupo_usado") == SECTOR, F.col("n_setor"))
        .when(F.col("grupo_usado") == MACRO, F.col("n_macro"))
        .when(F.col("grupo_usado") == UNIVERSE, F.col("n_universo"))
        .otherwise(0)
    )
    return joined.withColumn("n_grupo", size.cast("int")).drop("_ok")


def metric_values(metrics: dict[str, int]) -> Column:
    """Array of (metric code, signed value): larger is better for every metric.

    Zero is kept unsigned, so that 0 and -0 tie.
    """
    pairs = [
        f"named_struct('metrica', {i}Y, 'valor', IF({name} = 0, 0D, {'' if sign > 0 else '-'}{name}))"
        for i, (name, sign) in enumerate(metrics.items())
    ]
    return F.expr(f"array({', '.join(pairs)})")


def peer_values(rows: DataFrame, metrics: dict[str, int], ids: list[str]) -> DataFrame:
    """(ids, nivel, grupo, pergunta, metrica, valor) of each row in each of its groups, missing values left out.

    `rows` come from `with_groups`. A row belongs to its sector, and to its macro group and universe
    where some row asks at that level; all of them count there, and only the asking ones need the answer.
    """
    c = F.col

    def level(applies: Column, code: int, name: str, group: str) -> Column:
        asked = c("grupo_usado") == name
        return F.when(
            applies, F.struct(F.lit(code).cast("byte").alias("nivel"), c(group).alias("grupo"), asked.alias("pergunta"))
        )

    levels = F.array(
        level(c("grupo_usado") == SECTOR, 0, SECTOR, "_in_setor"),
        level((c("_ask_macro") > 0) & (c("n_macro") >= MIN_GROUP), 1, MACRO, "_in_macro"),
        level((c("_ask_universo") > 0) & (c("n_universo") >= MIN_GROUP), 2, UNIVERSE, "_in_universo"),
    )
    present = F.filter(metric_values(metrics), lambda m: m["valor"].isNotNull())
    return (
        rows.where(is_eligible())
        .select(*ids, present.alias("_m"), F.explode(levels).alias("_g"))
        .where(c("_g").isNotNull())
        .select(*ids, "_g.*", F.inline("_m"))
    )


# What `peer_values` are ranked by.
RANK_KEYS = ["grupo", "nivel", "metrica"]


def percentile() -> Column:
    """Midrank of a ranked value: rows below it and half of its ties, as a share of the group."""
    return (F.col("abaixo") + F.lit(0.5) * F.col("iguais")) / F.col("n_valores")


def midranks(
    rows: DataFrame, metrics: dict[str, int], ids: list[str], ranges: int | None = None
) -> DataFrame:
    """Midrank percentile of each asked metric: (ids, metrica, n_valores, percentil).

    `rows` come from `with_groups`. `metrics` maps a column to +1 (larger is better) or -1. `ids`
    must name a row uniquely, among the rows of its run and `fonte` at least. See `ranking` for
    `ranges` and how large groups are cut.
    """
    answers = ranked(peer_values(rows, metrics, ids), RANK_KEYS, "valor", F.col("pergunta"), ranges)
    return answers.select(*ids, "metrica", "n_valores", percentile().alias("percentil"))
