"""Exact ranks inside groups of any size, with one plan for all of them and no join back.

Rows are dealt once into ranges of even size by (group, value, hash of the rest): a small group lies in one
range, a huge one in many, and a value that many rows share is cut like any other. The rows travel with all
their columns, are ranked inside their part of the group, and keep the answer. Only groups that
run across a border of ranges need more; of them there are at most two parts for each range. A small table
with the totals and the two outer values of those parts shifts the ranks by what lies below,
and adds up the ties that run across borders.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickermill.session import stored


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join in which NULL keys match; the right key columns are dropped."""
    renamed = right.select(
        *[F.col(name).alias(f"_r_{name}" if name in keys else name) for name in right.columns]
    )
    condition = reduce(and_, (F.col(key).eqNullSafe(F.col(f"_r_{key}")) for key in keys))
    return left.join(renamed, condition, how).drop(*[f"_r_{key}" for key in keys])


def value_ranges(rows: DataFrame, groups: list[str], value: str, ranges: int | None) -> DataFrame:
    """The rows with the range `_piece` they lie in, in the order of (group, value)."""
    rest = [name for name in rows.columns if name not in (*groups, value)]
    order = [*groups, value, F.xxhash64(*rest) if rest else F.lit(0)]
    dealt = rows.repartitionByRange(*([ranges] if ranges else []), *order)
    return dealt.withColumn("_piece", F.spark_partition_id())


def _ranked_in_piece(pieces: DataFrame, groups: list[str], value: str) -> DataFrame:
    """Ranks among the rows of the group in the same range; a written table, as it is read twice."""
    part = W.partitionBy(*groups, "_piece")
    place = part.orderBy(value)
    return stored(
        pieces.withColumns(
            {
                "_below": (F.rank().over(place) - 1).cast("long"),
                "_kind": F.dense_rank().over(place).cast("long"),
                "_same": F.count("*").over(place.rangeBetween(W.currentRow, W.currentRow)),
                "_size": F.count("*").over(part),
            }
        ),
        "ranked",
    )


def _crossing(placed: DataFrame, groups: list[str], value: str) -> DataFrame:
    """A row for each part of a group that lies in several ranges: what is below it, and its outer values' ties."""
    c = F.col
    # The rows with the part's smallest and largest value tell all that is needed.
    outermost = placed.where("_below = 0 OR _below + _same = _size")
    parts = outermost.groupBy(*groups, "_piece").agg(
        F.first("_size").alias("_rows"),
        F.max("_kind").alias("_kinds"),
        F.min(value).alias("_lo"),
        F.max(value).alias("_hi"),
        F.min_by("_same", "_kind").alias("_lo_n"),
        F.max_by("_same", "_kind").alias("_hi_n"),
    )
    group, ordered = W.partitionBy(*groups), W.partitionBy(*groups).orderBy("_piece")
    lower = ordered.rowsBetween(W.unboundedPreceding, -1)
    # A value on both sides of a border is one kind.
    repeated = F.when(F.lag("_hi").over(ordered) == c("_lo"), 1).otherwise(0)
    crossing = (
        parts.withColumns({"_parts": F.count("*").over(group), "_again": repeated})
        .where("_parts > 1")
        .withColumns(
            {
                "_lower": F.coalesce(F.sum("_rows").over(lower), F.lit(0)),
                "_total": F.sum("_rows").over(group),
                "_lower_kinds": F.coalesce(F.sum("_kinds").over(lower), F.lit(0))
                - F.sum("_again").over(ordered.rowsBetween(W.unboundedPreceding, 0)),
            }
        )
    )
    # The ties of a value over all parts that have it; inner values lie in one part only.
    outer = crossing.select(
        *groups,
        "_piece",
        "_lower",
        "_total",
        "_lower_kinds",
        F.expr(
            "inline(filter(array(struct(_lo AS _value, _lo_n AS _ties, true AS _first),"
            " struct(_hi AS _value, _hi_n AS _ties, false AS _first)), x -> x._first OR _lo <> _hi))"
        ),
    )
    tied = W.partitionBy(*groups, "_value")
    before = tied.orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    counted = outer.withColumns(
        {
            "_ties_before": F.coalesce(F.sum("_ties").over(before), F.lit(0)),
            "_ties_all": F.sum("_ties").over(tied),
        }
    )
    first = lambda name: F.max(F.when(c("_first"), c(name)))
    last = lambda name: F.max(F.when(~c("_first"), c(name)))
    return counted.groupBy(*groups, "_piece", "_lower", "_total", "_lower_kinds").agg(
        first("_value").alias("_lo"),
        first("_ties_before").alias("_lo_before"),
        first("_ties_all").alias("_lo_all"),
        last("_value").alias("_hi"),
        last("_ties_all").alias("_hi_all"),
    )


def ranked(
    rows: DataFrame,
    groups: list[str],
    value: str,
    asking: Column | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Rank non-null values ascending within each group.

    Only rows that meet `asking` (all by default) are returned, but every row counts. Adds `abaixo`
    (rows with a smaller value), `iguais` (rows with the same value, itself included), `n_valores`
    (rows in the group) and `posicao_densa`. `ranges` sets the number of value ranges; by default it
    is the number of shuffle partitions.
    """
    c = F.col
    placed = _ranked_in_piece(value_ranges(rows, groups, value, ranges), groups, value)
    # At most two rows for each range, whatever the number of groups and rows.
    crossing = F.broadcast(_crossing(placed, groups, value))
    asked = placed if asking is None else placed.where(asking)
    joined = join_null_safe(asked, crossing, [*groups, "_piece"], "left")
    at_first, at_last = c(value) == c("_lo"), c(value) == c("_hi")
    lower = F.coalesce(c("_lower"), F.lit(0))
    return joined.select(
        *rows.columns,
        (lower + c("_below") - F.when(at_first, c("_lo_before")).otherwise(0)).alias("abaixo"),
        F.when(at_first, c("_lo_all")).when(at_last, c("_hi_all")).otherwise(c("_same")).alias("iguais"),
        F.coalesce(c("_total"), c("_size")).alias("n_valores"),
        (F.coalesce(c("_lower_kinds"), F.lit(0)) + c("_kind")).alias("posicao_densa"),
    )
