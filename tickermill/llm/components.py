"""Connected components of a link table by alternating star contraction, all in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickermill.session import stored


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(id, component_id) for every id that occurs in a link between different ids.

    component_id is the smallest id that links reach. Each round hangs the neighbours of a node
    below its smallest neighbour; edges only ever point to smaller ids, so the rounds end with one
    star per component. Every round is a written table: a lost executor repeats one round at most.
    Null ids and links of an id with itself are ignored; no links give an empty table.
    """
    a, b = F.col(left), F.col(right)
    edges = stored(
        links.where(a != b).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(),
        "links",
    )
    state = _state(edges)
    while state[0]:
        edges = _small_star(_large_star(edges))
        after = _state(edges)
        if after == state:
            break
        state = after
    return edges.select(F.col("hi").alias("id"), F.col("lo").alias("component_id"))


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
    # A table of its own, so that the join below deals out both sides and can split a hot node.
    least = stored(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "stars")
    moved = both.where("v > u").join(least, "u").where("v != m")
    return stored(moved.select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct(), "links")


def _small_star(edges: DataFrame) -> DataFrame:
    least = stored(edges.groupBy("hi").agg(F.min("lo").alias("m")), "stars")
    moved = edges.join(least, "hi").where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return stored(moved.union(least.select("hi", "m")).distinct(), "links")
