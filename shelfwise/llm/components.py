"""Connected components by alternating large-star and small-star steps over a table of links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.scratch import stored


def _smallest(edges: DataFrame) -> DataFrame:
    """For each node ``u``, the least of itself and its neighbours ``v``."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _star(edges: DataFrame, keep: Column) -> DataFrame:
    """Tie kept neighbours of each node to the least node next to it. Hot nodes are no group: the
    least neighbour is an aggregate, and the join back is one that Spark can split."""
    return edges.join(_smallest(edges), "u").where(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _star(both, F.col("v") > F.col("u")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _smallest(down)
    tied = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for each node of ``links(u, v)``; the component is its least node.

    Links to oneself and repeated or reversed links change nothing; nulls are ignored; without
    links the result is empty.
    """
    edges = stored(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = _state(edges)
    while state[0]:
        edges = stored(_small_star(_large_star(edges)), "stars")
        before, state = state, _state(edges)
        if before == state:
            break
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(centres)
