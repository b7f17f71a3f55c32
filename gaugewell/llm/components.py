"""Connected components of links, by alternating large-star and small-star steps.

Links stay in Spark: each step is one aggregate and one join, and its result is a table in
the shared folder.  A hub's neighbours are never gathered: its smallest neighbour is an
aggregate, and the join on it can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugewell.llm.common import dropped, stored


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _smallest(both).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _smallest(down)
    kept = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return kept.unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b): the smallest node reachable.  Self links are ignored."""
    edges = stored(links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v").distinct(), "links")
    before = _state(edges)
    while before[0]:
        after = stored(_small(_large(edges)), "stars")
        dropped(edges)
        edges, now = after, _state(after)
        if now == before:
            break
        before = now
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
