"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tables


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (a, b) with a > b. Each node's larger (or smaller) neighbours move to its least one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = both.join(least, "a")
    if large:
        out = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link; component is the smallest node reachable.

    links: columns a, b (long, not null); order and repeats don't matter. Rounds go to written
    tables and end when a round leaves the stars as they are, after about log(nodes) rounds.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    edges = tables.stored(edges, "links")
    state = None
    while True:
        edges = tables.stored(_star(_star(edges, True), False), "stars")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    roots = edges.groupBy("b").agg(F.lit(1)).select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
