"""Connected components of an edge table by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import materialize


def _min_of(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is tied to the smallest of u and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.filter("v > u").join(_min_of(both), "u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    mins = _min_of(down)
    return (down.join(mins, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(mins.select("u", F.col("m").alias("v"))).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): root is the smallest
    node that can be reached.

    Each round is written to the shared folder; the rounds end when the edge
    set no longer changes (they grow with the logarithm of its size).
    Self-links and repeated links do no harm; null ends are left out.
    """
    edges = materialize(edges.filter("u is not null and v is not null"), "links")
    loops = edges.filter("u = v").select("u").distinct()
    now = materialize(edges.filter("u != v").select("u", "v").distinct(), "edges")
    state = None
    while True:
        now = materialize(_small_star(_large_star(now)), "stars")
        new = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(new) == state:
            break
        state = tuple(new)
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root"))
    alone = loops.select(F.col("u").alias("node"), F.col("u").alias("root"))
    return nodes.unionByName(roots).unionByName(alone).groupBy("node").agg(F.min("root").alias("root"))
