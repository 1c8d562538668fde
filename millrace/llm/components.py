"""Connected components of a link table by alternating large-star and small-star joins; every step is a grouped minimum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (u, v) with u > v: each node's neighbours are linked with its smallest one."""
    both = edges.select(F.col("u").alias("n"), F.col("v").alias("m"))
    if large:
        both = both.unionByName(edges.select(F.col("v").alias("n"), F.col("u").alias("m")))
    least = both.groupBy("n").agg(F.min("m").alias("least")).select("n", F.least("n", "least").alias("least"))
    linked = both.join(least, "n")
    if large:
        out = linked.where(F.col("m") > F.col("n")).select(F.col("m").alias("u"), F.col("least").alias("v"))
    else:
        out = linked.select(F.col("m").alias("u"), F.col("least").alias("v")).unionByName(least.select(F.col("n").alias("u"), F.col("least").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of edges (u, v); root is the smallest node that can be reached. Nulls are left out."""
    edges = edges.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
    edges = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    sums = None
    for _ in range(rounds):
        edges = stored(_star(_star(edges, True), False), "links")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == sums:
            break
        sums = now
    else:
        raise RuntimeError(f"links are not settled after {rounds} rounds")
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
