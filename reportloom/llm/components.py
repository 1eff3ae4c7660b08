"""Connected components of a graph whose edges are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reportloom.llm.store import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """For each node of edges (u, v: long) that is not the smallest of its component: u and root, the smallest.

    Every node passes its neighbours to the smallest of them, upwards and downwards in turn, until nothing changes. The
    edges of each round are written to the shared folder, so a lost executor costs no earlier round. Loops and repeated
    edges do no harm; without edges the result is empty.
    """
    state = lambda e: e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    edges = stored(edges.select("u", "v").filter("u != v").distinct())
    last = state(edges)
    while True:
        edges = stored(_small_star(_large_star(edges).distinct()).distinct())
        now = state(edges)
        if now == last:
            return edges.select("u", F.col("v").alias("root"))
        last = now
