"""Connected components by alternating large-star and small-star steps.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Each
step is one aggregation (minimum neighbour, combined on the map side) and one
join; no neighbour list is ever collected, so a hub of any degree is only many
rows of a join that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import cut


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(low, "a").select(F.col("m").alias("a"), "b")


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("b").agg(F.min("a").alias("m"))
    linked = e.join(low, "b")
    moved = linked.select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.union(low.select(F.col("m").alias("a"), "b"))


def connected_components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; root is the least node
    reachable. Self loops, repeated and reversed edges are allowed; NULL ends are
    ignored; no edges give no rows. Not converging raises.
    """
    e = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    e = cut(e.filter("a < b").distinct())
    n, state = e.count(), None
    for _ in range(max_rounds):
        if not n:
            break
        e = _small_star(_large_star(e).filter("a < b").distinct())
        e = cut(e.filter("a < b").distinct())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not converge")
    stars = e.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return stars.union(e.select("a").distinct().select(F.col("a").alias("node"), F.col("a").alias("root")))
