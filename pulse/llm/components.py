"""Connected components by alternating large-star and small-star rounds.

Every round is a pair of aggregate-and-join steps over the edge table; no edge,
label or component passes through the driver.  Each round is written to the
shared work folder, which cuts the lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pulse.llm.common import write_out

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where(F.col("b") > F.col("a")).join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    # Edges come with a > b.
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(low, "a")
    up = joined.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return up.union(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of integers -> (node, root): root is the smallest node of the component.

    Nodes without an edge (and loops a = b) have no row.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    state = write_out(edges.where("a <> b").select(a.alias("a"), b.alias("b")).distinct(), "edges")
    last = None
    for _ in range(MAX_ROUNDS):
        mark = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == last or mark[0] == 0:
            break
        last = mark
        state = write_out(_small_star(_large_star(state).distinct()), "stars")
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return state.select(F.col("a").alias("node"), F.col("b").alias("root"))
