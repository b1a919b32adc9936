"""Connected components of a graph given as rows (large-star and small-star rounds)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalytics.llm.common import cut_lineage


def _rooted(pairs: DataFrame) -> DataFrame:
    """Both directions of every edge, with the smallest node of each node's neighbourhood.

    The minimum is an aggregation with map-side combine, joined back: a node with a
    third of all edges gathers no list in one task.
    """
    both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    least = cut_lineage(least, "least")  # a plain scan, so the join can split a hot node
    return both.join(least, "a")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): root is the smallest node reachable; nodes without edges are absent.

    Each round hangs neighbours under local minima (large star, then small star) and
    is written to the shared folder; it ends when a round changes nothing.
    """
    now = cut_lineage(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "edges"
    )
    before = None
    for _ in range(max_rounds):
        large = _rooted(now).filter("b > a").select(F.col("m").alias("a"), "b")
        large = large.filter("a < b").distinct()
        # small star: every node links its smaller neighbours and itself to their minimum
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b")
        small = small.select(F.col("m").alias("x"), F.col("a").alias("y")).unionByName(
            small.select(F.col("m").alias("x"), F.col("b").alias("y"))
        )
        now = cut_lineage(small.filter("x < y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "edges")
        sign = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sign == before:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
                now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
            )
        before = sign
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
