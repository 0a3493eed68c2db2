"""Connected components of a table of links, by alternating star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keep

MOST_ROUNDS = 60


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Every node's neighbours (larger ones, or smaller ones and itself) are linked to its least neighbour."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    if large:
        joined = both.join(least.select("a", F.least("a", "m").alias("m")), "a").where("b > a")
        return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
    joined = both.join(least, "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node and root (the least node of its component) of every node of ``links`` (a, b: long); loops count for nothing."""
    pairs = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    pairs, seen = keep(pairs, "links"), None
    for _ in range(MOST_ROUNDS):
        # done when every node has one link and no root has one: links are (node, root)
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if not state[0] or state == seen:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).union(pairs.select("b", "b").distinct())
        seen = state
        pairs = keep(_stars(_stars(pairs, True), False), "links")
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
