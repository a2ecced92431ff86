"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.llm.common import spread_join, staged


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first())


def connected_components(spark: SparkSession, edges: DataFrame, rows: int | None = None) -> DataFrame:
    """(a, b) edges -> (node, root), root the smallest node of the component; nodes without an edge are not listed.

    Each round hangs the larger neighbours of every node on its smallest one, then the smaller ones; the edges end
    as stars around the roots. Minima are taken by partial aggregation and joined back by a split join, so the many edges of
    one node never meet in one task. Every round is written to the shared folder; ``rows``, about how many edges there may
    be, only sets the number of files.
    """
    edges = staged(spark, edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc", rows)
    seen = _signature(edges)
    while seen[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"), F.count("*").alias("edges"))
        large = spread_join(both.where("b > a"), low, "a", "edges", ["b"], 2 * seen[0]).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = staged(spark, large.where("a <> b").distinct(), "cc-large", 2 * seen[0])
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("edges"))
        small = spread_join(large, low, "a", "edges", ["b"], 2 * seen[0]).select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        edges = staged(spark, small, "cc-small", 2 * seen[0])
        now = _signature(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
