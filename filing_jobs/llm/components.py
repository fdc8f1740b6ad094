"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filing_jobs.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of ``edges(a, b)`` with the smallest node it reaches.

    Every round is stored, so lineage stays short. Minima are aggregated before they are shuffled, and
    a hub's rows are joined to one minimum, never gathered. Self-edges and repeats are fine.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "edges")
    before = None
    while True:
        # large star: every greater neighbour of a node hangs under the node's smallest neighbour
        both = edges.union(edges.select("b", "a").toDF("a", "b"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        # small star: a node and its smaller neighbours hang under the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m").toDF("a", "b")).where("a != b").distinct()
        edges = stored(small, "edges")
        now = edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()
        if now == before:
            break
        before = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(nodes.select("component", "component").distinct().toDF("node", "component"))
