"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regscope.llm.common import stage


def _large(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest node it knows."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def connected_components(spark: SparkSession, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """edges: (a long, b long), any order, no nulls. Returns (node, component) for
    every node of an edge but the components' smallest nodes, which are the
    components' names. Rows of a node with very many neighbours are aggregated
    before they meet; every step is written to the shared folder."""
    one = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = stage(spark, one, "edges")
    seen = None
    for _ in range(max_rounds):
        for step in (_large, _small):
            now = stage(spark, step(now).filter("a <> b").distinct(), "star")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = state
    raise RuntimeError("components did not settle")
