"""Connected components by alternating large and small stars, one landed table of edges a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadtrail.llm.staging import landed


def directed(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller node, once each, without loops."""
    return (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("child"), F.least("a", "b").alias("parent"))
        .distinct()
    )


def large_star(edges: DataFrame) -> DataFrame:
    """Every node hangs its larger neighbours under the smallest node it knows."""
    both = edges.select("child", "parent").unionAll(edges.select(F.col("parent"), F.col("child"))).toDF("node", "near")
    least = both.groupBy("node").agg(F.min("near").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    return both.join(least, "node").where("near > node").select(F.col("near").alias("a"), F.col("least").alias("b"))


def small_star(edges: DataFrame) -> DataFrame:
    """Every node hangs itself and its smaller neighbours under the smallest of them."""
    least = edges.groupBy("child").agg(F.min("parent").alias("least"))
    hung = edges.join(least, "child")
    pairs = F.array(F.struct(F.col("parent").alias("a"), F.col("least").alias("b")), F.struct(F.col("child").alias("a"), F.col("least").alias("b")))
    return hung.select(F.explode(pairs).alias("pair")).select("pair.a", "pair.b")


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of the edges ``a``, ``b`` but the roots: the smallest node it can reach.

    Rounds go on until the edges stay the same; their number grows with the logarithm of the longest path.
    """
    edges = landed(directed(edges), "edges")
    state = None
    while True:
        mark = F.sum(F.xxhash64("child", "parent").cast("decimal(38,0)"))
        found = edges.agg(F.count(F.lit(1)).alias("n"), mark.alias("mark")).first()
        if not found["n"] or (found["n"], found["mark"]) == state:
            return edges.select(F.col("child").alias("node"), F.col("parent").alias("root"))
        state = found["n"], found["mark"]
        edges = landed(directed(small_star(directed(large_star(edges)))), "edges")
