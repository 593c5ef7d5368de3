"""Connected components of a graph of links, by stars that fold into each other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node it reaches) of all nodes in `links` (a, b).

    Every round ties each node's larger neighbours to the smallest one, then its smaller ones, so
    paths shrink by halves. Edges are distinct and every node's smallest neighbour is found by an
    aggregate that combines before the shuffle. That table is written: if it is small Spark sends
    it to every task, and otherwise both sides of the join are shuffled, so that the edges of a
    node with very many neighbours are split. Nothing comes to the driver but two numbers a round.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = written(edges.where("u <> v").distinct(), "edges")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "low")
        larger = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        larger = written(larger.distinct(), "larger")
        low = written(larger.groupBy("u").agg(F.min("v").alias("m")), "low")
        smaller = larger.join(low, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
            F.col("m").alias("v"),
        )
        # A node always keeps its edge to its smallest neighbour: that row has v = m.
        edges = written(smaller.distinct(), "edges")
        if (now := _state(edges)) == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38, 0)"))
    return tuple(edges.agg(F.count(F.lit(1)), digest).first())
