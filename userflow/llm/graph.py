"""Connected components of a link table, by contraction towards local minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from userflow.llm.tables import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): component is the smallest
    node reachable. Self links and repeated links change nothing.

    In each round every node moves to the node of the lowest rank among its neighbours
    and itself. Ranks are hashes, other ones in each round, so that a constant part of the
    nodes goes on average, whatever the graph's shape. Links between nodes that moved to
    one place are gone, so that all links are read once and few of them again. Ranks are
    aggregated before they are shuffled; the joins read written tables, so that a node
    with very many links is split by the adaptive plan.
    """
    edges = stored(
        links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"
    )
    placed = stored(edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct(), "nodes")
    placed, turn = placed.withColumn("place", F.col("node")), 0
    while not edges.isEmpty():
        turn += 1

        def rank(node: str, turn=turn):
            return F.xxhash64(node, F.lit(turn))

        seen = edges.select(F.col("a").alias("node"), F.col("b").alias("to")).union(
            edges.select(F.col("b").alias("node"), F.col("a").alias("to"))
        )
        lowest = seen.groupBy("node").agg(F.min_by("to", rank("to")).alias("to"))
        to = F.when(rank("to") < rank("node"), F.col("to")).otherwise(F.col("node"))
        moves = stored(lowest.select("node", to.alias("to")), "moves")
        first = moves.select(F.col("node").alias("a"), F.col("to").alias("x"))
        second = moves.select(F.col("node").alias("b"), F.col("to").alias("y"))
        moved = edges.join(first, "a").join(second, "b").where("x <> y")
        edges = stored(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        steps = moves.select(F.col("node").alias("place"), "to")
        placed = stored(placed.join(steps, "place", "left").select("node", F.coalesce("to", "place").alias("place")), "places")
    smallest = stored(placed.groupBy("place").agg(F.min("node").alias("component")), "components")
    return placed.join(smallest, "place").select("node", "component")
