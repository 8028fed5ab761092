"""Connected components of a table of links, by contraction in rounds on Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallymart.llm.common import written


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """links: a, b, of one orderable type whose order is as good as random (digests). rows: their number at most, if known.

    Returns node, root for every node in a link between two nodes; root is the smallest node reachable. In each
    round every node moves to its smallest smaller neighbour, the links follow their ends, and links within one
    node vanish. As the order is random, the number of nodes shrinks by a constant factor a round,
    whatever the shape (a long chain too). Minima and link sets are combined before they are shuffled, so a
    node with very many links is not hot there. Only the number of links left comes to the driver.
    """
    proper = links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    left, n = written(proper.distinct(), "links", rows), 0
    nodes = left.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("root"))

    def at(end: str) -> Column:
        return F.coalesce(f"{end}_to", end)

    while n_left := left.count():
        n = n or 2 * n_left
        move = written(left.groupBy(F.col("b").alias("root")).agg(F.min("a").alias("to")), "moves", n_left)
        nodes = written(nodes.join(move, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "nodes", n)
        step = left.join(move.select(F.col("root").alias("a"), F.col("to").alias("a_to")), "a", "left")
        step = step.join(move.select(F.col("root").alias("b"), F.col("to").alias("b_to")), "b", "left")
        step = step.select(F.least(at("a"), at("b")).alias("a"), F.greatest(at("a"), at("b")).alias("b"))
        left = written(step.filter("a <> b").distinct(), "links", n_left)
    return nodes
