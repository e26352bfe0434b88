"""Connected components of a graph of links, as a loop of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from insight.llm.shared import written


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for the nodes of ``links`` (``a, b``, longs): the smallest node that
    each reaches.

    In each round every node joins the neighbour whose hash is smallest, itself included, and
    the graph is contracted. The hash changes with the round, so a long chain shrinks by a
    constant factor too. Aggregates are combined before the shuffle, and each round is written,
    so the plan stays short. Links of a node to itself, and repeated ones, change nothing. No
    links give no rows.
    """
    edges = written(links.where("a <> b").select("a", "b").distinct())
    assigned = None
    turn = 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        by_hash = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("n"))  # noqa: B023, E731
        joined = written(
            both.groupBy("a")
            .agg(F.min(by_hash("b")).alias("other"))
            .select("a", F.least(by_hash("a"), F.col("other"))["n"].alias("to"))
        )
        if assigned is None:
            assigned = joined.select(F.col("a").alias("node"), F.col("to").alias("root"))
        else:
            assigned = written(
                assigned.join(joined, F.col("root") == F.col("a"), "left").select(
                    "node", F.coalesce("to", "root").alias("root")
                )
            )
        left = edges.join(joined, "a").select(F.col("to").alias("x"), "b")
        edges = written(
            left.join(joined.select(F.col("a").alias("b"), F.col("to").alias("y")), "b")
            .where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct()
        )
        turn += 1
    if assigned is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    smallest = assigned.groupBy("root").agg(F.min("node").alias("component"))
    return written(assigned.join(smallest, "root").select("node", "component"))
