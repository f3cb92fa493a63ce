"""Connected components by alternating large and small stars.

Every round hangs a node's neighbours on the smallest node it knows, until all nodes
of a component hang on its smallest. Minima are combined on the map side, and the
edge table is staged each round, so lineage stays short and lost executors cost one
round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventloom.functions.scratch import staged


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select("v", "u")).where("u != v")


def large_star(edges: DataFrame) -> DataFrame:
    """Neighbours greater than a node go to its smallest neighbour, or itself."""
    near = both_ways(edges)
    least = near.groupBy("u").agg(F.min("v").alias("m"))
    return (
        near.join(least, "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        .where("u != v")
        .distinct()
    )


def small_star(edges: DataFrame) -> DataFrame:
    """Neighbours smaller than a node, and the node, go to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return hung.union(own).where("u != v").distinct()


def state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node and its component's smallest node as root, for every linked node but roots.

    ``edges`` has u and v of one orderable type. Loops and repeated edges do no harm.
    """
    edges = staged(edges.select("u", "v").where("u != v").distinct(), "edges")
    before = None
    while (now := state(edges)) != before:
        before = now
        edges = staged(small_star(large_star(edges)), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
