"""Fork trees: the root and the depth of every repository, by pointer doubling."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventloom.functions.scratch import staged


def first_forks(forks: DataFrame) -> DataFrame:
    """child and parent: of several forks to one child, the first by time, then by parent.

    ``forks`` has parent, child and forked_at; rows without either id are left out, and a
    repository is not its own fork.
    """
    known = forks.where("parent is not null and child is not null and parent <> child")
    first = F.min(F.struct(F.col("forked_at").isNull(), "forked_at", "parent")).alias("first")
    return known.groupBy("child").agg(first).select("child", F.col("first.parent").alias("parent"))


def fork_trees(forks: DataFrame) -> DataFrame:
    """repo_id, root_id and depth of every repository in ``forks``; roots have depth 0.

    Every repository points to an ancestor and knows how far that is; a round replaces
    the pointer by that ancestor's own, so rounds are logarithmic in the depth. Rounds are
    staged. Each of them reaches new roots until the rest lies on or behind cycles, which
    have no root: those get nulls. A repository with very many forks is one row of the
    side that is looked up.
    """
    edges = staged(first_forks(forks), "forks")
    tops = edges.select(F.col("parent").alias("node")).distinct().join(edges, F.col("node") == F.col("child"), "left_anti")
    below = edges.select(
        F.col("child").alias("node"), F.col("parent").alias("ancestor"), F.lit(1).cast("long").alias("far"), F.lit(False).alias("done")
    )
    above = tops.select("node", F.col("node").alias("ancestor"), F.lit(0).cast("long").alias("far"), F.lit(True).alias("done"))
    known, open_before = staged(below.union(above), "ancestors"), None
    while True:
        is_open = known.where("not done").count()
        if is_open in (0, open_before):
            break
        open_before = is_open
        step = known.select(
            F.col("node").alias("at"), F.col("ancestor").alias("next"), F.col("far").alias("further"), F.col("done").alias("arrived")
        )
        moved = known.where("not done").join(step, F.col("ancestor") == F.col("at")).select(
            "node", F.col("next").alias("ancestor"), (F.col("far") + F.col("further")).alias("far"), F.col("arrived").alias("done")
        )
        known = staged(known.where("done").union(moved), "ancestors")
    return known.select(
        F.col("node").alias("repo_id"),
        F.when(F.col("done"), F.col("ancestor")).alias("root_id"),
        F.when(F.col("done"), F.col("far")).alias("depth"),
    )
