"""Existence checks of facts against dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from eventloom.functions.scratch import staged


#: The most rows of a staged table that may be broadcast. Spark's size check sees compressed
#: files; in memory rows of a few numbers take ten times as much and more.
BROADCAST_ROWS = 100_000


def bounded(staged_rows: DataFrame) -> DataFrame:
    """A staged table that joins by a shuffle where it has more than ``BROADCAST_ROWS`` rows.

    They are counted in the footers of its files.
    """
    return staged_rows if staged_rows.count() <= BROADCAST_ROWS else staged_rows.hint("merge")


def unknown_ids(facts: DataFrame, dimensions: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Per key column, the ids that ``facts`` uses and its dimension lacks.

    The facts are read once, however many keys there are: each row gives a
    (key, id) pair per key, and ``distinct`` is combined on the map side, so a hot
    id costs one row per task. The result is normally tiny. It is staged: its size
    on disk lets Spark broadcast it when it is small and fall back to a shuffle
    join when not.
    """
    pairs = F.array(*(F.struct(F.lit(key).alias("key"), F.col(key).cast("bigint").alias("id")) for key in dimensions))
    used = staged(
        facts.select(F.explode(pairs).alias("used")).select("used.*").where("id is not null").distinct(), "used-ids"
    )

    def missing(key: str) -> DataFrame:
        known = dimensions[key].select(F.col(key).alias("id"))
        return used.where(F.col("key") == key).join(known, "id", "left_anti").select("key", "id")

    found = staged(reduce(DataFrame.union, map(missing, dimensions)), "unknown-ids")
    return {
        key: found.where(F.col("key") == key).select(F.col("id").alias(key)) for key in dimensions
    }


def keep_known(facts: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """Facts whose keys all exist; equals left-semi joins with the dimensions.

    Removing the few unknown ids spares the fact rows the shuffles that semi
    joins with large dimensions would need.
    """
    columns = facts.columns
    for key, unknown in unknown_ids(facts, dimensions).items():
        facts = facts.join(unknown, key, "left_anti").where(f"{key} is not null")
    return facts.select(*columns)
