"""Interval join: pairs of rows of one key within a stretch of time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventloom.functions.cells import micros
from eventloom.functions.scratch import staged

#: Right rows of one key and bucket that are joined by one task.
MOST = 100_000


def interval_join(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, seconds: int, most: int = MOST
) -> DataFrame:
    """Pairs of one ``key`` with ``right_time`` from 0 to ``seconds`` after ``left_time``.

    Time is cut into buckets of ``seconds``: a match lies in the bucket of the left row
    or in the next one, so an equi-join on key and bucket finds every pair, once. Right
    rows of a bucket with more than ``most`` are dealt over several salts, and left rows
    of such a bucket are repeated for each. Rows without key or time match nothing.
    """
    if clash := {c.lower() for c in left.columns} & {c.lower() for c in right.columns} - {key.lower()}:
        raise ValueError(f"columns in both tables: {sorted(clash)}")

    def bucket(time: str) -> Column:
        return F.floor(micros(F.col(time)) / (seconds * 1_000_000))

    ours = left.where(F.col(key).isNotNull() & F.col(left_time).isNotNull())
    theirs = right.where(F.col(key).isNotNull() & F.col(right_time).isNotNull()).withColumn("bucket", bucket(right_time))
    heavy = theirs.groupBy(key, "bucket").count().where(F.col("count") > most)
    # at most one row for every ``most`` right rows
    salts = staged(heavy.select(key, "bucket", F.ceil(F.col("count") / most).cast("int").alias("salts")), "salts")
    parts = F.coalesce("salts", F.lit(1))
    spread = theirs.join(salts, [key, "bucket"], "left").withColumn(
        "salt", F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in right.columns)), parts).cast("int")
    )
    near = ours.withColumn("first", bucket(left_time)).withColumn(
        "bucket", F.explode(F.array(F.col("first"), F.col("first") + 1))
    )
    near = near.join(salts, [key, "bucket"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), parts - 1)))
    apart = micros(F.col(right_time)) - micros(F.col(left_time))
    pairs = near.drop("first", "salts").join(spread.drop("salts"), [key, "bucket", "salt"])
    return pairs.where(apart.between(0, seconds * 1_000_000)).drop("bucket", "salt")
