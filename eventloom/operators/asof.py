"""As-of join: each row with the latest row of another table up to its time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from eventloom.functions.cells import HOUR, carried, cell_of


def asof_join(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, unit: str = HOUR
) -> DataFrame:
    """All rows of ``left``, each with the columns of the latest ``right`` row of its key.

    Latest is the greatest ``right_time`` that is not after ``left_time``; of rows of one
    time, the one whose other columns are greatest. A row without key, time or such a
    row gets nulls. Apart from the key, the tables' columns have different names.

    Both tables are sorted together inside a cell of key and time, and the latest right
    row before a cell is carried into it: one shuffle, no pair of rows is ever compared.
    """
    added = [c for c in right.columns if c != key]
    if clash := {c.lower() for c in added} & {c.lower() for c in left.columns}:
        raise ValueError(f"columns in both tables: {sorted(clash)}")
    value = F.struct(F.col(right_time).alias("at"), F.struct(*(F.col(f"`{c}`") for c in added)).alias("row"))
    row = F.struct(*(F.col(f"`{c}`") for c in left.columns))
    kinds = {"own": left.select(row.alias("r")).schema["r"].dataType, "found": right.select(value.alias("r")).schema["r"].dataType}
    known = F.col(key).isNotNull() & F.col(left_time).isNotNull()
    ours = left.where(known).select(
        F.col(key).alias("k"), F.col(left_time).alias("at"), F.lit(1).alias("side"),
        row.alias("own"), F.lit(None).cast(kinds["found"]).alias("found"),
    )
    theirs = right.where(F.col(key).isNotNull() & F.col(right_time).isNotNull()).select(
        F.col(key).alias("k"), F.col(right_time).alias("at"), F.lit(0).alias("side"),
        F.lit(None).cast(kinds["own"]).alias("own"), value.alias("found"),
    )
    both = ours.union(theirs).withColumn("cell", cell_of(F.col("at"), unit))
    earlier = carried(both.select("k", "cell", "found"), ["k"], "cell", F.col("found"), "carried")
    so_far = Window.partitionBy("k", "cell").orderBy("at", "side", "found.row").rowsBetween(Window.unboundedPreceding, 0)
    latest = F.coalesce(F.last("found", ignorenulls=True).over(so_far), F.col("carried")).alias("latest")
    matched = both.join(earlier, ["k", "cell"]).select("side", "own", latest).where("side = 1")
    result = matched.select("own.*", *(F.col(f"latest.row.`{c}`").alias(c) for c in added))
    alone = left.where(~known).select(
        "*", *(F.lit(None).cast(right.schema[c].dataType).alias(c) for c in added)
    )
    return result.union(alone)
