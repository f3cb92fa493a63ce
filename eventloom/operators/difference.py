"""What changed between two versions of a table, with multiplicities."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventloom.functions.scratch import staged


def quoted(columns: list[str]) -> list[str]:
    return [f"`{c}`" for c in columns]


def balance(*signed: DataFrame) -> DataFrame:
    """Distinct rows and the sum of their ``n_``; counted on the map side, so many copies are one row."""
    both = signed[0]
    for more in signed[1:]:
        both = both.unionByName(more)
    columns = [c for c in both.columns if c != "n_"]
    return both.groupBy(*quoted(columns)).agg(F.sum("n_").alias("n_"))


def difference(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``new`` EXCEPT ALL ``old``, and of ``old`` EXCEPT ALL ``new``.

    ``change`` is inserted or deleted, or updated-to and updated-from where ``keys`` have
    rows of both sorts; ``copies`` says how many such rows. Nulls equal nulls, as in set
    operations.
    """
    columns = old.columns
    counted = balance(new.select(*quoted(columns)).withColumn("n_", F.lit(1)), old.withColumn("n_", F.lit(-1)))
    changed = staged(counted.where("n_ <> 0"), "changed")
    key = F.struct(*quoted(keys))
    updated = changed.groupBy(key.alias("k_")).agg((F.min("n_") < 0).alias("lost"), (F.max("n_") > 0).alias("won"))
    updated = updated.where("lost and won").select("k_", F.lit(True).alias("both_"))
    kind = F.when(
        F.col("both_"), F.when(F.col("n_") > 0, "updated-to").otherwise("updated-from")
    ).otherwise(F.when(F.col("n_") > 0, "inserted").otherwise("deleted"))
    return changed.join(updated, key == F.col("k_"), "left").select(
        kind.alias("change"), F.abs("n_").alias("copies"), *quoted(columns)
    )


def applied(old: DataFrame, changes: DataFrame) -> DataFrame:
    """``old`` after the ``changes`` that ``difference`` found."""
    columns = old.columns
    sign = F.when(F.col("change").isin("inserted", "updated-to"), F.col("copies")).otherwise(-F.col("copies"))
    counted = balance(old.withColumn("n_", F.lit(1).cast("long")), changes.select(*quoted(columns), sign.alias("n_")))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_")))
    return counted.where("n_ > 0").withColumn("n_", copies).select(*quoted(columns))
