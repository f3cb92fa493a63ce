"""Insert-or-update of keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

REPLACE = "replace"
KEEP = "keep"
ADD = "add"
GREATEST = "greatest"


def upsert(prior: DataFrame, new: DataFrame, keys: list[str], policy: dict[str, str]) -> DataFrame:
    """``prior`` with the rows of ``new`` inserted or merged in by ``keys``.

    ``policy`` says per column what happens to a row that exists already:
    replace its value, keep it, add to it, or take the greater one. Columns
    without a policy are kept. Both sides must be unique on the keys. The result
    has the columns of ``prior``.
    """
    old = prior.withColumn("in_prior", F.lit(True)).alias("old")
    fresh = new.withColumn("in_new", F.lit(True)).alias("new")
    both = old.join(fresh, keys, "full")

    def merged(name: str):
        if name in keys:
            return F.col(name)
        if name not in new.columns:
            return F.col(f"old.{name}")
        before, after = F.col(f"old.{name}"), F.col(f"new.{name}")
        rule = policy.get(name, KEEP)
        if rule == REPLACE:
            value = after
        elif rule == KEEP:
            value = before
        elif rule == ADD:
            value = F.coalesce(before, F.lit(0)) + F.coalesce(after, F.lit(0))
        elif rule == GREATEST:
            value = F.greatest(before, after)
        else:
            raise ValueError(f"unknown merge policy: {rule!r}")
        return (
            F.when(F.col("in_prior").isNull(), after)
            .when(F.col("in_new").isNull(), before)
            .otherwise(value)
            .alias(name)
        )

    return both.select(*(merged(name) for name in prior.columns))
