"""Looking back in time within a key, with the key cut into time cells.

A window over a whole key would bring a hot key into one task. Rows are ordered
inside a cell of time instead; what came last before a cell is carried from the
cells before it, of which a key has as many as there are cells of time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

HOUR = "hour"


def cell_of(time: Column, unit: str = HOUR) -> Column:
    return F.date_trunc(unit, time)


def micros(time: Column) -> Column:
    """Microseconds since 1970 of a time without zone."""
    return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01'"), time)


def carried(rows: DataFrame, keys: list[str], cell: str, value: Column, name: str) -> DataFrame:
    """Keys, cell and ``name``: the greatest ``value`` of the nearest earlier cell that has one.

    ``value`` must grow with time; null values are passed over.
    """
    per_cell = rows.groupBy(*keys, cell).agg(F.max(value).alias(name))
    before = Window.partitionBy(*keys).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    return per_cell.withColumn(name, F.last(name, ignorenulls=True).over(before))


def with_previous(rows: DataFrame, keys: list[str], time: str, name: str, unit: str = HOUR) -> DataFrame:
    """``rows`` with the time of the row before, of the same keys, under ``name``.

    Rows of one time follow one another, in no fixed order. Rows without a key or a
    time have no row before.
    """
    known = F.col(time).isNotNull()
    for key in keys:
        known &= F.col(key).isNotNull()
    columns, cell, earlier = rows.columns, f"{name}_cell", f"{name}_carried"
    placed = rows.where(known).withColumn(cell, cell_of(F.col(time), unit))
    inside = Window.partitionBy(*keys, cell).orderBy(time)
    found = placed.join(carried(placed, keys, cell, F.col(time), earlier), [*keys, cell]).select(
        *columns, F.coalesce(F.lag(time).over(inside), F.col(earlier)).alias(name)
    )
    others = rows.where(~known).withColumn(name, F.lit(None).cast(rows.schema[time].dataType))
    return found.unionByName(others)
