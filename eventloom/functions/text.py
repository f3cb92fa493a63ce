"""Text clean-up at ingest and for output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def clipped(column: Column | str, length: int) -> Column:
    """The first ``length`` characters; a missing text becomes ''."""
    column = F.col(column) if isinstance(column, str) else column
    return F.substring(F.coalesce(column, F.lit("")), 1, length)


def as_id(column: Column | str) -> Column:
    """A positive or negative id; missing, non-numeric and 0 become NULL."""
    column = F.col(column) if isinstance(column, str) else column
    return F.nullif(column.try_cast("bigint"), F.lit(0).cast("bigint"))


def iso(column: Column) -> Column:
    """ISO-8601 text; microseconds only where there are any."""
    whole = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(column, "SSSSSS")
    return F.when(micros == "000000", whole).otherwise(F.concat_ws(".", whole, micros))


def iso_datetimes(df: DataFrame) -> DataFrame:
    """Every timestamp column as ISO-8601 text."""
    times = [name for name, dtype in df.dtypes if dtype in ("timestamp", "timestamp_ntz")]
    return df.withColumns({name: iso(F.col(name)) for name in times}) if times else df
