"""The set of tables that the plans read and extend."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from eventloom.schemas import TABLES


def empty_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """Every table without rows, to begin with."""
    return {name: spark.createDataFrame([], schema) for name, schema in TABLES.items()}


def completed(df: DataFrame, name: str) -> DataFrame:
    """Rows in the columns of a table; counters that are missing start at 0."""
    columns = []
    for field in StructType.fromDDL(TABLES[name]).fields:
        counter = field.dataType.simpleString() in ("bigint", "int")
        default = F.lit(0 if counter else None).cast(field.dataType)
        known = field.name in df.columns
        columns.append(F.col(field.name) if known else default.alias(field.name))
    return df.select(*columns)


def extended(state: dict[str, DataFrame], new: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables with new rows appended, completed where columns are missing."""
    grown = dict(state)
    for name in TABLES:
        if name in new:
            rows = completed(new[name], name)
            stored = state.get(name)
            grown[name] = rows if stored is None else stored.unionByName(rows)
    return grown
