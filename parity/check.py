"""Compare registered queries with their SQL: ``python -m parity.check [folder] [names...]``."""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame, SparkSession

from parity.oracles import ORACLES
from parity.queries import REGISTRY, as_callable

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def session(cpus: int = 8, folder: str = "/tmp/eventloom-staging") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("eventloom")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", folder)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return f"{value.isoformat()}"
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def canonical(columns, rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(shaped, key=repr)


def differences(result: DataFrame, connection, sql: str) -> str:
    """Empty when both agree, else what differs first."""
    columns, rows = canonical(result.columns, [tuple(r) for r in result.collect()])
    answer = connection.execute(sql)
    expected_columns, expected = canonical([d[0] for d in answer.description], answer.fetchall())
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if len(rows) != len(expected):
        extra = [r for r in rows if r not in set(expected)][:2]
        missing = [r for r in expected if r not in set(rows)][:2]
        return f"{len(rows)} rows != {len(expected)}; extra {extra}, missing {missing}"
    for row, other in zip(rows, expected):
        if row != other or [type(v) for v in row] != [type(v) for v in other]:
            return f"{dict(zip(columns, row))} != {dict(zip(columns, other))}"
    return ""


def main(arguments: list[str]) -> int:
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    names = arguments[1:] or list(REGISTRY)
    spark, connection, failed = session(), database(sf_dir), 0
    for name in names:
        begun = time.time()
        try:
            result = as_callable(REGISTRY[name])(spark, sf_dir)
            problem = differences(result, connection, ORACLES[name]) if name in ORACLES else ""
            rows = result.count() if name not in ORACLES else ""
        except Exception as error:
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", ""
        failed += bool(problem)
        print(f"{name:32} {time.time() - begun:6.2f}s {'ok' if not problem else problem} {rows}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
