"""Intermediate tables in the cluster's shared folder.

A staged table cuts lineage, survives lost executors, keeps column pruning and
tells the optimizer its exact size, so that Spark's own size check
(``spark.sql.autoBroadcastJoinThreshold``) decides whether it is broadcast.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, or else the session's checkpoint folder.

    Where neither is set, a folder in the warehouse takes its place, but only in a local
    session: on a cluster the warehouse may be a local folder that executors do not share.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staging"


def application_folder(spark: SparkSession) -> str:
    """The part of the shared folder that this application stages into.

    Nothing in it is needed once the application has ended.
    """
    return f"{shared_folder(spark).rstrip('/')}/eventloom-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{application_folder(spark)}/{label}-{uuid.uuid4().hex}"


_in_scope: ContextVar[list[str] | None] = ContextVar("staged_in_scope", default=None)


@contextmanager
def staging_freed(spark: SparkSession) -> Iterator[None]:
    """Frees, at its end, what ``staged`` writes within it: for work that goes on for ever."""
    paths: list[str] = []
    token = _in_scope.set(paths)
    try:
        yield
    finally:
        _in_scope.reset(token)
        delete_folders(spark, paths)


def delete_folders(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete folders, with all in them, where they exist."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for path in paths:
        files = folder(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.delete(folder(path), True)


def staged(df: DataFrame, label: str = "stage") -> DataFrame:
    """``df`` written once as Parquet and read back."""
    spark = df.sparkSession
    path = new_path(spark, label)
    if (scope := _in_scope.get()) is not None:
        scope.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def at_once(
    spark: SparkSession, work: dict[str, Callable[[], object]]
) -> tuple[dict[str, object], dict[str, Exception]]:
    """What several independent pieces of work return, done at the same time, and the errors of those that failed.

    The jobs share the cluster, so the tail of one does not leave it idle.
    """

    scope = _in_scope.get()

    @inheritable_thread_target(spark)
    def run(name: str) -> object:
        _in_scope.set(scope)
        return work[name]()

    done, failed = {}, {}
    with ThreadPoolExecutor(max_workers=len(work)) as pool:
        running = {name: pool.submit(run, name) for name in work}
        for name, piece in running.items():
            try:
                done[name] = piece.result()
            except Exception as error:
                failed[name] = error
    return done, failed


def staged_all(
    spark: SparkSession, builders: dict[str, Callable[[], DataFrame]]
) -> tuple[dict[str, DataFrame], dict[str, Exception]]:
    """Several independent frames staged at the same time, and those that failed."""
    return at_once(spark, {name: (lambda name=name: staged(builders[name](), name)) for name in builders})
