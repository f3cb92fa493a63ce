"""Per-batch tables behind the streams.

``foreachBatch`` may run a batch again after a failure. Every batch therefore
writes only folders that carry its own ``batch_id``, by overwriting them, so a
replay puts back the same rows. Running totals are kept as small per-batch
increments, added up on reading, and never by rewriting large state.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from eventloom.functions.time_windows import date_text

BATCH = "batch_id"

Fold = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class BatchTable:
    """A Parquet table whose folders end in ``batch_id=N``."""

    spark: SparkSession
    path: str
    schema: str
    partitions: tuple[str, ...] = ()

    def create(self) -> BatchTable:
        """Make the table exist, so that it can be read before the first batch."""
        self.spark.createDataFrame([], self._schema()).write.mode("ignore").parquet(self.path)
        return self

    def _schema(self) -> StructType:
        return StructType.fromDDL(f"{self.schema}, {BATCH} bigint")

    def write(self, rows: DataFrame, batch_id: int) -> None:
        columns = [f.name for f in self._schema().fields]
        marked = rows.withColumn(BATCH, F.lit(batch_id).cast("bigint")).select(*columns)
        if self.partitions:
            marked = marked.hint("rebalance", *self.partitions)
        (
            marked.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*self.partitions, BATCH)
            .parquet(self.path)
        )

    def read(self) -> DataFrame:
        return self.spark.read.schema(self._schema()).parquet(self.path)

    def on_dates(self, dates) -> DataFrame:
        """Rows of some dates, listing only their folders."""
        names = ",".join(map(date_text, sorted(dates)))
        folders = f"{self.path}/{self.partitions[0]}={{{names}}}"
        reader = self.spark.read.schema(self._schema()).option("basePath", self.path)
        try:
            return reader.parquet(folders)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self._schema())

    def rows(self) -> DataFrame:
        return self.read().drop(BATCH)

    def compacted(self, path: str, fold: Fold | None = None) -> BatchTable:
        """A new table at ``path`` in which all batches before the last are one.

        ``fold`` combines their rows; without it they are only gathered into fewer
        files. The last batch stays by itself, because a stream that was stopped may
        run it again. Call this between runs and start the stream on the new table;
        this one is left as it is.
        """
        new = BatchTable(self.spark, path, self.schema, self.partitions).create()
        last = self.read().agg(F.max(BATCH)).first()[0]
        if last is not None:
            before = self.read().where(F.col(BATCH) < last)
            folded = fold(before) if fold else before
            new.write(folded if self.partitions else folded.hint("rebalance"), last - 1)
            new.write(self.read().where(F.col(BATCH) == last), last)
        return new
