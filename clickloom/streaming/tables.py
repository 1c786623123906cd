"""Result tables of streams: plain Parquet folders that Spark's own writers keep whole.

Append streams use Spark's file sink. Its log names the files of every finished micro-batch,
and readers of the folder, streams as well, see those files once each.

Running results are written by ``foreachBatch``, a folder per micro-batch which a repeated
batch overwrites. Their values only grow, so a table is the largest value on record for
each key, whatever is written twice or folded when.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from clickloom.schemas import as_schema
from clickloom.sources.workspace import drop_folder

Resolve = Callable[[DataFrame], DataFrame]


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet folder; without rows before its first writer has come."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class SinkTable:
    """The rows of one ``kind`` in the folder of a file sink that is partitioned by kind."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        stored: StructType,
        kind: str,
        schema: StructType,
        resolve: Resolve | None = None,
    ):
        self._spark, self._path, self._stored = spark, path, stored
        self._kind, self._schema, self._resolve = kind, schema, resolve

    def table(self) -> DataFrame:
        rows = read_or_empty(self._spark, self._path, self._stored).where(F.col("kind") == self._kind)
        return as_schema(rows if self._resolve is None else self._resolve(rows), self._schema)

    def stream(self, files_at_once: int | None = None) -> DataFrame:
        """The rows as a stream; the query that writes them must have been started before."""
        # A stream that was down for long must not skip old files.
        reader = self._spark.readStream.schema(self._stored).option("maxFileAge", "36500d")
        if files_at_once is not None:
            reader = reader.option("maxFilesPerTrigger", files_at_once)
        rows = reader.parquet(self._path).where(F.col("kind") == self._kind)
        return rows.select(*self._schema.names)


class BatchTable:
    """A folder per micro-batch, each partitioned by ``by``."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: StructType,
        by: str,
        resolve: Resolve,
        fold_every: int | None = 100,
        files_per_batch: int = 4,
    ):
        self.spark, self.path, self.schema, self.by = spark, path, schema, by
        self.resolve, self.fold_every, self.files_per_batch = resolve, fold_every, files_per_batch
        self._stored = StructType([*schema.fields]).add("batch_id", LongType())

    def write(self, df: DataFrame, batch_id: int) -> None:
        """Store a micro-batch; every ``fold_every`` of them the days they touched are folded."""
        self._put(df.repartition(self.files_per_batch), batch_id)
        if self.fold_every is not None and (batch_id + 1) % self.fold_every == 0:
            self._fold(batch_id)

    def table(self) -> DataFrame:
        return as_schema(self.resolve(self.log()), self.schema)

    def log(self) -> DataFrame:
        """All rows on record with the micro-batch they are from; folds have negative numbers."""
        return read_or_empty(self.spark, self.path, self._stored)

    def _put(self, df: DataFrame, number: int) -> None:
        rows = as_schema(df, self.schema)
        rows.write.mode("overwrite").partitionBy(self.by).parquet(f"{self.path}/batch_id={number}")

    def _fold(self, batch_id: int) -> None:
        """Write the resolved rows of the days touched since the last fold, then drop their parts.

        What is dropped is in the fold already, so a failure between the two loses nothing.
        """
        log = self.log()
        days = [r[0] for r in log.where(F.col("batch_id") >= 0).select(self.by).distinct().collect()]
        touched = log.where(F.col(self.by).isin(days) | F.col(self.by).isNull())
        parts = touched.select("batch_id", self.by).distinct().collect()
        self._put(self.resolve(touched), -1 - batch_id)
        for number, day in parts:
            if number != -1 - batch_id and day is not None:
                drop_folder(self.spark, f"{self.path}/batch_id={number}/{self.by}={day}")
