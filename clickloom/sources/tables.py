"""Batch readers and writers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickloom.schemas import as_schema

# A broadcast copy sits in every executor; files unpack to several times their size.
BROADCAST_LIMIT_BYTES = 16 * 1024 * 1024


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    **more: str,
) -> dict[str, str]:
    """Options shared by JDBC reads and writes."""
    options = {"url": url, "dbtable": table}
    given = {"user": user, "password": password, "driver": driver}
    options.update({k: v for k, v in given.items() if v is not None})
    options.update(more)
    return options


def read_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A database table; with ``column`` and ``bounds`` it is read in parallel slices."""
    reader = spark.read.format("jdbc").options(**options)
    if column is not None and bounds is not None and partitions > 1:
        reader = reader.options(
            partitionColumn=column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return reader.load()


def _is_file_scan(plan) -> bool:
    """Whether a plan is a file scan under projections and filters only."""
    kind = plan.getClass().getSimpleName()
    if kind in ("Project", "Filter", "SubqueryAlias"):
        return _is_file_scan(plan.children().head())
    return kind == "LogicalRelation"


def estimated_bytes(df: DataFrame) -> int:
    """Size the optimizer expects for ``df`` (file sizes and filters, no job is run)."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast for files of checked size; all else joins as the optimizer sees fit.

    A hinted broadcast cannot fall back, and only of a file scan is the size known to hold:
    joins and generators are estimated, so they are left to run-time statistics.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    return F.broadcast(df) if _is_file_scan(plan) and estimated_bytes(df) <= limit else df


def replace_task_rows(df: DataFrame, path: str, schema: StructType, task_id: int) -> None:
    """Replace the result rows of one task, so that a job can be run again.

    They lie in a folder of the task below ``path`` and are overwritten as a whole, also by
    an empty result. Read the table with :func:`read_results`.
    """
    rows = as_schema(df, schema).drop("task_id")
    rows.write.mode("overwrite").parquet(f"{path}/task_id={task_id}")


def read_results(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A result table in its fixed schema, the tasks' folders as column ``task_id``."""
    return as_schema(spark.read.parquet(path), schema)


def append_parquet(
    df: DataFrame, path: str, schema: StructType, partition_by: tuple[str, ...] = ()
) -> None:
    """Append a result in its fixed schema, one distributed write."""
    as_schema(df, schema).write.mode("append").partitionBy(*partition_by).parquet(path)


def append_jdbc(
    df: DataFrame, options: Mapping[str, str], schema: StructType, batch_size: int = 5000
) -> None:
    """Append a result to a database table, in statement batches per partition."""
    writer = as_schema(df, schema).write.format("jdbc").mode("append")
    writer.options(**options, batchsize=str(batch_size)).save()


def replace_partitions(
    df: DataFrame, path: str, schema: StructType, partition_by: tuple[str, ...]
) -> None:
    """Replace only the partitions that ``df`` has rows for."""
    writer = as_schema(df, schema).write.mode("overwrite").partitionBy(*partition_by)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def publish_view(df: DataFrame, name: str) -> None:
    """Offer a result to SQL users of the application as ``global_temp.<name>``."""
    df.createOrReplaceGlobalTempView(name)
