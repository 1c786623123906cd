"""Tables partitioned by day and bucketed by key, for updates and joins that leave them in place.

A bucketed table is read in the partitioning of its keys. A join on exactly those keys
moves only the other side, and a filter on days reads only the folders of those days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickloom.sources.workspace import stored, work_folder

DAY = "date"


def create_bucketed(
    spark: SparkSession, name: str, schema: StructType, keys: Sequence[str], buckets: int, path: str | None = None
) -> None:
    """Declare a table that :func:`land` fills; it stays as it is if there is one.

    ``schema`` has a column ``date``, by which it is partitioned. Take as many buckets as a
    day's rows need tasks: the rows of one key and day are read by one task.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    listed = ", ".join(f"`{k}`" for k in keys)
    place = "" if path is None else f" LOCATION '{path}'"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({DAY}) "
        f"CLUSTERED BY ({listed}) SORTED BY ({listed}) INTO {buckets} BUCKETS{place}"
    )


def new_table(spark: SparkSession, purpose: str) -> tuple[str, str]:
    """(name, path) of a table that is there for one job only."""
    path = work_folder(spark, purpose)
    return f"{purpose}_{path.rsplit('-', 1)[1]}", path


def _layout(spark: SparkSession, name: str) -> tuple[list[str], int]:
    """(bucket keys, number of buckets) of a table."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {name}").collect()}
    keys = rows["Bucket Columns"].strip("[]").replace("`", "").split(", ")
    return keys, int(rows["Num Buckets"])


def land(df: DataFrame, name: str, replace_days: bool = False) -> None:
    """Write rows to a bucketed table, one file for each day and bucket.

    With ``replace_days`` the days that ``df`` has rows of are replaced, otherwise rows are
    added. A null day is a day of its own.
    """
    spark = df.sparkSession
    keys, buckets = _layout(spark, name)
    rows = df.select(*spark.table(name).columns).repartition(buckets, *keys)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows.write.insertInto(name, overwrite=replace_days)
    finally:
        spark.conf.set(mode, before)


def of_days(spark: SparkSession, name: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """The rows of the days ``start`` to ``end``; folders of other days are not read."""
    rows = spark.table(name)
    if start is not None:
        rows = rows.where(F.col(DAY) >= start)
    if end is not None:
        rows = rows.where(F.col(DAY) <= end)
    return rows


def added_counts(spark: SparkSession, name: str, delta: DataFrame, measure: str = "click_count") -> DataFrame:
    """The days that ``delta`` has counts for, as they are with ``delta`` added.

    Only those days of the table are read, and only ``delta`` is shuffled: it meets the
    table on the bucket keys, the day being compared besides. The days of one change, at
    most a few, come to the driver. Null keys are an error here, unlike in
    :func:`clickloom.operators.upserts.upsert_add`: they have no bucket of their own.
    """
    keys, _ = _layout(spark, name)
    every = [DAY, *keys]
    days = [r[0] for r in delta.select(DAY).distinct().collect()]
    named = [
        F.when(F.col(c).isNull(), F.raise_error(F.lit(f"a count without {c}"))).otherwise(F.col(c)).alias(f"_{c}")
        for c in every
    ]
    change = delta.groupBy(*named).agg(F.sum(measure).alias("_change"))
    table = spark.table(name).where(F.col(DAY).isin(days)).select(*every, measure)
    # As a range, the day is no key of the join, which then is on the bucket keys alone.
    same_day = (F.col(DAY) >= F.col(f"_{DAY}")) & (F.col(DAY) <= F.col(f"_{DAY}"))
    same = same_day
    for c in keys:
        same = same & (F.col(c) == F.col(f"_{c}"))
    both = table.join(change, same, "full")
    total = F.coalesce(measure, F.lit(0)) + F.coalesce("_change", F.lit(0))
    found = [F.coalesce(c, f"_{c}").alias(c) for c in every]
    return both.select(*found, total.cast("long").alias(measure))


def add_counts(spark: SparkSession, name: str, delta: DataFrame, measure: str = "click_count") -> None:
    """Add counts to a bucketed table, rewriting the days that ``delta`` has and no others.

    The new days are stored aside before they take the place of the old ones, so that they
    are on record should the job be cut off between the two.
    """
    days = stored(added_counts(spark, name, delta, measure), "added-counts")
    land(days, name, replace_days=True)
