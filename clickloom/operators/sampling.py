"""Quota sample of sessions over days and hours."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


# 65,536 buckets per hour: few rows to count, and few sessions in the one that is ranked.
BUCKET_DIGITS = 4


def _with_hour(sessions: DataFrame) -> DataFrame:
    # start_time is written by the session aggregate, hence in the padded format.
    return sessions.withColumn("date", F.substring("start_time", 1, 10)).withColumn(
        "hour", F.substring("start_time", 12, 2)
    )


def sessions_per_hour(sessions: DataFrame) -> DataFrame:
    timed = _with_hour(sessions).where(F.col("start_time").isNotNull())
    return timed.groupBy("date", "hour").agg(F.count(F.lit(1)).alias("session_count"))


def _with_quotas(hours: DataFrame, total: int) -> DataFrame:
    """One row per hour of the calendar, with its quota."""
    days = hours.agg(F.count_distinct("date")).scalar()
    day = Window.partitionBy("date")
    share = F.col("session_count") / F.sum("session_count").over(day).cast("double")
    daily = F.floor(F.lit(int(total)) / days)
    quota = F.least((share * daily).cast("long"), F.col("session_count"))
    return hours.select("date", "hour", quota.alias("quota"))


def hourly_quotas(sessions: DataFrame, total: int) -> DataFrame:
    """How many sessions to draw per hour: an equal share of ``total`` for each day,
    spread over its hours by their share of the day's sessions, both cut to whole numbers.
    """
    return _with_quotas(sessions_per_hour(sessions), total)


def random_extract(
    sessions: DataFrame, task_id: int, total: int = 100, seed: str = ""
) -> DataFrame:
    """Draw sessions without repeats, by hash order: the same seed gives the same sample.

    The hash order of an hour is cut into buckets by its leading digits. Sessions are
    counted per bucket, which combines before the shuffle. Buckets that begin below the
    quota are ranked each on its own, and all but the last of them stay whole. So no hour is
    ever sorted as one group, whatever the total.
    """
    order = F.md5(F.concat(F.lit(seed), F.col("session_id")))
    timed = (
        _with_hour(sessions)
        .where(F.col("start_time").isNotNull())
        .withColumn("place", order)
        .withColumn("bucket", F.coalesce(F.substring("place", 1, BUCKET_DIGITS), F.lit("")))
    )
    hour, keys = ["date", "hour"], ["date", "hour", "bucket"]
    counts = timed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    hours = counts.groupBy(*hour).agg(F.sum("n").alias("session_count"))
    below = Window.partitionBy(*hour).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(below), F.lit(0).cast("long"))
    buckets = counts.select(*keys, "n", before.alias("before")).join(_with_quotas(hours, total), hour)
    room = F.col("quota") - F.col("before")
    reached = buckets.where(room > 0).select(*keys, room.alias("room"))
    in_bucket = Window.partitionBy(*keys).orderBy("place", "session_id")
    ranked = timed.join(reached, keys).withColumn("rank", F.row_number().over(in_bucket))
    return ranked.where(F.col("rank") <= F.col("room")).select(
        F.lit(task_id).cast("long").alias("task_id"),
        "session_id",
        "start_time",
        "search_keywords",
        "click_category_ids",
    )
