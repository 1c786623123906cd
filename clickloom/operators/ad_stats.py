"""Ad-click statistics over parsed log lines, for whole tables and for micro-batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.times import format_date, format_time, minute_parts
from clickloom.operators.skew import key_copy
from clickloom.operators.upserts import key_copies, same_keys

BLACKLIST_THRESHOLD = 100
USER_AD_KEYS = ["date", "user_id", "ad_id"]


def without_blacklisted(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Clicks of users that are not listed.

    The list is broadcast while it is small; beyond that the join shuffles and a user
    with very many clicks is split at run time.
    """
    listed = blacklist.select(key_copy("user_id").alias("_listed"))
    return clicks.join(listed, clicks["user_id"] == listed["_listed"], "left_anti")


def daily_user_ad_clicks(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy(*USER_AD_KEYS).agg(F.count(F.lit(1)).alias("click_count"))


def click_count_lookup(keys: DataFrame, counts: DataFrame) -> DataFrame:
    """Count on record for each (date, user, ad) asked for; 0 where there is none."""
    asked = keys.select(*USER_AD_KEYS)
    recorded = key_copies(counts, USER_AD_KEYS, "click_count")
    found = asked.join(recorded, same_keys(asked, recorded, USER_AD_KEYS), "left")
    count = F.coalesce("click_count", F.lit(0).cast("long"))
    return found.select(*USER_AD_KEYS, count.alias("click_count"))


def users_over_threshold(counts: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """Users with at least ``threshold`` clicks on some ad on some day."""
    return counts.where(F.col("click_count") >= threshold).select("user_id").distinct()


def daily_blacklist(clicks: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    return users_over_threshold(daily_user_ad_clicks(clicks), threshold)


def ad_stat(clicks: DataFrame) -> DataFrame:
    keys = ["date", "province", "city", "ad_id"]
    return clicks.groupBy(*keys).agg(F.count(F.lit(1)).alias("click_count"))


def province_ad_clicks(stat: DataFrame) -> DataFrame:
    """City counts rolled up to the province."""
    return stat.groupBy("date", "province", "ad_id").agg(
        F.sum("click_count").alias("click_count")
    )


def province_top_ads(province_counts: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` most clicked ads of each province and day; equal counts go by lower id."""
    best = Window.partitionBy("date", "province").orderBy(F.desc("click_count"), F.asc("ad_id"))
    ranked = province_counts.withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= k).select("date", "province", "ad_id", "click_count")


def with_minute_columns(windowed: DataFrame) -> DataFrame:
    """A ``window`` column split into date, hour and minute text."""
    date, hour, minute = minute_parts("window.start")
    return windowed.select(
        date.alias("date"), hour.alias("hour"), minute.alias("minute"), "ad_id", "click_count"
    )


def ad_click_trend(clicks: DataFrame) -> DataFrame:
    """Clicks per minute and ad; the same text runs on a stream, where it keeps state."""
    per_minute = clicks.groupBy(F.window("ts", "1 minute"), "ad_id").agg(
        F.count(F.lit(1)).alias("click_count")
    )
    return with_minute_columns(per_minute)


def slide_counts(clicks: DataFrame, slide_seconds: int) -> DataFrame:
    """Clicks per ad and slide of time; on a stream one row of state for each of them."""
    slide = F.window("ts", f"{slide_seconds} seconds")
    counted = clicks.groupBy(slide, "ad_id").agg(F.count(F.lit(1)).alias("click_count"))
    start = F.col("window.start")
    return counted.select(
        format_date(start).alias("date"), start.alias("slide_start"), "ad_id", "click_count"
    )


def windows_of_slides(slides: DataFrame, length_seconds: int, slide_seconds: int) -> DataFrame:
    """Clicks per ad in windows of ``length`` seconds, one starting every ``slide``.

    Made from counts per slide (see :func:`slide_counts`), which are repeated for the
    windows they fall into; clicks never are. The length is a whole number of slides.
    """
    if length_seconds % slide_seconds:
        raise ValueError("a window must be a whole number of slides")
    last = F.unix_timestamp("slide_start")
    starts = F.sequence(
        last - (length_seconds - slide_seconds), last, F.lit(slide_seconds).cast("long")
    )
    spread = slides.select(F.explode(starts).alias("start"), "ad_id", "click_count")
    counted = spread.groupBy("start", "ad_id").agg(F.sum("click_count").alias("click_count"))
    end = F.timestamp_seconds(F.col("start") + length_seconds)
    return _shown_windows(counted, F.timestamp_seconds("start"), end)


def sliding_ad_trend(clicks: DataFrame, length_seconds: int, slide_seconds: int) -> DataFrame:
    """Clicks per ad in windows of ``length``, one starting every ``slide``.

    Where the length is a whole number of slides, clicks are counted per slide first
    and only those counts are repeated for the windows they fall into.
    """
    if length_seconds % slide_seconds == 0:
        slides = slide_counts(clicks, slide_seconds)
        return windows_of_slides(slides, length_seconds, slide_seconds)
    window = F.window("ts", f"{length_seconds} seconds", f"{slide_seconds} seconds")
    counted = clicks.groupBy(window, "ad_id").agg(F.count(F.lit(1)).alias("click_count"))
    return _shown_windows(counted, F.col("window.start"), F.col("window.end"))


def _shown_windows(counted: DataFrame, start: Column, end: Column) -> DataFrame:
    return counted.select(
        format_time(start).alias("window_start"),
        format_time(end).alias("window_end"),
        "ad_id",
        "click_count",
    )
