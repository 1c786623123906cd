"""Ad-click queries over the whole log, and the table updates."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions.times import format_time
from clickloom.operators import ad_stats as ops
from clickloom.operators import upserts
from clickloom.operators import user_bitmaps as bitmaps
from clickloom.registry import inputs as i
from clickloom.sources import bucketed, fixtures
from clickloom.sources.ad_log import parse_ad_log

_STAT_KEYS = ["date", "province", "city", "ad_id"]


def clicks(spark, sf):
    return parse_ad_log(fixtures.ad_log(spark, sf))


def shown(parsed):
    return parsed.select(
        format_time("ts").alias("click_time"), "date", "province", "city", "user_id", "ad_id"
    )


def early_blacklist(parsed):
    """The list as it stood after the first days."""
    early = parsed.where(F.col("date") <= i.LISTED_UNTIL)
    return ops.daily_blacklist(early, i.BLACKLIST_CLICKS)


def _blacklist_filter(spark, sf):
    parsed = clicks(spark, sf)
    return shown(ops.without_blacklisted(parsed, early_blacklist(parsed)))


def _day_bitmaps(parsed):
    """Users over the threshold as one set per day."""
    counts = ops.daily_user_ad_clicks(parsed)
    over = counts.where(F.col("click_count") >= i.BLACKLIST_CLICKS)
    return bitmaps.user_bitmaps(over, "date")


def _blacklist_filter_bitmap(spark, sf):
    parsed = clicks(spark, sf)
    days = _day_bitmaps(parsed).where(F.col("date") <= i.LISTED_UNTIL)
    return shown(bitmaps.without_members(parsed, days))


def _daily_blacklist_bitmap(spark, sf):
    return bitmaps.bitmap_users(bitmaps.merged_bitmaps(_day_bitmaps(clicks(spark, sf))))


def _daily_users(spark, sf):
    return bitmaps.bitmap_sizes(bitmaps.user_bitmaps(clicks(spark, sf), "date"), "date")


def _click_count_lookup(spark, sf):
    counts = ops.daily_user_ad_clicks(clicks(spark, sf))
    return ops.click_count_lookup(counts, counts.where(F.col("date") <= "2024-01-15"))


def _province_counts(spark, sf):
    return ops.province_ad_clicks(ops.ad_stat(clicks(spark, sf)))


def _timed_counts(spark, sf):
    """Counts of the forenoons, or of the afternoons."""
    parsed = clicks(spark, sf)
    is_forenoon = F.date_format("ts", "HH") < "12"
    return lambda forenoon: ops.daily_user_ad_clicks(
        parsed.where(is_forenoon if forenoon else ~is_forenoon)
    )


def _upsert_add(spark, sf):
    counts = _timed_counts(spark, sf)
    return upserts.upsert_add(counts(True), counts(False), ops.USER_AD_KEYS)


def _upsert_add_bucketed(spark, sf):
    """The same counts, landed in a bucketed table and added to day by day."""
    name, path = bucketed.new_table(spark, "user_counts")
    keys = [c for c in ops.USER_AD_KEYS if c != bucketed.DAY]
    bucketed.create_bucketed(spark, name, schemas.AD_USER_CLICK_COUNT, keys, i.BUCKETS, path)
    counts = _timed_counts(spark, sf)
    bucketed.land(counts(True), name)
    bucketed.add_counts(spark, name, counts(False))
    return spark.table(name)


def _upsert_replace(spark, sf):
    stat = ops.ad_stat(clicks(spark, sf))
    target = stat.where(F.col("date") <= "2024-01-20")
    source = stat.where(F.col("date") >= "2024-01-10").withColumn(
        "click_count", F.col("click_count") * 2
    )
    return upserts.upsert_replace(target, source, _STAT_KEYS)


def _replace_group(spark, sf):
    counts = _province_counts(spark, sf)
    target = ops.province_top_ads(counts.where(F.col("date") <= "2024-01-20"), k=3)
    source = ops.province_top_ads(counts.where(F.col("date") >= "2024-01-10"), k=1)
    return upserts.replace_group(target, source, ["date", "province"])


def _blacklist_append(spark, sf):
    parsed = clicks(spark, sf)
    existing = early_blacklist(parsed)
    listed = ops.daily_blacklist(parsed, i.BLACKLIST_CLICKS)
    return existing.unionByName(upserts.append_new(existing, listed, ["user_id"]))


QUERIES = {
    "ad_log_parsed": lambda s, d: shown(clicks(s, d)),
    "blacklist_filter": _blacklist_filter,
    "daily_user_ad_clicks": lambda s, d: ops.daily_user_ad_clicks(clicks(s, d)),
    "click_count_lookup": _click_count_lookup,
    "daily_blacklist": lambda s, d: ops.daily_blacklist(clicks(s, d), i.BLACKLIST_CLICKS),
    "ad_stat": lambda s, d: ops.ad_stat(clicks(s, d)),
    "province_ad_clicks": _province_counts,
    "province_top3_ad": lambda s, d: ops.province_top_ads(_province_counts(s, d)),
    "ad_click_trend": lambda s, d: ops.ad_click_trend(clicks(s, d)),
    "sliding_ad_trend": lambda s, d: ops.sliding_ad_trend(clicks(s, d), 3600, 600),
    "upsert_add": _upsert_add,
    "upsert_add_bucketed": _upsert_add_bucketed,
    "upsert_replace": _upsert_replace,
    "replace_group": _replace_group,
    "blacklist_append": _blacklist_append,
    "blacklist_filter_bitmap": _blacklist_filter_bitmap,
    "daily_blacklist_bitmap": _daily_blacklist_bitmap,
    "daily_users": _daily_users,
}

_SHOWN = """SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS click_time, date, province, city,
  user_id, ad_id FROM ad_click"""
_COUNTS = """user_counts AS (
  SELECT date, user_id, ad_id, count(*) AS click_count FROM ad_click
  GROUP BY date, user_id, ad_id)"""
_STAT = """ad_stat AS (
  SELECT date, province, city, ad_id, count(*) AS click_count FROM ad_click
  GROUP BY date, province, city, ad_id)"""
_PROVINCE = """province_counts AS (
  SELECT date, province, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count FROM ad_stat
  GROUP BY date, province, ad_id)"""
_TOP = """ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY date, province ORDER BY click_count DESC, ad_id) AS rank
  FROM province_counts)"""
_LISTED = f"SELECT DISTINCT user_id FROM user_counts WHERE click_count >= {i.BLACKLIST_CLICKS}"
_EARLY = f"{_LISTED} AND date <= '{i.LISTED_UNTIL}'"

BLACKLIST_FILTER = i.with_tables(
    i.AD_CLICK, _COUNTS, query=f"{_SHOWN} WHERE user_id NOT IN ({_EARLY})"
)
DAILY_BLACKLIST = i.with_tables(i.AD_CLICK, _COUNTS, query=_LISTED)
AD_STAT = i.with_tables(i.AD_CLICK, _STAT, query="SELECT * FROM ad_stat")
PROVINCE_TOP3 = i.with_tables(
    i.AD_CLICK,
    _STAT,
    _PROVINCE,
    _TOP,
    query="SELECT date, province, ad_id, click_count FROM ranked WHERE rank <= 3",
)
AD_CLICK_TREND = i.with_tables(
    i.AD_CLICK,
    query="""SELECT date, strftime(ts, '%H') AS hour, strftime(ts, '%M') AS minute, ad_id,
      count(*) AS click_count FROM ad_click GROUP BY ALL""",
)

ORACLES = {
    "ad_log_parsed": i.with_tables(i.AD_CLICK, query=_SHOWN),
    "blacklist_filter": BLACKLIST_FILTER,
    "daily_user_ad_clicks": i.with_tables(i.AD_CLICK, _COUNTS, query="SELECT * FROM user_counts"),
    "click_count_lookup": i.with_tables(
        i.AD_CLICK,
        _COUNTS,
        query="""SELECT date, user_id, ad_id, CASE WHEN date <= '2024-01-15'
          THEN click_count ELSE CAST(0 AS BIGINT) END AS click_count FROM user_counts""",
    ),
    "daily_blacklist": DAILY_BLACKLIST,
    "ad_stat": AD_STAT,
    "province_ad_clicks": i.with_tables(
        i.AD_CLICK, _STAT, _PROVINCE, query="SELECT * FROM province_counts"
    ),
    "province_top3_ad": PROVINCE_TOP3,
    "ad_click_trend": AD_CLICK_TREND,
    "sliding_ad_trend": i.with_tables(
        i.AD_CLICK,
        query="""SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start,
          strftime(w + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end, ad_id,
          count(*) AS click_count
        FROM (SELECT ad_id, time_bucket(INTERVAL 10 MINUTE, ts)
            - unnest([0, 1, 2, 3, 4, 5]) * INTERVAL 10 MINUTE AS w FROM ad_click)
        GROUP BY w, ad_id""",
    ),
    "upsert_add": i.with_tables(i.AD_CLICK, _COUNTS, query="SELECT * FROM user_counts"),
    "upsert_add_bucketed": i.with_tables(i.AD_CLICK, _COUNTS, query="SELECT * FROM user_counts"),
    "upsert_replace": i.with_tables(
        i.AD_CLICK,
        _STAT,
        query="""SELECT date, province, city, ad_id, CASE WHEN date >= '2024-01-10'
          THEN click_count * 2 ELSE click_count END AS click_count FROM ad_stat""",
    ),
    "replace_group": i.with_tables(
        i.AD_CLICK,
        _STAT,
        _PROVINCE,
        _TOP,
        query="""SELECT date, province, ad_id, click_count FROM ranked
        WHERE rank <= CASE WHEN date >= '2024-01-10' THEN 1 ELSE 3 END""",
    ),
    "blacklist_append": DAILY_BLACKLIST,
    "blacklist_filter_bitmap": BLACKLIST_FILTER,
    "daily_blacklist_bitmap": DAILY_BLACKLIST,
    "daily_users": i.with_tables(
        i.AD_CLICK,
        query="SELECT date, count(DISTINCT user_id) AS users FROM ad_click GROUP BY date",
    ),
}
