"""Streaming queries: the whole log as time-ordered files, run until all are read.

Each returns the table the stream leaves behind; its SQL is that of the batch form.
"""

from __future__ import annotations

from clickloom.registry import ads
from clickloom.registry import inputs as i
from clickloom.sources import fixtures
from clickloom.sources.ad_log import file_lines, parse_ad_log
from clickloom.sources.workspace import work_folder
from clickloom.streaming import ad_streams

FILES = 4
ALL_NOW = {"availableNow": True}


def _staged_log(spark, sf):
    """The log as files that each cover a span of time, read as a stream one by one."""
    path = work_folder(spark, "ad-log")
    log = fixtures.timed_ad_log(spark, sf).repartitionByRange(FILES, "ts")
    log.sortWithinPartitions("ts").select("value").write.text(path)
    return file_lines(spark, path, files_per_batch=1)


def _tables(spark):
    return ad_streams.AdTables(spark, work_folder(spark, "ad-tables"))


def _state_partitions(spark):
    """No more than the cores can use, nor more than the session's shuffles have."""
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(shuffles, 4 * spark.sparkContext.defaultParallelism)


def _blacklist_filter(spark, sf):
    tables, lines = _tables(spark), _staged_log(spark, sf)
    path = work_folder(spark, "blacklist")
    ads.early_blacklist(ads.clicks(spark, sf)).write.parquet(path)
    query = ad_streams.start_blacklist_filter(
        lines, lambda: spark.read.parquet(path), tables, ALL_NOW
    )
    query.awaitTermination()
    return ads.shown(tables.passed())


def _dynamic_blacklist(spark, sf):
    tables, lines = _tables(spark), _staged_log(spark, sf)
    query = ad_streams.start_dynamic_blacklist(
        lines, tables, i.BLACKLIST_CLICKS, ALL_NOW, state_partitions=_state_partitions(spark)
    )
    query.awaitTermination()
    return tables.blacklist.table()


def _counted(spark, sf, start, **more):
    """The tables after a counting stream has read the whole log."""
    tables, lines = _tables(spark), _staged_log(spark, sf)
    partitions = _state_partitions(spark)
    query = start(parse_ad_log(lines), tables, trigger=ALL_NOW, state_partitions=partitions, **more)
    query.awaitTermination()
    return tables


def _sliding_trend(spark, sf):
    tables = _counted(spark, sf, ad_streams.start_sliding_trend, slide_seconds=600)
    return tables.sliding_trend(3600, 600)


QUERIES = {
    "stream_blacklist_filter": _blacklist_filter,
    "stream_dynamic_blacklist": _dynamic_blacklist,
    "stream_ad_stat": lambda s, d: _counted(s, d, ad_streams.start_ad_stat).stat.table(),
    "stream_province_top3": lambda s, d: _counted(s, d, ad_streams.start_province_top).province_top3(),
    "stream_ad_click_trend": lambda s, d: _counted(s, d, ad_streams.start_ad_click_trend).trend.table(),
    "stream_sliding_ad_trend": _sliding_trend,
}

ORACLES = {
    "stream_blacklist_filter": ads.BLACKLIST_FILTER,
    "stream_dynamic_blacklist": ads.DAILY_BLACKLIST,
    "stream_ad_stat": ads.AD_STAT,
    "stream_province_top3": ads.PROVINCE_TOP3,
    "stream_ad_click_trend": ads.AD_CLICK_TREND,
    "stream_sliding_ad_trend": ads.ORACLES["sliding_ad_trend"],
}
