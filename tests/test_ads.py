"""Ad log, statistics and upserts in batch form."""

import pytest
from pyspark.sql import functions as F

from clickloom.operators import ad_stats, upserts
from clickloom.sources import ad_log


def _lines(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_parse_and_reject_split_the_log(spark):
    good = ["0 P1 C1 7 3", "86399999 P1 C2 8 4 extra"]
    bad = ["0 P1 C1 7", "0 P1 C1 seven 3", "x P1 C1 7 3", "", "0 P1 C1 7 x", "0  P1 C1 7 3"]
    df = _lines(spark, good + bad + [None])
    got = [tuple(r)[1:] for r in ad_log.parse_ad_log(df).orderBy("ts").collect()]
    assert got == [("1970-01-01", "P1", "C1", 7, 3), ("1970-01-01", "P1", "C2", 8, 4)]
    rejected = [r["value"] for r in ad_log.rejected_ad_log(df).collect()]
    assert sorted(x for x in rejected if x is not None) == sorted(bad) and None in rejected


def test_kafka_options():
    got = ad_log.kafka_options("h1:9092,h2:9092", "AdRealTimeLog, other", maxOffsetsPerTrigger="10")
    assert got == {
        "kafka.bootstrap.servers": "h1:9092,h2:9092",
        "subscribe": "AdRealTimeLog,other",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "10",
    }


def _clicks(spark, rows):
    schema = "ts timestamp, date string, province string, city string, user_id long, ad_id long"
    df = spark.createDataFrame(rows, "t string, province string, city string, user_id long, ad_id long")
    return df.select(F.col("t").cast("timestamp").alias("ts"), F.substring("t", 1, 10).alias("date"),
                     "province", "city", "user_id", "ad_id").to(
        spark.createDataFrame([], schema).schema)


def test_blacklist(spark):
    day = "2024-01-01 00:00:0{}".format
    clicks = _clicks(spark, [(day(i), "P", "C", 1, 1) for i in range(3)]
                     + [(day(i), "P", "C", 2, i) for i in range(5)])
    assert [r[0] for r in ad_stats.daily_blacklist(clicks, 3).collect()] == [1]
    assert ad_stats.daily_blacklist(clicks).count() == 0
    none = spark.createDataFrame([], "user_id long")
    assert ad_stats.without_blacklisted(clicks, none).count() == 8
    one = spark.createDataFrame([(1,)], "user_id long")
    assert ad_stats.without_blacklisted(clicks, one).count() == 5


def test_lookup_gives_zero_for_unknown_keys(spark):
    keys = spark.createDataFrame([("d", 1, 1), ("d", 1, 2)], "date string, user_id long, ad_id long")
    counts = spark.createDataFrame([("d", 1, 1, 5)], "date string, user_id long, ad_id long, click_count long")
    got = ad_stats.click_count_lookup(keys, counts).collect()
    assert sorted(tuple(r) for r in got) == [("d", 1, 1, 5), ("d", 1, 2, 0)]


def test_top_ads_break_ties_by_id(spark):
    rows = [("d", "P", ad, n) for ad, n in ((1, 5), (2, 9), (3, 5), (4, 5))]
    df = spark.createDataFrame(rows, "date string, province string, ad_id long, click_count long")
    assert [r["ad_id"] for r in ad_stats.province_top_ads(df).orderBy("ad_id").collect()] == [1, 2, 3]


@pytest.mark.parametrize(("length", "slide"), [(60, 20), (60, 60), (50, 20)])
def test_sliding_trend_against_counting_by_hand(spark, length, slide):
    seconds = [0, 1, 19, 20, 59, 60, 61, 125]
    rows = [(f"1970-01-01 01:{s // 60:02d}:{s % 60:02d}", "P", "C", 1, 1) for s in seconds]
    got = ad_stats.sliding_ad_trend(_clicks(spark, rows), length, slide).collect()
    base, expected = 3600, {}
    for s in seconds:
        t = base + s
        start = t - t % slide
        while start > t - length:
            expected[start] = expected.get(start, 0) + 1
            start -= slide
    text = lambda t: f"1970-01-01 {t // 3600:02d}:{t % 3600 // 60:02d}:{t % 60:02d}"
    assert sorted(tuple(r) for r in got) == sorted(
        (text(s), text(s + length), 1, n) for s, n in expected.items())


def test_upserts(spark):
    schema = "k long, g string, click_count long"
    target = spark.createDataFrame([(1, "a", 10), (2, "a", 20), (3, "b", 30)], schema)
    change = spark.createDataFrame([(2, "a", 5), (4, "c", 7)], schema)

    def rows(df):
        return sorted(tuple(r) for r in df.select("k", "g", "click_count").collect())

    assert rows(upserts.upsert_add(target, change, ["k", "g"])) == [
        (1, "a", 10), (2, "a", 25), (3, "b", 30), (4, "c", 7)]
    assert rows(upserts.upsert_replace(target, change, ["k"])) == [
        (1, "a", 10), (2, "a", 5), (3, "b", 30), (4, "c", 7)]
    assert rows(upserts.replace_group(target, change, ["g"])) == [
        (2, "a", 5), (3, "b", 30), (4, "c", 7)]
    assert sorted(r[0] for r in upserts.append_new(target, change.union(change), ["k"]).collect()) == [4]
    once = upserts.upsert_replace(target, change, ["k"])
    assert rows(upserts.upsert_replace(once, change, ["k"])) == rows(once)


def test_null_keys_are_keys(spark):
    schema = "k long, g string, click_count long"
    target = spark.createDataFrame([(None, None, 1), (1, "a", 2)], schema)
    change = spark.createDataFrame([(None, None, 9)], schema)
    want = [(1, "a", 2), (None, None, 9)]
    for got in (upserts.upsert_replace(target, change, ["k"]), upserts.replace_group(target, change, ["g"])):
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert upserts.append_new(target, change, ["k"]).count() == 0
    added = upserts.upsert_add(target.drop("g"), change.drop("g"), ["k"])
    assert sorted(map(tuple, added.collect()), key=str) == [(1, 2), (None, 10)]
    keys = spark.createDataFrame([(None, 1, None)], "date string, user_id long, ad_id long")
    counts = spark.createDataFrame([(None, 1, None, 7)], "date string, user_id long, ad_id long, click_count long")
    assert [r["click_count"] for r in ad_stats.click_count_lookup(keys, counts).collect()] == [7]
