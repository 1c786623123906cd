"""Sessions, sampling and categories on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from clickloom.operators import categories, sampling, sessions
from clickloom.schemas import USER_INFO
from clickloom.sources.tasks import TaskParams


def _rows(actions):
    return actions([
        dict(date="2024-01-01", user_id=1, session_id="s1", page_id=1, action_time="2024-01-01 9:00:00",
             search_keyword="tea"),
        dict(date="2024-01-01", user_id=1, session_id="s1", page_id=2, action_time="2024-01-01 10:00:01",
             click_category_id=10, click_product_id=5),
        dict(date="2024-01-01", user_id=1, session_id="s1", page_id=2, action_time="2024-01-01 09:30:00",
             click_category_id=9, order_category_ids="10,11", search_keyword="tea"),
        dict(date="2024-01-02", user_id=2, session_id="s2", page_id=1, action_time="2024-01-02 08:00:00",
             pay_category_ids="11,x", search_keyword=""),
        dict(date="2024-01-02", user_id=3, session_id="s3", page_id=1, action_time="bad"),
    ])


def test_actions_by_date_takes_both_ends(actions):
    df = _rows(actions)
    assert sessions.actions_by_date(df, "2024-01-01", "2024-01-01").count() == 3
    assert sessions.actions_by_date(df, "2024-01-01", "2024-01-02").count() == 5
    assert sessions.actions_by_date(df, None, None).count() == 5


def test_session_aggregate(actions):
    got = {r["session_id"]: r for r in sessions.aggregate_sessions(_rows(actions)).collect()}
    assert tuple(got["s1"]) == ("s1", 1, "tea", "9,10", "2024-01-01 09:00:00", 3601, 3)
    assert tuple(got["s2"]) == ("s2", 2, "", "", "2024-01-02 08:00:00", 0, 1)
    assert tuple(got["s3"]) == ("s3", 3, "", "", None, None, 1)


def _users(spark):
    rows = [(1, "u1", "n1", 30, "cook", "Rome", "male"), (2, "u2", "n2", 40, "pilot", "Oslo", "female")]
    return spark.createDataFrame(rows, USER_INFO)


def test_user_join_filter_and_statistics(spark, actions):
    full = sessions.with_user_info(sessions.aggregate_sessions(_rows(actions)), _users(spark))
    assert sorted(r["session_id"] for r in full.collect()) == ["s1", "s2"]

    def ids(**params):
        kept = sessions.filter_sessions(full, TaskParams(1, **params))
        return sorted(r["session_id"] for r in kept.collect())

    assert ids() == ["s1", "s2"]
    assert ids(start_age=31) == ["s1", "s2"]
    assert ids(start_age=31, end_age=50) == ["s2"]
    assert ids(sex="male", keywords="coffee,tea") == ["s1"]
    assert ids(category_ids="9") == ["s1"]
    assert ids(category_ids="1") == []
    assert ids(cities="Oslo,Rome", professionals="pilot") == ["s2"]

    stats = {r["stat"]: r["value"] for r in sessions.session_statistics(full).collect()}
    assert len(stats) == 16
    assert {k for k, v in stats.items() if v} == {"session_count", "visit_30m", "step_1_3"}
    assert stats["session_count"] == 2 and stats["step_1_3"] == 2
    assert [tuple(r) for r in sessions.visit_length_histogram(full).collect()] == [("30m", 1)]
    assert [tuple(r) for r in sessions.step_length_histogram(full).collect()] == [("1_3", 2)]


def test_statistics_of_no_sessions_are_all_zero(spark, actions):
    full = sessions.with_user_info(sessions.aggregate_sessions(_rows(actions)), _users(spark))
    stats = sessions.session_statistics(full.where("false")).collect()
    assert len(stats) == 16 and {r["value"] for r in stats} == {0}


def test_details_are_the_rows_of_the_sessions(actions):
    df = _rows(actions)
    some = sessions.aggregate_sessions(df).where(F.col("session_id") != "s2")
    got = sessions.session_details(some, df).collect()
    assert sorted(r["session_id"] for r in got) == ["s1", "s1", "s1", "s3"]


def _many_sessions(spark, per_hour):
    rows = [
        (f"{day}-{hour}-{i}", f"2024-01-{day:02d} {hour:02d}:00:00", "", "")
        for (day, hour), n in per_hour.items()
        for i in range(n)
    ]
    schema = "session_id string, start_time string, search_keywords string, click_category_ids string"
    return spark.createDataFrame(rows, schema)


def test_sample_meets_quota_without_repeats_and_repeats_by_seed(spark):
    per_hour = {(1, 0): 30, (1, 1): 10, (2, 5): 3, (2, 6): 7}
    df = _many_sessions(spark, per_hour)
    sample = sampling.random_extract(df, 4, total=20)
    ids = [r["session_id"] for r in sample.collect()]
    assert len(ids) == len(set(ids))
    hours = {}
    for s in ids:
        key = tuple(int(x) for x in s.split("-")[:2])
        hours[key] = hours.get(key, 0) + 1
    # 10 a day: 30/40 and 10/40 of it, 3/10 and 7/10 of it, cut to whole numbers.
    assert hours == {(1, 0): 7, (1, 1): 2, (2, 5): 3, (2, 6): 7}
    again = sampling.random_extract(df.repartition(3), 4, total=20)
    assert sorted(r["session_id"] for r in again.collect()) == sorted(ids)
    other = sampling.random_extract(df, 4, total=20, seed="x")
    assert sorted(r["session_id"] for r in other.collect()) != sorted(ids)


def test_sample_of_little_or_nothing(spark):
    df = _many_sessions(spark, {(1, 0): 2, (1, 1): 1})
    assert sampling.random_extract(df, 1, total=100).count() == 3
    assert sampling.random_extract(df.where("false"), 1).count() == 0
    assert sampling.random_extract(_many_sessions(spark, {(1, 0): 5, (2, 0): 5, (3, 0): 5}), 1, total=2).count() == 0


def test_category_counts(actions):
    df = _rows(actions)
    expected = {9: (1, 0, 0), 10: (1, 1, 0), 11: (0, 1, 1)}
    assert {r[0]: tuple(r)[1:] for r in categories.category_counts(df).collect()} == expected
    joined = categories.join_category_counts(
        categories.visited_categories(df), categories.click_counts(df),
        categories.order_counts(df), categories.pay_counts(df))
    assert {r[0]: tuple(r)[1:] for r in joined.collect()} == expected
    top = categories.top_categories(categories.category_counts(df), 2).collect()
    assert [r["category_id"] for r in top] == [10, 9]


@pytest.mark.parametrize("n", [1, 3, 50])
def test_salted_counts_equal_plain_counts(spark, n):
    clicks = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40).alias("click_category_id"),
        F.col("id").cast("string").alias("session_id"),
    )
    plain = categories.click_counts(clicks)
    salted = categories.click_counts_salted(clicks, n, ["session_id"])
    assert sorted(plain.collect()) == sorted(salted.collect())
