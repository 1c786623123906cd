"""Visit sessions: aggregate, complete with the user, filter, measure, expand again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.aggregates import group_concat_distinct
from clickloom.functions.labels import (
    STEP_LENGTH_BUCKETS,
    VISIT_LENGTH_BUCKETS,
    in_bucket,
    step_length_bucket,
    visit_length_bucket,
)
from clickloom.functions.predicates import any_of, equals, in_range
from clickloom.functions.times import format_time, parse_time
from clickloom.operators.skew import key_copy
from clickloom.sources.tables import broadcast_if_small
from clickloom.sources.tasks import TaskParams

# So many session ids, at some 100 bytes each, may be held by every executor.
BROADCAST_SESSIONS = 100_000

DETAIL_COLUMNS = (
    "user_id",
    "session_id",
    "page_id",
    "action_time",
    "search_keyword",
    "click_category_id",
    "click_product_id",
    "order_category_ids",
    "order_product_ids",
    "pay_category_ids",
    "pay_product_ids",
)


def actions_by_date(actions: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Actions of the days ``start`` to ``end``, both included."""
    if start is not None:
        actions = actions.where(F.col("date") >= start)
    if end is not None:
        actions = actions.where(F.col("date") <= end)
    return actions


def aggregate_sessions(actions: DataFrame) -> DataFrame:
    """One row per session; one shuffle, with sets and extremes combined before it."""
    timed = actions.select(
        "session_id",
        "user_id",
        F.nullif("search_keyword", F.lit("")).alias("keyword"),
        "click_category_id",
        parse_time("action_time").alias("ts"),
    )
    return (
        timed.groupBy("session_id")
        .agg(
            F.min("user_id").alias("user_id"),
            group_concat_distinct("keyword").alias("search_keywords"),
            group_concat_distinct("click_category_id").alias("click_category_ids"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
            F.count(F.lit(1)).alias("step_length"),
        )
        .select(
            "session_id",
            "user_id",
            "search_keywords",
            "click_category_ids",
            format_time("first_ts").alias("start_time"),
            (F.unix_timestamp("last_ts") - F.unix_timestamp("first_ts")).alias("visit_length"),
            "step_length",
        )
    )


def with_user_info(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Sessions with age, profession, city and sex; sessions of unknown users drop out."""
    profile = users.select("user_id", "age", "professional", "city", "sex")
    return sessions.join(broadcast_if_small(profile), "user_id").select(
        *sessions.columns, "age", "professional", "city", "sex"
    )


def filter_sessions(sessions: DataFrame, params: TaskParams) -> DataFrame:
    """Sessions that meet every parameter given."""
    return sessions.where(
        in_range("age", params.start_age, params.end_age)
        & any_of("professional", params.professionals)
        & any_of("city", params.cities)
        & equals("sex", params.sex)
        & any_of("search_keywords", params.keywords)
        & any_of("click_category_ids", params.category_ids)
    )


def session_statistics(sessions: DataFrame) -> DataFrame:
    """Number of sessions in all and per length bucket, as rows ``(stat, value)``."""
    names = ["session_count"]
    counts = [F.count(F.lit(1))]
    for source, prefix, buckets in (
        ("visit_length", "visit_", VISIT_LENGTH_BUCKETS),
        ("step_length", "step_", STEP_LENGTH_BUCKETS),
    ):
        for name, low, high in buckets:
            names.append(prefix + name)
            counts.append(F.count_if(in_bucket(F.col(source), low, high)))
    one_row = sessions.agg(*[c.alias(n) for n, c in zip(names, counts)])
    return one_row.unpivot([], names, "stat", "value")


def visit_length_histogram(sessions: DataFrame) -> DataFrame:
    return _histogram(sessions, visit_length_bucket("visit_length"))


def step_length_histogram(sessions: DataFrame) -> DataFrame:
    return _histogram(sessions, step_length_bucket("step_length"))


def _histogram(sessions: DataFrame, bucket) -> DataFrame:
    labelled = sessions.select(bucket.alias("bucket")).where(F.col("bucket").isNotNull())
    return labelled.groupBy("bucket").agg(F.count(F.lit(1)).alias("session_count"))


def session_details(sessions: DataFrame, actions: DataFrame) -> DataFrame:
    """The action rows of the given sessions, of which one may own a large share."""
    ids = sessions.select(key_copy("session_id").alias("_session"))
    joined = actions.join(ids, actions["session_id"] == ids["_session"])
    return joined.select(*DETAIL_COLUMNS)


def landed_session_details(sessions: DataFrame, actions: DataFrame) -> DataFrame:
    """The action rows of sessions, both from one table bucketed by session.

    Neither side is moved, and a session's rows are read by one task: for logs whose
    sessions are of ordinary size. :func:`session_details` splits the others.
    """
    ids = sessions.select(F.col("session_id").alias("_session"))
    joined = actions.join(ids.hint("merge"), actions["session_id"] == ids["_session"])
    return joined.select(*DETAIL_COLUMNS)


def sampled_session_details(sample: DataFrame, actions: DataFrame, total: int) -> DataFrame:
    """The action rows of a sample of at most ``total`` sessions.

    The ids are then of known size: up to ``BROADCAST_SESSIONS`` of them are broadcast, and
    the actions are filtered where they are read.
    """
    if total > BROADCAST_SESSIONS:
        return session_details(sample, actions)
    ids = F.broadcast(sample.select(F.col("session_id").alias("_session")))
    joined = actions.join(ids, actions["session_id"] == ids["_session"])
    return joined.select(*DETAIL_COLUMNS)
