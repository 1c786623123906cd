"""Visit-session analysis of one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickloom import schemas
from clickloom.operators.categories import category_counts, top_categories
from clickloom.operators.sampling import random_extract
from clickloom.operators.sessions import (
    actions_by_date,
    aggregate_sessions,
    filter_sessions,
    sampled_session_details,
    session_details,
    session_statistics,
    with_user_info,
)
from clickloom.sources.tables import replace_task_rows
from clickloom.sources.tasks import read_task
from clickloom.sources.workspace import drop_folder, work_folder

SESSION_STAT = schemas.columns("task_id bigint, stat string, value bigint")
TOP_CATEGORY = schemas.columns(
    "task_id bigint, category_id bigint, click_count bigint, "
    "order_count bigint, pay_count bigint"
)


def run_session_job(
    spark: SparkSession,
    tasks: DataFrame,
    actions: DataFrame,
    users: DataFrame,
    task_id: int,
    output: str,
    sample_size: int = 100,
) -> None:
    """Write statistics, sampled sessions with their actions, and top categories.

    The filtered sessions feed four results, so they are stored once in the shared
    work folder and removed at the end: no result scans the actions again to rebuild them.
    Rows of the task are replaced, so a job that failed can be run again.
    """
    params = read_task(tasks, task_id)
    in_range = actions_by_date(actions, params.start_date, params.end_date)
    complete = with_user_info(aggregate_sessions(in_range), users)
    stored = work_folder(spark, f"sessions-{task_id}")
    filter_sessions(complete, params).write.parquet(stored)
    sessions = spark.read.parquet(stored)

    def put(df: DataFrame, name: str, schema: StructType) -> None:
        tagged = df if "task_id" in df.columns else df.withColumn("task_id", F.lit(task_id))
        replace_task_rows(tagged, f"{output}/{name}", schema, task_id)

    put(session_statistics(sessions), "session_stat", SESSION_STAT)

    sample = random_extract(sessions, task_id, sample_size)
    put(sample, "session_random_extract", schemas.SESSION_RANDOM_EXTRACT)
    put(sampled_session_details(sample, in_range, sample_size), "session_detail", schemas.SESSION_DETAIL)

    details = session_details(sessions, in_range)
    put(top_categories(category_counts(details)), "top10_category", TOP_CATEGORY)
    drop_folder(spark, stored)
