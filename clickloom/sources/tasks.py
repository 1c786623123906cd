"""Task parameters: a JSON object per task whose values are arrays, first item used."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _first(field: str) -> Column:
    """First item of a field; a blank one is as good as none."""
    item = F.try_element_at(F.col("params")[field], F.lit(1))
    return F.when(F.trim(item) != "", item)


def parse_task_params(tasks: DataFrame) -> DataFrame:
    """One row per task with every known parameter as a typed column; absent ones are null."""
    params = F.from_json("task_param", "map<string, array<string>>")
    return tasks.select("task_id", params.alias("params")).select(
        "task_id",
        _first("startDate").alias("start_date"),
        _first("endDate").alias("end_date"),
        _first("startAge").try_cast("long").alias("start_age"),
        _first("endAge").try_cast("long").alias("end_age"),
        _first("professionals").alias("professionals"),
        _first("cities").alias("cities"),
        _first("sex").alias("sex"),
        _first("keywords").alias("keywords"),
        _first("categoryIds").alias("category_ids"),
        _first("targetPageFlow").alias("target_page_flow"),
    )


@dataclass(frozen=True)
class TaskParams:
    task_id: int
    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: str | None = None
    cities: str | None = None
    sex: str | None = None
    keywords: str | None = None
    category_ids: str | None = None
    target_page_flow: str | None = None


def read_task(tasks: DataFrame, task_id: int) -> TaskParams:
    """Parameters of one task; the id test reaches the scan of the task table."""
    found = parse_task_params(tasks.where(F.col("task_id") == task_id)).head(1)
    if not found:
        raise LookupError(f"no task with id {task_id}")
    row = found[0].asDict()
    return TaskParams(**{f.name: row[f.name] for f in fields(TaskParams)})
