"""Top products per area for one task."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions.labels import AREA_LEVELS
from clickloom.operators.area_products import area_top_products
from clickloom.sources.tables import replace_task_rows
from clickloom.sources.tasks import read_task


def run_area_job(
    tasks: DataFrame,
    actions: DataFrame,
    cities: DataFrame,
    products: DataFrame,
    task_id: int,
    output: str,
    levels: Mapping[str, str] = AREA_LEVELS,
) -> None:
    params = read_task(tasks, task_id)
    if params.start_date is None or params.end_date is None:
        raise ValueError(f"task {task_id} names no date range")
    top = area_top_products(
        actions, cities, products, params.start_date, params.end_date, levels=levels
    )
    tagged = top.withColumn("task_id", F.lit(task_id))
    replace_task_rows(
        tagged, f"{output}/area_top3_product", schemas.AREA_TOP3_PRODUCT, task_id
    )
