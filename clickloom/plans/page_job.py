"""Page conversion rates of one task."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickloom import schemas
from clickloom.operators.page_flow import SLICE_ROWS, pack_rates, page_convert_rates
from clickloom.operators.sessions import actions_by_date
from clickloom.sources.tables import replace_task_rows
from clickloom.sources.tasks import read_task


def run_page_job(
    tasks: DataFrame, actions: DataFrame, task_id: int, output: str, slice_rows: int = SLICE_ROWS
) -> None:
    params = read_task(tasks, task_id)
    if params.target_page_flow is None:
        raise ValueError(f"task {task_id} names no page flow")
    in_range = actions_by_date(actions, params.start_date, params.end_date)
    rates = page_convert_rates(in_range, params.target_page_flow, slice_rows=slice_rows)
    replace_task_rows(
        pack_rates(rates, task_id),
        f"{output}/page_split_convert_rate",
        schemas.PAGE_SPLIT_CONVERT_RATE,
        task_id,
    )
