"""The real-time ad job: the five streams, each with its own checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from clickloom.operators.ad_stats import BLACKLIST_THRESHOLD
from clickloom.streaming.ad_streams import (
    AdTables,
    start_ad_click_trend,
    start_ad_stat,
    start_dynamic_blacklist,
    start_province_top,
    start_sliding_trend,
)


def start_ad_job(
    lines: DataFrame,
    tables: AdTables,
    threshold: int = BLACKLIST_THRESHOLD,
    late_after: str | None = None,
    trigger: dict | None = None,
    slide_seconds: int = 10,
    state_partitions: int | None = None,
) -> list[StreamingQuery]:
    """Filter and list users on the log; count and rank what the filter lets pass.

    ``lines`` comes from ``kafka_lines`` or ``file_lines``. The counting streams follow
    the accepted clicks one micro-batch behind. Nothing is late unless ``late_after`` is
    given; late clicks then are in ``tables.late``.
    """
    filtering = start_dynamic_blacklist(
        lines, tables, threshold, trigger, late_after=late_after, state_partitions=state_partitions
    )
    accepted = tables.accepted.stream()
    more = {"late_after": late_after, "trigger": trigger, "state_partitions": state_partitions}
    return [
        filtering,
        start_ad_stat(accepted, tables, **more),
        start_province_top(accepted, tables, **more),
        start_ad_click_trend(accepted, tables, **more),
        start_sliding_trend(accepted, tables, slide_seconds, **more),
    ]
