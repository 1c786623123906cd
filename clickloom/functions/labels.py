"""Bucket and label columns."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket name, first and last whole second (open at the end if None).
VISIT_LENGTH_BUCKETS = (
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
)
# Bucket name, first and last number of steps.
STEP_LENGTH_BUCKETS = (
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
)
# Area names that carry a level; any other area is at D.
AREA_LEVELS = {
    "China North": "A Level",
    "China East": "A Level",
    "China South": "B Level",
    "China Middle": "B Level",
    "West North": "C Level",
    "West South": "C Level",
}
OTHER_AREA_LEVEL = "D Level"
# Product status texts (sold by the shop itself / by a third party).
SELF_OPERATED = "自营商品"
THIRD_PARTY = "第三方商品"


def in_bucket(c: Column, low: int, high: int | None) -> Column:
    return c >= low if high is None else c.between(low, high)


def bucket(c: Column | str, buckets) -> Column:
    """Name of the bucket that holds a whole number; null outside every bucket."""
    c = F.col(c) if isinstance(c, str) else c
    first, *rest = buckets
    start = F.when(in_bucket(c, *first[1:]), first[0])
    return reduce(lambda acc, b: acc.when(in_bucket(c, *b[1:]), b[0]), rest, start)


def visit_length_bucket(c: Column | str) -> Column:
    return bucket(c, VISIT_LENGTH_BUCKETS)


def step_length_bucket(c: Column | str) -> Column:
    return bucket(c, STEP_LENGTH_BUCKETS)


def area_level(
    c: Column | str,
    levels: Mapping[str, str] = AREA_LEVELS,
    other: str = OTHER_AREA_LEVEL,
) -> Column:
    """Level of an area name."""
    c = F.col(c) if isinstance(c, str) else c
    by_level: dict[str, list[str]] = {}
    for area, level in levels.items():
        by_level.setdefault(level, []).append(area)
    if not by_level:
        return F.lit(other)
    (level, areas), *rest = by_level.items()
    start = F.when(c.isin(areas), level)
    labelled = reduce(lambda acc, kv: acc.when(c.isin(kv[1]), kv[0]), rest, start)
    return labelled.otherwise(other)


def product_status(extend_info: Column | str) -> Column:
    """Status text from the JSON field ``product_status``."""
    c = F.col(extend_info) if isinstance(extend_info, str) else extend_info
    own = F.get_json_object(c, "$.product_status") == "0"
    return F.when(own, SELF_OPERATED).otherwise(THIRD_PARTY)
