"""Aggregate helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def group_concat_distinct(c: Column | str, sep: str = ",") -> Column:
    """Distinct values of a group in ascending order, joined; nulls are skipped.

    Numbers sort as numbers. ``collect_set`` combines on the map side, so what is
    shuffled per group is its distinct values and not its rows.
    """
    values = F.sort_array(F.collect_set(c))
    return F.array_join(values.cast("array<string>"), sep)
