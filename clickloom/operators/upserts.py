"""Table updates as pure functions: the table and the change in, the new table out.

The change is usually far smaller than the table. Anti joins broadcast it when its
size allows, and then the table is neither shuffled nor sorted. Null keys are keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.skew import key_copy


def upsert_add(
    target: DataFrame, delta: DataFrame, keys: Sequence[str], measure: str = "click_count"
) -> DataFrame:
    """Add ``delta`` to the measure of the keys it names; new keys are inserted."""
    columns = [*keys, measure]
    both = target.select(*columns).unionByName(delta.select(*columns))
    return both.groupBy(*keys).agg(F.sum(measure).alias(measure))


def upsert_replace(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``source`` (one per key) take the place of those with the same key."""
    return without_keys(target, source, keys).unionByName(source.select(*target.columns))


def replace_group(target: DataFrame, source: DataFrame, group: Sequence[str]) -> DataFrame:
    """Every group that ``source`` has rows for is replaced as a whole."""
    groups = source.select(*group).distinct()
    return without_keys(target, groups, group).unionByName(source.select(*target.columns))


def append_new(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The incoming keys that are not there yet, once each: what to append to a set."""
    return without_keys(incoming.select(*keys).distinct(), existing, keys)


def same_keys(left: DataFrame, copies: DataFrame, keys: Sequence[str]) -> Column:
    """Equality of the keys with their copies ``_<key>``; a null key equals a null key."""
    tests = [left[c].eqNullSafe(copies[f"_{c}"]) for c in keys]
    return reduce(lambda a, b: a & b, tests)


def key_copies(df: DataFrame, keys: Sequence[str], *more: str) -> DataFrame:
    return df.select(*[key_copy(c).alias(f"_{c}") for c in keys], *more)


def without_keys(rows: DataFrame, keyed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys ``keyed`` does not name."""
    copies = key_copies(keyed, keys)
    return rows.join(copies, same_keys(rows, copies, keys), "left_anti")
