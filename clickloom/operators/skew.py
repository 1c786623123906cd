"""Counting and joining with hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.salting import salt


def salted_partials(
    df: DataFrame,
    keys: Sequence[str],
    row_columns: Sequence[Column | str],
    n: int = 10,
    count_name: str = "click_count",
) -> DataFrame:
    """Rows per (group, salt): at most ``n`` counts per group, whatever its size.

    ``row_columns`` tell the rows of a group apart; they are all the salt is made of.
    """
    salted = df.select(*keys, salt(n, *row_columns).alias("_salt"))
    counts = salted.groupBy(*keys, "_salt").agg(F.count(F.lit(1)).alias(count_name))
    return counts.drop("_salt")


def salted_count(
    df: DataFrame,
    keys: Sequence[str],
    row_columns: Sequence[Column | str],
    n: int = 10,
    count_name: str = "click_count",
) -> DataFrame:
    """Rows per group, counted per (group, salt) first and then added up."""
    partials = salted_partials(df, keys, row_columns, n, count_name)
    return partials.groupBy(*keys).agg(F.sum(count_name).alias(count_name))


def key_copy(c: str) -> Column:
    """The value of a key column as an expression of its own, to join a large table on.

    A side that has been aggregated by its key is partitioned by it already, and a join
    on that column starts from there. Run-time skew handling then stays away, since it
    splits a partition only where both sides are plain shuffle stages. A join on a copy
    shuffles the aggregated side again, which is small, and lets a hot key of the large
    side be split over many tasks.
    """
    return F.greatest(c, c)
