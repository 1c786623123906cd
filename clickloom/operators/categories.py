"""Category popularity by clicks, orders and payments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.strings import comma_longs
from clickloom.operators.skew import salted_count

# Columns that tell two actions on one category apart.
ACTION_ROW = ("session_id", "action_time", "page_id", "click_product_id")


def click_counts(actions: DataFrame) -> DataFrame:
    clicks = actions.where(F.col("click_category_id").isNotNull())
    return clicks.groupBy(F.col("click_category_id").alias("category_id")).agg(
        F.count(F.lit(1)).alias("click_count")
    )


def click_counts_salted(
    actions: DataFrame, n: int = 10, row_columns: Sequence[str] = ACTION_ROW
) -> DataFrame:
    """Same counts as :func:`click_counts`, a hot category being spread over ``n`` groups."""
    clicks = actions.where(F.col("click_category_id").isNotNull()).withColumnRenamed(
        "click_category_id", "category_id"
    )
    return salted_count(clicks, ["category_id"], row_columns, n)


def order_counts(actions: DataFrame) -> DataFrame:
    return _list_counts(actions, "order_category_ids", "order_count")


def pay_counts(actions: DataFrame) -> DataFrame:
    return _list_counts(actions, "pay_category_ids", "pay_count")


def _list_counts(actions: DataFrame, lists: str, count_name: str) -> DataFrame:
    given = actions.where(F.col(lists).isNotNull())
    ids = given.select(F.explode(comma_longs(lists)).alias("category_id"))
    return (
        ids.where(F.col("category_id").isNotNull())
        .groupBy("category_id")
        .agg(F.count(F.lit(1)).alias(count_name))
    )


def _tagged(kind: str, ids: Column) -> Column:
    ids = F.coalesce(ids, F.array().cast("array<bigint>"))
    kinds = F.array_repeat(F.lit(kind), F.size(ids))
    return F.arrays_zip(kinds.alias("kind"), ids.alias("category_id"))


def _category_uses(actions: DataFrame) -> DataFrame:
    """One row per category named by an action, with the kind of action; a single scan."""
    uses = F.concat(
        _tagged("click", F.array("click_category_id")),
        _tagged("order", comma_longs("order_category_ids")),
        _tagged("pay", comma_longs("pay_category_ids")),
    )
    return actions.select(F.inline(uses)).where(F.col("category_id").isNotNull())


def visited_categories(actions: DataFrame) -> DataFrame:
    """Distinct categories clicked, ordered or paid for."""
    return _category_uses(actions).select("category_id").distinct()


def join_category_counts(
    categories: DataFrame, clicks: DataFrame, orders: DataFrame, pays: DataFrame
) -> DataFrame:
    """Every category with its three counts, 0 where a count is missing."""
    joined = categories
    for counts in (clicks, orders, pays):
        joined = joined.join(counts, "category_id", "left")
    return joined.select(
        "category_id",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("click_count", "order_count", "pay_count")],
    )


def category_counts(actions: DataFrame) -> DataFrame:
    """The three counts of every visited category from one scan and one shuffle."""
    kind = F.col("kind")
    return _category_uses(actions).groupBy("category_id").agg(
        F.count_if(kind == "click").alias("click_count"),
        F.count_if(kind == "order").alias("order_count"),
        F.count_if(kind == "pay").alias("pay_count"),
    )


def top_categories(counts: DataFrame, k: int = 10) -> DataFrame:
    """The first ``k`` by clicks, then orders, then payments, then lower id."""
    return counts.orderBy(
        F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), F.asc("category_id")
    ).limit(k)
