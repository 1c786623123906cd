"""Most clicked products per area."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.aggregates import group_concat_distinct
from clickloom.functions.labels import AREA_LEVELS, OTHER_AREA_LEVEL, area_level, product_status
from clickloom.functions.strings import concat_long_string
from clickloom.operators.skew import salted_partials
from clickloom.sources.tables import broadcast_if_small


def click_actions(actions: DataFrame, start: str, end: str) -> DataFrame:
    """City and product of the clicks of the days ``start`` to ``end``, both included."""
    clicked = F.col("click_product_id").isNotNull() & F.col("date").between(start, end)
    return actions.where(clicked).select("city_id", "click_product_id")


def click_product_basic(clicks: DataFrame, cities: DataFrame, *keep: str) -> DataFrame:
    """Clicks with the name and area of their city; clicks of unknown cities drop out.

    ``keep`` names further columns of ``clicks`` to carry along.
    """
    return clicks.join(broadcast_if_small(cities), "city_id").select(
        "city_id", "city_name", "area", F.col("click_product_id").alias("product_id"), *keep
    )


def _city_label():
    return concat_long_string("city_id", "city_name", ":")


def area_product_counts(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks and cities per (area, product).

    Clicks are counted per (city, product) first, so the city join and the city list
    work on counts and not on clicks. Those are then placed by product alone: the
    last aggregate and a later join on the product need no further shuffle.
    """
    per_city = clicks.groupBy("city_id", F.col("click_product_id").alias("product_id")).agg(
        F.count(F.lit(1)).alias("n")
    )
    placed = per_city.repartition("product_id").join(broadcast_if_small(cities), "city_id")
    return placed.groupBy("area", "product_id").agg(
        F.sum("n").alias("click_count"), group_concat_distinct(_city_label()).alias("city_infos")
    )


def area_product_counts_salted(
    basic: DataFrame, row_columns: Sequence[str], n: int = 10
) -> DataFrame:
    """The same from click rows with their city, hot groups spread over ``n`` salts.

    The city is part of the salted group, so the list of cities is made from counts too.
    """
    keys = ["area", "product_id", "city_id", "city_name"]
    partials = salted_partials(basic, keys, row_columns, n, count_name="n")
    return partials.groupBy("area", "product_id").agg(
        F.sum("n").alias("click_count"), group_concat_distinct(_city_label()).alias("city_infos")
    )


def with_product_info(counts: DataFrame, products: DataFrame) -> DataFrame:
    """Counts with product name and status; counts of unknown products drop out."""
    info = products.select(
        "product_id", "product_name", product_status("extend_info").alias("product_status")
    )
    return counts.join(broadcast_if_small(info), "product_id").select(
        "area", "product_id", "click_count", "city_infos", "product_name", "product_status"
    )


def top_products_per_area(
    full: DataFrame,
    k: int = 3,
    levels: Mapping[str, str] = AREA_LEVELS,
    other: str = OTHER_AREA_LEVEL,
) -> DataFrame:
    """The ``k`` most clicked products of each area; equal counts go by lower id.

    The fixed limit lets every task drop all but ``k`` rows per area before the shuffle.
    """
    by_clicks = Window.partitionBy("area").orderBy(F.desc("click_count"), F.asc("product_id"))
    ranked = full.withColumn("rank", F.row_number().over(by_clicks)).where(F.col("rank") <= k)
    return ranked.select(
        "area",
        area_level("area", levels, other).alias("area_level"),
        "product_id",
        "click_count",
        "city_infos",
        "product_name",
        "product_status",
    )


def area_top_products(
    actions: DataFrame,
    cities: DataFrame,
    products: DataFrame,
    start: str,
    end: str,
    k: int = 3,
    levels: Mapping[str, str] = AREA_LEVELS,
    other: str = OTHER_AREA_LEVEL,
) -> DataFrame:
    """Scan to rank as one plan."""
    counts = area_product_counts(click_actions(actions, start, end), cities)
    return top_products_per_area(with_product_info(counts, products), k, levels, other)
