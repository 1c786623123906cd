"""Area and product queries."""

from __future__ import annotations


from clickloom.functions.labels import area_level
from clickloom.operators import area_products as ops
from clickloom.registry import inputs as i
from clickloom.sources import fixtures


def _click_actions(spark, sf):
    actions = fixtures.user_visit_action(spark, sf, i.FIRST_DAY, i.LAST_DAY)
    return ops.click_actions(actions, i.FIRST_DAY, i.LAST_DAY)


def _basic(spark, sf, *keep):
    return ops.click_product_basic(
        fixtures.click_fact(spark, sf), fixtures.city_info(spark, sf), *keep
    )


def _counts(spark, sf):
    return ops.area_product_counts(fixtures.click_fact(spark, sf), fixtures.city_info(spark, sf))


def _salted(spark, sf):
    return ops.area_product_counts_salted(
        _basic(spark, sf, "session_id"), ["session_id", "product_id"]
    )


def _full(spark, sf):
    return ops.with_product_info(_counts(spark, sf), fixtures.product_info(spark, sf))


def _levels(spark, sf):
    return fixtures.city_info(spark, sf).select(
        "city_id", "area", area_level("area", i.LEVELS).alias("area_level")
    )


def area_top3_product(spark, sf):
    return ops.area_top_products(
        fixtures.click_fact(spark, sf, i.CLICK_START, i.CLICK_END),
        fixtures.city_info(spark, sf),
        fixtures.product_info(spark, sf),
        i.CLICK_START,
        i.CLICK_END,
        levels=i.LEVELS,
    )


def _area_top3_all_days(spark, sf):
    return ops.top_products_per_area(_full(spark, sf), levels=i.LEVELS)


QUERIES = {
    "area_top3_product": area_top3_product,
    "area_top3_product_all_days": _area_top3_all_days,
    "click_actions_by_date": _click_actions,
    "click_product_basic": _basic,
    "area_product_click_count": _counts,
    "area_product_click_count_salted": _salted,
    "area_full_product": _full,
    "area_level": _levels,
}

_LEVEL = (
    "CASE "
    + " ".join(f"WHEN area = '{a}' THEN '{level}'" for a, level in i.LEVELS.items())
    + " ELSE 'D Level' END"
)
_BASIC = """basic AS (
  SELECT f.city_id, city_name, area, click_product_id AS product_id, date
  FROM click_fact f JOIN city_info c ON f.city_id = c.city_id)"""


def _chain(where: str = "") -> tuple[str, ...]:
    counts = f"""counts AS (
      SELECT area, product_id, count(*) AS click_count, array_to_string(
        list_sort(list(DISTINCT city_id || ':' || city_name)), ',') AS city_infos
      FROM basic {where} GROUP BY area, product_id)"""
    full = """full_counts AS (
      SELECT area, c.product_id, click_count, city_infos, product_name,
        CASE WHEN json_extract_string(extend_info, '$.product_status') = '0'
          THEN '自营商品' ELSE '第三方商品' END AS product_status
      FROM counts c JOIN product_info p ON c.product_id = p.product_id)"""
    return i.CLICK_FACT, i.CITY_INFO, i.PRODUCT_INFO, _BASIC, counts, full


_TOP = f"""SELECT area, {_LEVEL} AS area_level, product_id, click_count, city_infos,
  product_name, product_status
FROM (SELECT *, row_number() OVER (
    PARTITION BY area ORDER BY click_count DESC, product_id) AS rank FROM full_counts)
WHERE rank <= 3"""
_PLAIN_COUNTS = i.with_tables(*_chain(), query="SELECT * FROM counts")

ORACLES = {
    "area_top3_product": i.with_tables(
        *_chain(f"WHERE date BETWEEN '{i.CLICK_START}' AND '{i.CLICK_END}'"), query=_TOP
    ),
    "area_top3_product_all_days": i.with_tables(*_chain(), query=_TOP),
    "click_actions_by_date": i.with_tables(
        i.USER_VISIT_ACTION,
        query=f"""SELECT city_id, click_product_id FROM user_visit_action
        WHERE click_product_id IS NOT NULL
          AND date BETWEEN '{i.FIRST_DAY}' AND '{i.LAST_DAY}'""",
    ),
    "click_product_basic": i.with_tables(
        *_chain(), query="SELECT city_id, city_name, area, product_id FROM basic"
    ),
    "area_product_click_count": _PLAIN_COUNTS,
    "area_product_click_count_salted": _PLAIN_COUNTS,
    "area_full_product": i.with_tables(*_chain(), query="SELECT * FROM full_counts"),
    "area_level": i.with_tables(
        i.CITY_INFO, query=f"SELECT city_id, area, {_LEVEL} AS area_level FROM city_info"
    ),
}
