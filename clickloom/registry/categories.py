"""Category queries."""

from __future__ import annotations

from clickloom.operators import categories as ops
from clickloom.registry import inputs as i
from clickloom.sources import fixtures


def _on_actions(operator):
    return lambda spark, sf: operator(fixtures.user_visit_action(spark, sf))


def _joined(spark, sf):
    actions = fixtures.user_visit_action(spark, sf)
    return ops.join_category_counts(
        ops.visited_categories(actions),
        ops.click_counts(actions),
        ops.order_counts(actions),
        ops.pay_counts(actions),
    )


QUERIES = {
    "category_click_count": _on_actions(ops.click_counts),
    "category_click_count_salted": _on_actions(ops.click_counts_salted),
    "category_order_count": _on_actions(ops.order_counts),
    "category_pay_count": _on_actions(ops.pay_counts),
    "visited_categories": _on_actions(ops.visited_categories),
    "category_counts_joined": _joined,
    "category_counts": _on_actions(ops.category_counts),
    "top10_category": _on_actions(lambda a: ops.top_categories(ops.category_counts(a))),
}

_USES = """uses AS (
  SELECT 'click' AS kind, click_category_id AS category_id FROM user_visit_action
  WHERE click_category_id IS NOT NULL
  UNION ALL
  SELECT 'order', CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT)
  FROM user_visit_action WHERE order_category_ids IS NOT NULL
  UNION ALL
  SELECT 'pay', CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT)
  FROM user_visit_action WHERE pay_category_ids IS NOT NULL)"""
_COUNTS = """SELECT category_id, count(*) FILTER (WHERE kind = 'click') AS click_count,
  count(*) FILTER (WHERE kind = 'order') AS order_count,
  count(*) FILTER (WHERE kind = 'pay') AS pay_count
FROM uses GROUP BY category_id"""


def _over_uses(query: str) -> str:
    return i.with_tables(i.USER_VISIT_ACTION, _USES, query=query)


def _kind(kind: str) -> str:
    return _over_uses(
        f"""SELECT category_id, count(*) AS {kind}_count FROM uses
        WHERE kind = '{kind}' GROUP BY category_id"""
    )


ORACLES = {
    "category_click_count": _kind("click"),
    "category_click_count_salted": _kind("click"),
    "category_order_count": _kind("order"),
    "category_pay_count": _kind("pay"),
    "visited_categories": _over_uses("SELECT DISTINCT category_id FROM uses"),
    "category_counts_joined": _over_uses(_COUNTS),
    "category_counts": _over_uses(_COUNTS),
    "top10_category": _over_uses(
        _COUNTS + "\nORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10"
    ),
}
