"""Page-flow queries."""

from __future__ import annotations

from clickloom.operators import page_flow as ops
from clickloom.registry import inputs as i
from clickloom.sources import fixtures
from clickloom.sources.tasks import parse_task_params


def _on_flow(operator):
    return lambda spark, sf: operator(fixtures.user_visit_action(spark, sf), i.FLOW)


def _packed(spark, sf):
    actions = fixtures.user_visit_action(spark, sf)
    return ops.pack_rates(ops.page_convert_rates(actions, i.FLOW), i.TASK_ID)


QUERIES = {
    "page_flow_pairs": lambda s, d: ops.task_flow_pairs(parse_task_params(fixtures.tasks(s, d))),
    "page_split_pairs": _on_flow(ops.page_split_pairs),
    "page_split_pv": _on_flow(ops.page_split_pv),
    "start_page_pv": _on_flow(ops.start_page_pv),
    "page_convert_rate": _on_flow(ops.page_convert_rates),
    "page_convert_packed": _packed,
}

_PAIR_LIST = "'1_2', '2_3', '3_4', '4_5'"
_SPLITS = f"""splits AS (
  SELECT session_id, page_split FROM (
    SELECT session_id, page_id || '_' || lead(page_id) OVER (
      PARTITION BY session_id ORDER BY action_time, page_id) AS page_split
    FROM user_visit_action)
  WHERE page_split IN ({_PAIR_LIST}))"""
_RATES = f"""pv AS (
  SELECT CAST(f.idx AS INTEGER) AS idx, f.page_split,
    (SELECT count(*) FROM splits s WHERE s.page_split = f.page_split) AS pv
  FROM (SELECT unnest([{_PAIR_LIST}]) AS page_split, unnest([0, 1, 2, 3]) AS idx) f),
steps AS (
  SELECT idx, page_split, pv, coalesce(lag(pv) OVER (ORDER BY idx),
    (SELECT count(*) FROM user_visit_action WHERE page_id = 1)) AS from_pv
  FROM pv),
rates AS (
  SELECT idx, page_split, CASE WHEN from_pv <> 0 THEN CAST(round(
    CAST(CAST(pv AS DOUBLE) / from_pv AS DECIMAL(18, 6)), 2) AS DOUBLE) END AS convert_rate
  FROM steps)"""

ORACLES = {
    "page_flow_pairs": i.with_tables(
        i.TASKS,
        query="""SELECT task_id, CAST(s.idx AS INTEGER) AS idx,
          (p + s.idx) || '_' || (p + s.idx + 1) AS page_split
        FROM task, (SELECT unnest([0, 1, 2]) AS idx) s""",
    ),
    "page_split_pairs": i.with_tables(
        i.USER_VISIT_ACTION, _SPLITS, query="SELECT * FROM splits"
    ),
    "page_split_pv": i.with_tables(
        i.USER_VISIT_ACTION,
        _SPLITS,
        query="SELECT page_split, count(*) AS pv FROM splits GROUP BY page_split",
    ),
    "start_page_pv": i.with_tables(
        i.USER_VISIT_ACTION,
        query="""SELECT CAST(1 AS BIGINT) AS page_id, count(*) AS pv
        FROM user_visit_action WHERE page_id = 1""",
    ),
    "page_convert_rate": i.with_tables(
        i.USER_VISIT_ACTION, _SPLITS, _RATES, query="SELECT * FROM rates"
    ),
    "page_convert_packed": i.with_tables(
        i.USER_VISIT_ACTION,
        _SPLITS,
        _RATES,
        query=f"""SELECT CAST({i.TASK_ID} AS BIGINT) AS task_id,
          string_agg(page_split || '=' || coalesce(CAST(convert_rate AS VARCHAR), 'null'), '|'
            ORDER BY idx) AS convert_rate FROM rates""",
    ),
}
