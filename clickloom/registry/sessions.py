"""Session queries."""

from __future__ import annotations

from clickloom.functions.labels import STEP_LENGTH_BUCKETS, VISIT_LENGTH_BUCKETS
from clickloom.operators import sampling
from clickloom.operators import sessions as ops
from clickloom.registry import inputs as i
from clickloom.schemas import USER_VISIT_ACTION
from clickloom.sources import bucketed, fixtures
from clickloom.sources.workspace import stored

_SESSION_TABLES = (i.USER_VISIT_ACTION, i.SESSIONS)
_FULL_TABLES = (*_SESSION_TABLES, i.USER_INFO, i.FULL_SESSIONS)
_FILTERED_TABLES = (*_FULL_TABLES, i.FILTERED_SESSIONS)


def _sessions(spark, sf):
    return ops.aggregate_sessions(fixtures.user_visit_action(spark, sf))


def _full(spark, sf):
    return ops.with_user_info(_sessions(spark, sf), fixtures.user_info(spark, sf))


def _filtered(spark, sf):
    return ops.filter_sessions(_full(spark, sf), i.SESSION_PARAMS)


def _sample(spark, sf, total=i.SAMPLE_SIZE):
    return sampling.random_extract(stored(_sessions(spark, sf), "sessions"), i.TASK_ID, total)


def _filtered_by_lists(spark, sf):
    return ops.filter_sessions(_full(spark, sf), i.LIST_PARAMS)


def _action_by_date_range(spark, sf):
    actions = fixtures.user_visit_action(spark, sf, i.FIRST_DAY, i.LAST_DAY)
    return ops.actions_by_date(actions, i.FIRST_DAY, i.LAST_DAY)


def _session_detail(spark, sf):
    return ops.session_details(_filtered(spark, sf), fixtures.user_visit_action(spark, sf))


def _extract_session_detail(spark, sf):
    actions = fixtures.user_visit_action(spark, sf)
    return ops.sampled_session_details(_sample(spark, sf), actions, i.SAMPLE_SIZE)


def _landed_session_detail(spark, sf):
    """Sessions and their actions from one landing by day and session."""
    name, path = bucketed.new_table(spark, "landed_actions")
    bucketed.create_bucketed(spark, name, USER_VISIT_ACTION, ["session_id"], i.BUCKETS, path)
    bucketed.land(fixtures.user_visit_action(spark, sf), name)
    landed = bucketed.of_days(spark, name, i.FIRST_DAY, i.LAST_DAY)
    full = ops.with_user_info(ops.aggregate_sessions(landed), fixtures.user_info(spark, sf))
    return ops.landed_session_details(ops.filter_sessions(full, i.SESSION_PARAMS), landed)


QUERIES = {
    "action_by_date_range": _action_by_date_range,
    "session_agg": _sessions,
    "session_full_info": _full,
    "session_filter": _filtered,
    "session_stat": lambda s, d: ops.session_statistics(_filtered(s, d)),
    "visit_length_hist": lambda s, d: ops.visit_length_histogram(_sessions(s, d)),
    "step_length_hist": lambda s, d: ops.step_length_histogram(_sessions(s, d)),
    "sessions_per_hour": lambda s, d: sampling.sessions_per_hour(_sessions(s, d)),
    "session_random_extract": _sample,
    "session_random_extract_large": lambda s, d: _sample(s, d, i.LARGE_SAMPLE_SIZE),
    "session_filter_lists": _filtered_by_lists,
    "session_detail": _session_detail,
    "extract_session_detail": _extract_session_detail,
    "landed_session_detail": _landed_session_detail,
}


def _test(column: str, low: int, high: int | None) -> str:
    return f"{column} >= {low}" if high is None else f"{column} BETWEEN {low} AND {high}"


def _case(column: str, buckets) -> str:
    whens = " ".join(f"WHEN {_test(column, lo, hi)} THEN '{name}'" for name, lo, hi in buckets)
    return f"CASE {whens} END"


def _histogram(column: str, buckets) -> str:
    return i.with_tables(
        *_SESSION_TABLES,
        query=f"""SELECT bucket, count(*) AS session_count
        FROM (SELECT {_case(column, buckets)} AS bucket FROM session_agg)
        WHERE bucket IS NOT NULL GROUP BY bucket""",
    )


def _stat_rows() -> str:
    rows = ["SELECT 'session_count' AS stat, count(*) AS value FROM session_filtered"]
    for column, prefix, buckets in (
        ("visit_length", "visit_", VISIT_LENGTH_BUCKETS),
        ("step_length", "step_", STEP_LENGTH_BUCKETS),
    ):
        rows += [
            f"SELECT '{prefix}{name}', count(*) FILTER (WHERE {_test(column, lo, hi)}) "
            "FROM session_filtered"
            for name, lo, hi in buckets
        ]
    return "\nUNION ALL ".join(rows)



def _sample_sql(total: int) -> str:
    return f"""hours AS (
  SELECT substr(start_time, 1, 10) AS date, substr(start_time, 12, 2) AS hour, count(*) AS n
  FROM session_agg GROUP BY ALL),
quotas AS (
  SELECT date, hour, CAST(trunc((CAST(n AS DOUBLE)
      / CAST(sum(n) OVER (PARTITION BY date) AS DOUBLE))
    * ({total} // (SELECT count(DISTINCT date) FROM hours))) AS BIGINT) AS quota
  FROM hours),
ranked AS (
  SELECT *, substr(start_time, 1, 10) AS date, substr(start_time, 12, 2) AS hour,
    row_number() OVER (PARTITION BY substr(start_time, 1, 13)
      ORDER BY md5(session_id), session_id) AS rn
  FROM session_agg),
sample AS (
  SELECT CAST({i.TASK_ID} AS BIGINT) AS task_id, session_id, start_time, search_keywords,
    click_category_ids
  FROM ranked JOIN quotas USING (date, hour) WHERE rn <= quota)"""


_SAMPLE = _sample_sql(i.SAMPLE_SIZE)
_DETAIL = ", ".join(f"a.{c}" for c in ops.DETAIL_COLUMNS)

ORACLES = {
    "action_by_date_range": i.with_tables(
        i.USER_VISIT_ACTION,
        query=f"""SELECT * FROM user_visit_action
        WHERE date BETWEEN '{i.FIRST_DAY}' AND '{i.LAST_DAY}'""",
    ),
    "session_agg": i.with_tables(*_SESSION_TABLES, query="SELECT * FROM session_agg"),
    "session_full_info": i.with_tables(*_FULL_TABLES, query="SELECT * FROM session_full"),
    "session_filter": i.with_tables(*_FILTERED_TABLES, query="SELECT * FROM session_filtered"),
    "session_stat": i.with_tables(*_FILTERED_TABLES, query=_stat_rows()),
    "visit_length_hist": _histogram("visit_length", VISIT_LENGTH_BUCKETS),
    "step_length_hist": _histogram("step_length", STEP_LENGTH_BUCKETS),
    "sessions_per_hour": i.with_tables(
        *_SESSION_TABLES,
        query="""SELECT substr(start_time, 1, 10) AS date, substr(start_time, 12, 2) AS hour,
          count(*) AS session_count FROM session_agg GROUP BY ALL""",
    ),
    "session_random_extract": i.with_tables(
        *_SESSION_TABLES, _SAMPLE, query="SELECT * FROM sample"
    ),
    "session_random_extract_large": i.with_tables(
        *_SESSION_TABLES, _sample_sql(i.LARGE_SAMPLE_SIZE), query="SELECT * FROM sample"
    ),
    "session_filter_lists": i.with_tables(
        *_FULL_TABLES,
        query="""SELECT * FROM session_full
        WHERE age BETWEEN 20 AND 50 AND professional IN ('BUILDING', 'MACHINERY')
          AND city IN ('NATION_0', 'NATION_3', 'NATION_5', 'NATION_8', 'NATION_13', 'NATION_21')
          AND list_has_any(string_split(click_category_ids, ','),
            ['1', '2', '3', '5', '8', '13', '21', '34', '55', '89'])""",
    ),
    "session_detail": i.with_tables(
        *_FILTERED_TABLES,
        query=f"""SELECT {_DETAIL} FROM user_visit_action a
        JOIN session_filtered s ON a.session_id = s.session_id""",
    ),
    "landed_session_detail": i.with_tables(
        *_FILTERED_TABLES,
        query=f"""SELECT {_DETAIL} FROM user_visit_action a
        JOIN session_filtered s ON a.session_id = s.session_id
        WHERE a.date BETWEEN '{i.FIRST_DAY}' AND '{i.LAST_DAY}'""",
    ),
    "extract_session_detail": i.with_tables(
        *_SESSION_TABLES,
        _SAMPLE,
        query=f"""SELECT {_DETAIL} FROM user_visit_action a
        JOIN sample s ON a.session_id = s.session_id""",
    ),
}
