"""SQL twins of the adapters in :mod:`clickloom.sources.fixtures`, and query parameters."""

from __future__ import annotations

from clickloom.sources.tasks import TaskParams

# Buckets of the tables that queries land; a session or user is in one of them for each day.
BUCKETS = 8
FIRST_DAY, LAST_DAY = "2024-01-05", "2024-01-10"
CLICK_START, CLICK_END = "1996-01-01", "1997-12-31"
FLOW = "1,2,3,4,5"
TASK_ID = 7
SAMPLE_SIZE = 1000
LARGE_SAMPLE_SIZE = 5000
BLACKLIST_CLICKS = 3
LISTED_UNTIL = "2024-01-03"
SESSION_PARAMS = TaskParams(TASK_ID, start_age=20, end_age=50, sex="male", keywords="kw1,kw2")
LIST_PARAMS = TaskParams(
    TASK_ID,
    start_age=20,
    end_age=50,
    professionals="BUILDING,MACHINERY",
    cities="NATION_0,NATION_3,NATION_5,NATION_8,NATION_13,NATION_21",
    category_ids="1,2,3,5,8,13,21,34,55,89",
)
# The levels of the areas in the provided tables.
LEVELS = {
    "AFRICA": "A Level",
    "AMERICA": "A Level",
    "ASIA": "B Level",
    "EUROPE": "B Level",
    "MIDDLE EAST": "C Level",
}

K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

USER_VISIT_ACTION = f"""user_visit_action AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, user_id,
    user_id || '_' || strftime(ts, '%Y%m%d') AS session_id,
    k % 10 AS page_id,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS action_time,
    CASE WHEN event_type = 'view' THEN 'kw' || (k % 10) END AS search_keyword,
    CASE WHEN event_type = 'click' THEN k END AS click_category_id,
    CASE WHEN event_type = 'click' THEN event_id % 200 END AS click_product_id,
    CASE WHEN event_type = 'purchase' THEN k || ',' || ((k * 7 + 1) % 100) END AS order_category_ids,
    CASE WHEN event_type = 'purchase' THEN CAST(event_id % 200 AS VARCHAR) END AS order_product_ids,
    CASE WHEN event_type = 'signup' THEN k || ',' || ((k * 3 + 1) % 100) END AS pay_category_ids,
    CASE WHEN event_type = 'signup' THEN CAST(event_id % 200 AS VARCHAR) END AS pay_product_ids,
    event_id % 25 AS city_id
  FROM (SELECT *, {K} AS k FROM events) e)"""

USER_INFO = """user_info AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name AS name,
    18 + c_custkey % 60 AS age, c_mktsegment AS professional, n_name AS city,
    CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

CITY_INFO = """city_info AS (
  SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

PRODUCT_INFO = """product_info AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
    '{"product_status":' || (p_size % 2) || '}' AS extend_info
  FROM part)"""

CLICK_FACT = """click_fact AS (
  SELECT strftime(l_shipdate, '%Y-%m-%d') AS date, CAST(c_nationkey AS BIGINT) AS city_id,
    l_partkey AS click_product_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""

AD_CLICK = f"""ad_click AS (
  SELECT ts, strftime(ts, '%Y-%m-%d') AS date, 'P' || n_regionkey AS province,
    'C' || n_nationkey AS city, user_id, {K} % 5 AS ad_id
  FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

TASKS = """task AS (
  SELECT c_custkey AS task_id,
    CAST(DATE '2024-01-01' + CAST(c_custkey % 25 AS INTEGER) AS VARCHAR) AS start_date,
    CAST(DATE '2024-01-04' + CAST(c_custkey % 25 AS INTEGER) AS VARCHAR) AS end_date,
    CASE WHEN c_custkey % 3 <> 0 THEN 18 + c_custkey % 30 END AS start_age,
    CASE WHEN c_custkey % 3 <> 0 THEN 38 + c_custkey % 30 END AS end_age,
    c_mktsegment AS professionals, c_custkey % 7 AS p
  FROM customer)"""

SESSIONS = """session_agg AS (
  SELECT session_id, min(user_id) AS user_id,
    coalesce(array_to_string(list_sort(list(DISTINCT search_keyword)
      FILTER (WHERE search_keyword IS NOT NULL)), ','), '') AS search_keywords,
    coalesce(array_to_string(CAST(list_sort(list(DISTINCT click_category_id)
      FILTER (WHERE click_category_id IS NOT NULL)) AS VARCHAR[]), ','), '') AS click_category_ids,
    min(action_time) AS start_time,
    date_diff('second', min(CAST(action_time AS TIMESTAMP)),
      max(CAST(action_time AS TIMESTAMP))) AS visit_length,
    count(*) AS step_length
  FROM user_visit_action GROUP BY session_id)"""

FULL_SESSIONS = """session_full AS (
  SELECT s.*, age, professional, city, sex
  FROM session_agg s JOIN user_info u ON s.user_id = u.user_id)"""

FILTERED_SESSIONS = """session_filtered AS (
  SELECT * FROM session_full
  WHERE age BETWEEN 20 AND 50 AND sex = 'male'
    AND list_has_any(string_split(search_keywords, ','), ['kw1', 'kw2']))"""


def with_tables(*ctes: str, query: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + query
