"""The column helpers, run over provided tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.functions import salting, strings, times
from clickloom.functions.aggregates import group_concat_distinct
from clickloom.registry import inputs as i
from clickloom.sources import fixtures
from clickloom.sources.tasks import parse_task_params


def _two_times(spark, sf):
    """Event time with an unpadded hour, and noon of that day; no time on error events."""
    events = fixtures.provided(spark, sf, "events")
    noon = F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit(" 12:00:00"))
    return events.select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd H:mm:ss").alias("a"),
        F.when(F.col("event_type") == "error", "no time").otherwise(noon).alias("b"),
    )


def _time_compare(spark, sf):
    return _two_times(spark, sf).select(
        "event_id",
        times.before("a", "b").alias("is_before"),
        times.after("a", "b").alias("is_after"),
    )


def _time_minus(spark, sf):
    return _two_times(spark, sf).select(
        "event_id", times.minus_seconds("a", "b").alias("seconds")
    )


def _time_keys(spark, sf):
    parsed = _two_times(spark, sf).select("event_id", times.parse_time("a").alias("ts"))
    keys = parsed.select(
        "event_id",
        times.format_date("ts").alias("date"),
        times.format_time("ts").alias("time"),
        times.format_date_key("ts").alias("date_key"),
        times.format_minute_key("ts").alias("minute_key"),
        times.date_hour("ts").alias("date_hour"),
    )
    _, hour, minute = times.minute_key_parts("minute_key")
    return keys.withColumns(
        {
            "date_of_key": times.format_date(times.parse_date_key("date_key")),
            "hour": hour,
            "minute": minute,
        }
    )


def _string_helpers(spark, sf):
    part = fixtures.provided(spark, sf, "part")
    kind = F.when(F.col("p_type") != "ECONOMY", F.col("p_type"))
    return part.select(
        "p_partkey",
        strings.is_empty(kind).alias("no_kind"),
        strings.is_not_empty(kind).alias("has_kind"),
        strings.trim_comma(F.concat(F.lit(","), F.col("p_name"), F.lit(","))).alias("trimmed"),
        strings.zero_pad2(F.col("p_size").cast("string")).alias("size2"),
    )


def _packed(spark, sf):
    users = fixtures.user_info(spark, sf)
    record = F.concat(
        F.concat(F.lit("userid="), F.col("user_id").cast("string")),
        F.concat(F.lit("| sex = "), F.col("sex")),
        F.concat(F.lit("|city="), F.col("city")),
        F.lit("|note="),
    )
    return users.select("user_id", "professional", record.alias("record"))


def _packed_get(spark, sf):
    return _packed(spark, sf).select(
        "user_id",
        strings.packed_get("record", "userid").alias("userid"),
        strings.packed_get("record", "sex").alias("sex"),
        strings.packed_get("record", "city").alias("city"),
        strings.packed_get("record", "note").alias("note"),
        strings.packed_get("record", "age").alias("age"),
    )


def _packed_set(spark, sf):
    return _packed(spark, sf).select(
        "user_id",
        strings.packed_set("record", "city", F.col("professional")).alias("changed"),
        strings.packed_set("record", "age", "30").alias("unchanged"),
    )


def _json_field(spark, sf):
    return fixtures.provided(spark, sf, "events").select(
        "event_id",
        strings.json_field("props", "k").alias("k"),
        strings.json_field("props", "none").alias("none"),
    )


def _salt_roundtrip(spark, sf):
    label = strings.concat_long_string("user_id", "event_type", "_")
    salted = fixtures.provided(spark, sf, "events").select(
        "event_id", salting.random_prefix(label, 10, "event_id").alias("salted")
    )
    return salted.select(
        "event_id",
        salting.remove_random_prefix("salted").alias("label"),
        F.col("salted").rlike("^[0-9]_").alias("has_salt"),
    )


def _group_concat_distinct(spark, sf):
    events = fixtures.provided(spark, sf, "events")
    label = strings.concat_long_string("user_id", "event_type")
    return events.groupBy("user_id").agg(
        group_concat_distinct(label).alias("labels"),
        group_concat_distinct(F.get_json_object("props", "$.k").cast("long")).alias("ks"),
    )


QUERIES = {
    "time_compare": _time_compare,
    "time_minus": _time_minus,
    "time_keys": _time_keys,
    "string_helpers": _string_helpers,
    "packed_get": _packed_get,
    "packed_set": _packed_set,
    "json_field": _json_field,
    "salt_roundtrip": _salt_roundtrip,
    "group_concat_distinct": _group_concat_distinct,
    "task_params": lambda s, d: parse_task_params(fixtures.tasks(s, d)),
}

_SECOND = "date_trunc('second', ts)"
_NOON = "(date_trunc('day', ts) + INTERVAL 12 HOUR)"

ORACLES = {
    "time_compare": f"""SELECT event_id,
      event_type <> 'error' AND {_SECOND} < {_NOON} AS is_before,
      event_type <> 'error' AND {_SECOND} > {_NOON} AS is_after FROM events""",
    "time_minus": f"""SELECT event_id, CASE WHEN event_type = 'error' THEN CAST(0 AS BIGINT)
      ELSE date_diff('second', {_NOON}, {_SECOND}) END AS seconds FROM events""",
    "time_keys": """SELECT event_id, strftime(ts, '%Y-%m-%d') AS date,
      strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, strftime(ts, '%Y%m%d') AS date_key,
      strftime(ts, '%Y%m%d%H%M') AS minute_key, strftime(ts, '%Y-%m-%d_%H') AS date_hour,
      strftime(ts, '%Y-%m-%d') AS date_of_key, strftime(ts, '%H') AS hour,
      strftime(ts, '%M') AS minute FROM events""",
    "string_helpers": """SELECT p_partkey, p_type = 'ECONOMY' AS no_kind,
      p_type <> 'ECONOMY' AS has_kind, p_name AS trimmed,
      lpad(CAST(p_size AS VARCHAR), 2, '0') AS size2 FROM part""",
    "packed_get": i.with_tables(
        i.USER_INFO,
        query="""SELECT user_id, CAST(user_id AS VARCHAR) AS userid, sex, city,
          CAST(NULL AS VARCHAR) AS note, CAST(NULL AS VARCHAR) AS age FROM user_info""",
    ),
    "packed_set": i.with_tables(
        i.USER_INFO,
        query="""SELECT user_id,
          'userid=' || user_id || '| sex = ' || sex || '|city=' || professional || '|note='
            AS changed,
          'userid=' || user_id || '| sex = ' || sex || '|city=' || city || '|note='
            AS unchanged
        FROM user_info""",
    ),
    "json_field": """SELECT event_id, json_extract_string(props, '$.k') AS k,
      CAST(NULL AS VARCHAR) AS none FROM events""",
    "salt_roundtrip": """SELECT event_id, user_id || '_' || event_type AS label,
      TRUE AS has_salt FROM events""",
    "group_concat_distinct": f"""SELECT user_id,
      array_to_string(list_sort(list(DISTINCT user_id || ':' || event_type)), ',') AS labels,
      array_to_string(CAST(list_sort(list(DISTINCT {i.K})) AS VARCHAR[]), ',') AS ks
    FROM events GROUP BY user_id""",
    "task_params": i.with_tables(
        i.TASKS,
        query="""SELECT task_id, start_date, end_date, start_age, end_age, professionals,
          CAST(NULL AS VARCHAR) AS cities, CAST(NULL AS VARCHAR) AS sex,
          CAST(NULL AS VARCHAR) AS keywords, CAST(NULL AS VARCHAR) AS category_ids,
          p || ',' || (p + 1) || ',' || (p + 2) || ',' || (p + 3) AS target_page_flow
        FROM task""",
    ),
}
