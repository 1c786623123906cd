"""The column helpers as temporary SQL functions of a session."""

from __future__ import annotations

from pyspark.sql import SparkSession

_SQL_FUNCTIONS = (
    """concat_long_string(number BIGINT, text STRING, sep STRING) RETURNS STRING
       RETURN concat_ws(sep, CAST(number AS STRING), text)""",
    """get_json_field(json STRING, field STRING) RETURNS STRING
       RETURN get_json_object(json, concat('$.', field))""",
    """random_prefix(text STRING, n INT, row_hash BIGINT) RETURNS STRING
       RETURN concat_ws('_', CAST(pmod(row_hash, n) AS STRING), text)""",
    """remove_random_prefix(text STRING) RETURNS STRING
       RETURN regexp_replace(text, '^[0-9]+_', '')""",
    """join_sorted(items ARRAY<STRING>, sep STRING) RETURNS STRING
       RETURN array_join(array_sort(items), sep)""",
)


def register_sql_functions(spark: SparkSession) -> None:
    """Create the functions; Spark inlines them, so they cost what the built-ins cost.

    A SQL function cannot be an aggregate: write the distinct list of a group as
    ``join_sorted(collect_set(c), ',')``.
    """
    for text in _SQL_FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {text}")
