"""Fixed schemas of the input and result tables; every column may be null."""

from __future__ import annotations

from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

_TYPES = {"string": StringType(), "bigint": LongType(), "timestamp": TimestampType()}


def columns(text: str) -> StructType:
    """Schema of ``"name type, name type"``; unlike the DDL parser it needs no session."""
    pairs = [item.split() for item in text.split(",")]
    return StructType([StructField(name, _TYPES[kind], True) for name, kind in pairs])


USER_VISIT_ACTION = columns(
    "date string, user_id bigint, session_id string, page_id bigint, action_time string, "
    "search_keyword string, click_category_id bigint, click_product_id bigint, "
    "order_category_ids string, order_product_ids string, "
    "pay_category_ids string, pay_product_ids string, city_id bigint"
)
USER_INFO = columns(
    "user_id bigint, username string, name string, age bigint, "
    "professional string, city string, sex string"
)
PRODUCT_INFO = columns("product_id bigint, product_name string, extend_info string")
CITY_INFO = columns("city_id bigint, city_name string, area string")
TASK = columns(
    "task_id bigint, task_name string, create_time string, start_time string, "
    "finish_time string, task_type string, task_status string, task_param string"
)
AD_CLICK = columns(
    "ts timestamp, date string, province string, city string, user_id bigint, ad_id bigint"
)

SESSION_RANDOM_EXTRACT = columns(
    "task_id bigint, session_id string, start_time string, "
    "search_keywords string, click_category_ids string"
)
SESSION_DETAIL = columns(
    "task_id bigint, user_id bigint, session_id string, page_id bigint, action_time string, "
    "search_keyword string, click_category_id bigint, click_product_id bigint, "
    "order_category_ids string, order_product_ids string, "
    "pay_category_ids string, pay_product_ids string"
)
PAGE_SPLIT_CONVERT_RATE = columns("task_id bigint, convert_rate string")
AREA_TOP3_PRODUCT = columns(
    "task_id bigint, area string, area_level string, product_id bigint, city_infos string, "
    "click_count bigint, product_name string, product_status string"
)
AD_BLACKLIST = columns("user_id bigint")
AD_USER_CLICK_COUNT = columns(
    "date string, user_id bigint, ad_id bigint, click_count bigint"
)
AD_STAT = columns(
    "date string, province string, city string, ad_id bigint, click_count bigint"
)
AD_PROVINCE_TOP3 = columns(
    "date string, province string, ad_id bigint, click_count bigint"
)
AD_CLICK_TREND = columns(
    "date string, hour string, minute string, ad_id bigint, click_count bigint"
)
AD_SLIDING_TREND = columns(
    "window_start string, window_end string, ad_id bigint, click_count bigint"
)
AD_SLIDE_COUNT = columns("date string, slide_start timestamp, ad_id bigint, click_count bigint")


def as_schema(df, schema: StructType):
    """``df`` with exactly the columns and types of ``schema``, in its order."""
    return df.select(*[df[f.name].cast(f.dataType) for f in schema.fields])
