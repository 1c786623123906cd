"""Provided parquet tables as the canonical tables of :mod:`clickloom.schemas`.

Each adapter is a narrow projection, so unused columns never leave the scan. A date
range, where given, is tested on the stored time column so that the scan can skip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def provided(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _days(c: str, start: str | None, end: str | None) -> Column:
    test = F.lit(True)
    if start is not None:
        test = test & (F.col(c) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        test = test & (F.col(c) < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz"))
    return test


def user_visit_action(
    spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    k = F.col("k")
    product = F.col("event_id") % 200

    def on(kind: str, value: Column) -> Column:
        return F.when(F.col("event_type") == kind, value)

    def ids(factor: int) -> Column:
        return F.concat_ws(",", k.cast("string"), ((k * factor + 1) % 100).cast("string"))

    events = provided(spark, sf_dir, "events").where(_days("ts", start, end))
    events = events.withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    return events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        "user_id",
        F.concat_ws(
            "_", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")
        ).alias("session_id"),
        (k % 10).alias("page_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("action_time"),
        on("view", F.concat(F.lit("kw"), (k % 10).cast("string"))).alias("search_keyword"),
        on("click", k).alias("click_category_id"),
        on("click", product).alias("click_product_id"),
        on("purchase", ids(7)).alias("order_category_ids"),
        on("purchase", product.cast("string")).alias("order_product_ids"),
        on("signup", ids(3)).alias("pay_category_ids"),
        on("signup", product.cast("string")).alias("pay_product_ids"),
        (F.col("event_id") % 25).alias("city_id"),
    )


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = provided(spark, sf_dir, "customer")
    nation = provided(spark, sf_dir, "nation")
    joined = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
    return joined.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("username"),
        F.col("c_name").alias("name"),
        (18 + F.col("c_custkey") % 60).alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.col("n_name").alias("city"),
        F.when(F.col("c_custkey") % 2 == 0, "male").otherwise("female").alias("sex"),
    )


def city_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = provided(spark, sf_dir, "nation")
    region = provided(spark, sf_dir, "region")
    joined = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
    return joined.select(
        F.col("n_nationkey").cast("long").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("area"),
    )


def product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = (F.col("p_size") % 2).cast("string")
    return provided(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit('{"product_status":'), status, F.lit("}")).alias("extend_info"),
    )


def click_fact(
    spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """The large click table; an order is taken for a session."""
    lines = provided(spark, sf_dir, "lineitem").where(_days("l_shipdate", start, end))
    orders = provided(spark, sf_dir, "orders")
    customer = provided(spark, sf_dir, "customer")
    joined = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).join(
        customer, F.col("o_custkey") == customer["c_custkey"]
    )
    return joined.select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        F.col("l_orderkey").cast("string").alias("session_id"),
        F.col("c_nationkey").cast("long").alias("city_id"),
        F.col("l_partkey").alias("click_product_id"),
    )


def timed_ad_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines in ``value`` beside the time they are ordered by."""
    events = provided(spark, sf_dir, "events")
    customer = provided(spark, sf_dir, "customer")
    nation = provided(spark, sf_dir, "nation")
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    ad = F.get_json_object("props", "$.k").cast("long") % 5
    joined = events.join(customer, events["user_id"] == customer["c_custkey"]).join(
        nation, F.col("c_nationkey") == nation["n_nationkey"]
    )
    return joined.select(
        "ts",
        F.concat_ws(
            " ",
            millis.cast("string"),
            F.concat(F.lit("P"), F.col("n_regionkey").cast("string")),
            F.concat(F.lit("C"), F.col("n_nationkey").cast("string")),
            F.col("user_id").cast("string"),
            ad.cast("string"),
        ).alias("value"),
    )


def ad_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timed_ad_log(spark, sf_dir).select("value")


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One analysis task per customer, with parameters taken from the customer's row."""
    key = F.col("c_custkey")
    first_page = key % 7
    flow = F.concat_ws(",", *[(first_page + i).cast("string") for i in range(4)])
    age = 18 + key % 30

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{name}":["'), value, F.lit('"]'))

    start = F.date_add(F.lit("2024-01-01").cast("date"), (key % 25).cast("int"))
    parts = [
        field("startDate", start.cast("string")),
        field("endDate", F.date_add(start, 3).cast("string")),
        # Every third task leaves the age open.
        F.when(key % 3 != 0, field("startAge", age.cast("string"))),
        F.when(key % 3 != 0, field("endAge", (age + 20).cast("string"))),
        field("professionals", F.col("c_mktsegment")),
        field("targetPageFlow", flow),
    ]
    customer = provided(spark, sf_dir, "customer")
    return customer.select(
        key.alias("task_id"),
        F.col("c_name").alias("task_name"),
        *[F.lit(None).cast("string").alias(n) for n in ("create_time", "start_time", "finish_time")],
        F.lit("session").alias("task_type"),
        F.lit("new").alias("task_status"),
        F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("task_param"),
    )
