"""Sources, sinks, whole jobs, and the shape of the plans."""

import pytest
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.operators import ad_stats, area_products, sampling, sessions, upserts
from clickloom.plans.area_job import run_area_job
from clickloom.plans.page_job import run_page_job
from clickloom.plans.session_job import run_session_job
from clickloom.sources import tables, workspace
from clickloom.sources.tasks import parse_task_params, read_task


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tasks(spark):
    rows = [
        (1, '{"startDate":["2024-01-01"],"endDate":["2024-01-02"],"sex":["male"],'
            '"startAge":["20"],"endAge":["40"],"targetPageFlow":["1,2,3"]}'),
        (2, '{"startDate":[],"startAge":["x"]}'),
        (3, "no json"),
        (5, '{"sex":[""],"keywords":[" "],"startDate":[""],"endDate":[""],"professionals":["a"]}'),
        (4, '{"startDate":["2024-01-01"],"endDate":["2024-01-02"]}'),
    ]
    data = [(i, None, None, None, None, None, None, p) for i, p in rows]
    return spark.createDataFrame(data, schemas.TASK)


def test_task_parameters(tasks):
    task = read_task(tasks, 1)
    assert (task.start_date, task.end_date, task.start_age, task.sex) == ("2024-01-01", "2024-01-02", 20, "male")
    assert task.cities is None and task.target_page_flow == "1,2,3"
    blank = read_task(tasks, 5)
    assert (blank.sex, blank.keywords, blank.start_date, blank.professionals) == (None, None, None, "a")
    assert read_task(tasks, 2).start_date is None and read_task(tasks, 2).start_age is None
    assert parse_task_params(tasks).count() == 5
    with pytest.raises(LookupError, match="no task with id 9"):
        read_task(tasks, 9)


def test_schemas_hold_rows_given_in_code(spark):
    df = spark.createDataFrame([(1, "Rome", "South")], schemas.CITY_INFO)
    assert df.schema == schemas.CITY_INFO and df.head()["area"] == "South"


def test_sql_views_and_preview(spark):
    tables.publish_view(spark.range(20).toDF("n"), "numbers_of_test")
    shown = spark.sql("SELECT n FROM global_temp.numbers_of_test WHERE n > 4")
    assert shown.count() == 15
    assert len(shown.take(10)) == 10 and shown.limit(3).count() == 3


def test_append_and_partition_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("2024-01-01", "P", 1, 5), ("2024-01-02", "P", 1, 6)]
    df = spark.createDataFrame(rows, schemas.AD_PROVINCE_TOP3)
    tables.append_parquet(df, path, schemas.AD_PROVINCE_TOP3, ("date",))
    tables.append_parquet(df.limit(1), path, schemas.AD_PROVINCE_TOP3, ("date",))
    assert tables.read_parquet(spark, path).count() == 3
    new = spark.createDataFrame([("2024-01-01", "Q", 2, 7)], schemas.AD_PROVINCE_TOP3)
    tables.replace_partitions(new, path, schemas.AD_PROVINCE_TOP3, ("date",))
    got = tables.read_parquet(spark, path, schemas.AD_PROVINCE_TOP3).select(df.columns).collect()
    assert sorted(tuple(r) for r in got) == [("2024-01-01", "Q", 2, 7), ("2024-01-02", "P", 1, 6)]


def test_jdbc_options():
    got = tables.jdbc_options("jdbc:x", "ad_stat", user="u", fetchsize="1000")
    assert got == {"url": "jdbc:x", "dbtable": "ad_stat", "user": "u", "fetchsize": "1000"}


def test_work_folder_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    a, b = workspace.work_folder(spark, "x"), workspace.work_folder(spark, "x")
    assert a != b and a.startswith(f"{shared}/x-")


@pytest.fixture
def shop(spark, actions):
    rows = []
    for user in range(6):
        for step in range(5):
            rows.append(dict(
                date="2024-01-01", user_id=user, session_id=f"s{user}", page_id=1 + step % 3,
                action_time=f"2024-01-01 {8 + user}:0{step}:00", city_id=user % 2,
                click_category_id=step if step < 3 else None,
                click_product_id=step if step < 3 else None,
                order_category_ids="1,2" if step == 3 else None,
                pay_category_ids="2" if step == 4 else None))
    users = [(u, "n", "n", 15 + 5 * u, "cook", "Rome", "male" if u % 2 else "female") for u in range(6)]
    return (
        actions(rows),
        spark.createDataFrame(users, schemas.USER_INFO),
        spark.createDataFrame([(0, "Rome", "West North"), (1, "Oslo", "Moon")], schemas.CITY_INFO),
        spark.createDataFrame([(p, f"p{p}", '{"product_status":0}') for p in range(3)], schemas.PRODUCT_INFO),
    )


def test_session_job(spark, tasks, shop, tmp_path):
    actions, users, _, _ = shop
    out = str(tmp_path)
    run_session_job(spark, tasks, actions, users, 1, out)

    run_session_job(spark, tasks, actions, users, 1, out)

    def read(name):
        return [r.asDict() for r in spark.read.parquet(f"{out}/{name}").collect()]

    stats = {r["stat"]: r["value"] for r in read("session_stat")}
    # Of ages 20, 30 and 40 the men are users 1, 3 and 5.
    assert stats["session_count"] == 3 and stats["step_4_6"] == 3 and stats["visit_3m_10m"] == 3
    sample = read("session_random_extract")
    assert sorted(r["session_id"] for r in sample) == ["s1", "s3", "s5"]
    assert {r["task_id"] for r in sample} == {1}
    detail = tables.read_results(spark, f"{out}/session_detail", schemas.SESSION_DETAIL)
    assert detail.schema == schemas.SESSION_DETAIL and detail.count() == 15
    top = {r["category_id"]: (r["click_count"], r["order_count"], r["pay_count"]) for r in read("top10_category")}
    assert top == {0: (3, 0, 0), 1: (3, 3, 0), 2: (3, 3, 3)}


def test_page_job(spark, tasks, shop, tmp_path):
    for slice_rows in (1_000_000, 1):
        run_page_job(tasks, shop[0], 1, str(tmp_path), slice_rows)
    got = tables.read_results(
        spark, f"{tmp_path}/page_split_convert_rate", schemas.PAGE_SPLIT_CONVERT_RATE)
    assert [tuple(r) for r in got.collect()] == [(1, "1_2=1.0|2_3=0.5")]
    with pytest.raises(ValueError):
        run_page_job(tasks, shop[0], 4, str(tmp_path))


def test_area_job(spark, tasks, shop, tmp_path):
    actions, _, cities, products = shop
    for _ in range(2):
        run_area_job(tasks, actions, cities, products, 4, str(tmp_path))
    got = tables.read_results(
        spark, f"{tmp_path}/area_top3_product", schemas.AREA_TOP3_PRODUCT)
    assert got.schema == schemas.AREA_TOP3_PRODUCT
    assert {(r["area"], r["area_level"], r["click_count"]) for r in got.collect()} == {
        ("West North", "C Level", 3), ("Moon", "D Level", 3)}
    assert got.count() == 6


def test_small_dimension_is_broadcast_and_a_large_one_is_not(spark, tmp_path):
    path = str(tmp_path / "dim")
    spark.range(1000).selectExpr("id city_id", "'n' city_name", "'a' area").write.parquet(path)
    cities = spark.read.parquet(path)
    clicks = spark.range(10).selectExpr("id city_id", "id click_product_id")
    assert "BroadcastHashJoin" in _plan(area_products.click_product_basic(clicks, cities))
    hinted = tables.broadcast_if_small(cities, limit=10)
    assert hinted is cities and tables.estimated_bytes(cities) > 10
    exploded = cities.selectExpr("city_id", "explode(sequence(1, 1000)) as n")
    assert tables.broadcast_if_small(exploded, limit=1 << 30) is exploded


def test_date_and_column_selection_reach_the_scan(spark, tmp_path, shop, capsys):
    path = str(tmp_path / "actions")
    shop[0].write.parquet(path)
    area_products.click_actions(spark.read.parquet(path), "2024-01-01", "2024-01-02").explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(date,2024-01-01)" in plan and "LessThanOrEqual(date,2024-01-02)" in plan
    assert "ReadSchema: struct<date:string,click_product_id:bigint,city_id:bigint>" in plan


def test_rank_limits_rows_before_the_shuffle(spark):
    full = spark.range(100).selectExpr(
        "cast(id % 3 as string) area", "id product_id", "id click_count", "'' city_infos", "'' product_name", "'' product_status")
    assert _plan(area_products.top_products_per_area(full)).count("WindowGroupLimit") == 2


def test_sample_ranks_inside_buckets_of_an_hour(spark):
    some = spark.range(1000).selectExpr(
        "cast(id as string) session_id", "concat('2024-01-0', id % 3, ' 00:00:00') start_time", "'' search_keywords", "'' click_category_ids")
    for total in (100, 5000):
        ranks = [x for x in _plan(sampling.random_extract(some, 1, total)).splitlines() if "row_number" in x]
        assert ranks and all("bucket" in x for x in ranks)
    assert sampling.random_extract(some, 1, 600).count() == 600
    assert sampling.random_extract(some, 1, 5000).count() == 1000


@pytest.fixture
def only_skewed_shuffle_joins(spark):
    """No broadcasts, and thresholds at which a third of 40000 rows counts as skew."""
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _a_third_is_one_key(spark, tmp_path, key, hot, schema, **values):
    rows = spark.range(0, 40000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, hot).otherwise(F.col("id")).alias(key),
        *[v.alias(n) for n, v in values.items()])
    full = rows.select(*[
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])
    full.write.parquet(str(tmp_path / "rows"))
    return spark.read.parquet(str(tmp_path / "rows"))


def test_hot_session_is_split_at_run_time(spark, tmp_path, only_skewed_shuffle_joins):
    actions = _a_third_is_one_key(
        spark, tmp_path, "session_id", -1, schemas.USER_VISIT_ACTION,
        page_id=F.col("id"), action_time=F.lit("2024-01-01 10:00:00"))
    details = sessions.session_details(sessions.aggregate_sessions(actions), actions)
    assert len(details.collect()) == 40000
    assert "skew=true" in _plan(details)


def test_hot_user_is_split_at_run_time(spark, tmp_path, only_skewed_shuffle_joins):
    clicks = _a_third_is_one_key(
        spark, tmp_path, "user_id", -1, schemas.AD_CLICK,
        ts=F.timestamp_seconds("id"), ad_id=F.col("id"), date=F.lit("d"))
    listed = ad_stats.users_over_threshold(
        spark.range(1000).selectExpr("id * 3 + 1 user_id", "100L click_count"))
    kept = ad_stats.without_blacklisted(clicks, listed)
    assert len(kept.collect()) == 39000
    assert "skew=true" in _plan(kept)


def test_hot_group_is_split_at_run_time(spark, tmp_path, only_skewed_shuffle_joins):
    target = _a_third_is_one_key(
        spark, tmp_path, "date", -1, schemas.AD_PROVINCE_TOP3, ad_id=F.col("id"), click_count=F.col("id"))
    source = spark.createDataFrame([("1", "P", 1, 1), ("1", "P", 2, 1)], schemas.AD_PROVINCE_TOP3)
    replaced = upserts.replace_group(target, source, ["date"])
    assert len(replaced.collect()) == 40001
    assert "skew=true" in _plan(replaced)
