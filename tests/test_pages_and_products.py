"""Page flow and area products on hand-made rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickloom.operators import area_products, page_flow
from clickloom.schemas import CITY_INFO, PRODUCT_INFO


def _visits(actions, pages_by_session, start_hour=0):
    rows = []
    for session, visits in pages_by_session.items():
        for time, page in visits:
            rows.append(dict(session_id=session, page_id=page, action_time=time, date=time[:10]))
    return actions(rows)


def test_steps_follow_time_and_not_arrival(actions):
    df = _visits(actions, {"s": [("2024-01-01 10:00:00", 3), ("2024-01-01 9:00:00", 1),
                                 ("2024-01-01 9:30:00", 2)]})
    steps = sorted((r["page_id"], r["next_page"]) for r in page_flow.page_steps(df).collect())
    assert steps == [(1, 2), (2, 3)]


@pytest.mark.parametrize("slices", [1, 7, 30, 1000])
def test_steps_are_the_same_for_any_slice(actions, slices):
    rng = random.Random(3)
    data = {
        f"s{s}": [
            (f"2024-01-{rng.randint(1, 3):02d} {rng.randint(0, 4):02d}:{rng.randint(0, 2):02d}:00",
             rng.randint(0, 3))
            for _ in range(rng.randint(1, 60))
        ]
        for s in range(8)
    }
    expected = []
    for session, visits in data.items():
        ordered = [page for _, page in sorted(visits)]
        expected += [(session, a, b) for a, b in zip(ordered, ordered[1:])]
    got = page_flow.page_steps(_visits(actions, data), slices).collect()
    assert sorted(tuple(r) for r in got) == sorted(expected)


@pytest.mark.parametrize("slices", [1, 1000])
def test_a_null_page_is_a_step_of_its_own(actions, slices):
    df = _visits(actions, {
        "s": [("2024-01-01 10:00:00", 1), ("2024-01-01 10:00:01", None), ("2024-01-01 11:00:00", 2),
              ("2024-01-01 11:00:01", 3), ("2024-01-01 12:00:00", None)],
        None: [("2024-01-01 10:00:00", 1), ("2024-01-01 13:00:00", 2)],
        "": [("2024-01-01 11:30:00", 9)],
    })
    got = [tuple(r) for r in page_flow.page_steps(df, slices).collect()]
    assert sorted(got, key=str) == sorted(
        [("s", 1, None), ("s", None, 2), ("s", 2, 3), ("s", 3, None), (None, 1, 2)], key=str)
    pairs = page_flow.page_split_pairs(df, "1,2,3", slices).collect()
    assert sorted(r["page_split"] for r in pairs) == ["1_2", "2_3"]
    rates = page_flow.page_convert_rates(df, "1,2,3", slice_rows=slices).collect()
    assert [r["convert_rate"] for r in rates] == [0.5, 1.0]


def test_rates_sort_the_visits_once(actions, spark, tmp_path):
    path = str(tmp_path / "a")
    _visits(actions, {"s": [("2024-01-01 10:00:00", 1), ("2024-01-01 10:00:01", 2)]}).write.parquet(path)
    plans = {}
    for slice_rows in (1, 2):
        rates = page_flow.page_convert_rates(spark.read.parquet(path), "1,2", slice_rows=slice_rows)
        rates.collect()
        plan = rates._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        plans[slice_rows] = plan.count("Window [lead"), plan.count("FileScan"), "ReusedExchange" in plan
    # A session is one window; where it is cut, another places the first pages of its parts.
    assert plans == {2: (1, 1, False), 1: (2, 2, True)}


def test_an_hour_of_one_session_is_spread_over_tasks(actions, spark):
    rng = random.Random(5)
    # Nine of ten rows in one session and hour, half of those within one second.
    hot = [(f"2024-01-01 10:{rng.randint(0, 59):02d}:{rng.randint(0, 59):02d}", rng.randint(0, 9)) for _ in range(1000)]
    hot += [("2024-01-01 10:30:00", rng.randint(0, 40)) for _ in range(1000)]
    data = {"hot": hot, **{f"s{s}": [(f"2024-01-01 11:00:0{i}", i) for i in range(5)] for s in range(40)}}
    expected = []
    for session, visits in data.items():
        pages = [page for _, page in sorted(visits)]
        expected += [(session, a, b) for a, b in zip(pages, pages[1:])]
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        steps = page_flow.page_steps(_visits(actions, data), 100)
        got = steps.withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(tuple(r)[:3] for r in got) == sorted(expected)
    tasks = Counter(r["task"] for r in got if r["session_id"] == "hot")
    assert len(tasks) >= 12 and max(tasks.values()) < 600


def test_rates_along_the_flow(actions):
    t = "2024-01-01 0{}:00:00".format
    df = _visits(actions, {
        "a": [(t(1), 1), (t(2), 2), (t(3), 3)],
        "b": [(t(1), 1), (t(2), 2)],
        "c": [(t(1), 1), (t(2), 9), (t(3), 2)],
    })
    assert sorted(tuple(r) for r in page_flow.page_split_pv(df, "1,2,3").collect()) == [("1_2", 2), ("2_3", 1)]
    assert tuple(page_flow.start_page_pv(df, "1,2,3").head()) == (1, 3)
    rates = page_flow.page_convert_rates(df, "1,2,3,4,5")
    assert [tuple(r) for r in rates.orderBy("idx").collect()] == [
        (0, "1_2", 0.67), (1, "2_3", 0.5), (2, "3_4", 0.0), (3, "4_5", None)]
    packed = page_flow.pack_rates(rates, 8).collect()
    assert [tuple(r) for r in packed] == [(8, "1_2=0.67|2_3=0.5|3_4=0.0|4_5=null")]


def test_rates_without_any_view_are_undefined(actions):
    df = _visits(actions, {"a": [("2024-01-01 01:00:00", 9)]})
    got = page_flow.page_convert_rates(df, "1,2,3").orderBy("idx").collect()
    assert [r["convert_rate"] for r in got] == [None, None]
    with pytest.raises(ValueError):
        page_flow.page_convert_rates(df, "1")


def test_flow_pairs_of_tasks(spark):
    params = spark.createDataFrame([(1, "4,5,6"), (2, "4"), (3, None)], "task_id long, target_page_flow string")
    got = sorted(tuple(r) for r in page_flow.task_flow_pairs(params).collect())
    assert got == [(1, 0, "4_5"), (1, 1, "5_6")]


@pytest.fixture
def shop(spark, actions):
    cities = spark.createDataFrame(
        [(1, "A", "China North"), (11, "A", "China North"), (2, "B", "Moon")], CITY_INFO)
    products = spark.createDataFrame(
        [(p, f"p{p}", '{"product_status":%d}' % (p % 2)) for p in range(1, 6)], PRODUCT_INFO)
    clicks = [(1, 1)] * 3 + [(11, 1)] + [(1, 2)] * 4 + [(11, 3)] * 9 + [(1, 4)] * 2 + [(2, 5)]
    clicks += [(99, 1), (1, 77)]
    rows = [dict(date="2024-01-02", session_id=str(i), city_id=c, click_product_id=p)
            for i, (c, p) in enumerate(clicks)]
    rows += [dict(date="2024-01-01", city_id=2, click_product_id=1),
             dict(date="2024-01-04", city_id=2, click_product_id=1),
             dict(date="2024-01-02", city_id=2, search_keyword="x")]
    return actions(rows), cities, products


def test_top_products_per_area(shop):
    top = area_products.area_top_products(*shop, "2024-01-02", "2024-01-03").collect()
    assert sorted(tuple(r) for r in top) == [
        ("China North", "A Level", 1, 4, "11:A,1:A", "p1", "第三方商品"),
        ("China North", "A Level", 2, 4, "1:A", "p2", "自营商品"),
        ("China North", "A Level", 3, 9, "11:A", "p3", "第三方商品"),
        ("Moon", "D Level", 5, 1, "2:B", "p5", "第三方商品"),
    ]


@pytest.mark.parametrize("n", [1, 4, 30])
def test_salted_area_counts_equal_plain_counts(shop, n):
    actions, cities, _ = shop
    clicks = actions.where("click_product_id is not null")
    plain = area_products.area_product_counts(clicks, cities)
    basic = area_products.click_product_basic(clicks, cities, "session_id")
    salted = area_products.area_product_counts_salted(basic, ["session_id"], n)
    columns = ["area", "product_id", "click_count", "city_infos"]
    assert sorted(plain.select(columns).collect()) == sorted(salted.select(columns).collect())
