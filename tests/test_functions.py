"""Column helpers at their edges."""

import datetime

import pytest
from pyspark.sql import functions as F

from clickloom.functions import aggregates, labels, numbers, predicates, salting, strings, times
from clickloom.functions.sql_functions import register_sql_functions


def test_times_read_padded_and_unpadded_hours(one):
    got = one([times.before("a", "b"), times.after("a", "b"), times.minus_seconds("a", "b")],
              a="2024-01-01 9:00:00", b="2024-01-01 10:00:05")
    assert got == (True, False, -3605)


@pytest.mark.parametrize("bad", [None, "", "2024-01-01", "nine"])
def test_unreadable_times_compare_false_and_differ_by_zero(one, bad):
    got = one([times.before("a", "b"), times.after("a", "b"), times.minus_seconds("a", "b"),
               times.parse_time("a")], a=bad, b="2024-01-01 10:00:05")
    assert got == (False, False, 0, None)


def test_time_keys(one):
    ts = times.parse_time("a")
    got = one([times.format_date(ts), times.format_time(ts), times.format_date_key(ts),
               times.format_minute_key(ts), times.date_hour(ts), *times.minute_key_parts("k"),
               times.format_date(times.parse_date_key("d"))],
              a="2024-03-05 7:08:09", k="202403050708", d="20240305")
    assert got == ("2024-03-05", "2024-03-05 07:08:09", "20240305", "202403050708",
                   "2024-03-05_07", "2024-03-05", "07", "08", "2024-03-05")
    assert one([times.parse_date_key("d")], d="2024x") == (None,)


def test_today_and_yesterday(one):
    now, before = one([times.today(), times.yesterday()])
    day = datetime.date.fromisoformat
    assert day(now) - day(before) == datetime.timedelta(days=1)


def test_emptiness_commas_and_padding(one):
    assert one([strings.is_empty("a"), strings.is_not_empty("a")], a=None) == (True, False)
    assert one([strings.is_empty("a"), strings.is_not_empty("a")], a="") == (True, False)
    assert one([strings.is_empty("a"), strings.is_not_empty("a")], a="x") == (False, True)
    assert one([strings.trim_comma("a")], a=",1,2,") == ("1,2",)
    assert one([strings.trim_comma("a")], a=",,1") == (",1",)
    assert one([strings.zero_pad2("a"), strings.zero_pad2("b")], a="7", b="17") == ("07", "17")


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("age=7|sex=male", "7"),
        ("sex=male| age = 7 |x=1", "7"),
        ("page=3|age=7", "7"),
        ("age=|age=8", "8"),
        ("age=1=2|age=9", "9"),
        ("age=1|age=2", "1"),
        ("age=new york|x=1", "new york"),
        ("sex=male", None),
        ("", None),
        (None, None),
    ],
)
def test_packed_get(one, text, value):
    assert one([strings.packed_get("a", "age")], a=text) == (value,)


@pytest.mark.parametrize(
    ("text", "changed"),
    [
        ("a=1|b=2|c=3", "a=1|b=9|c=3"),
        ("a=1| b = 2", "a=1|b=9"),
        ("a=1|bb=2", "a=1|bb=2"),
        ("b", "b=9"),
        ("a=1|b=2|", "a=1|b=9"),
        (None, None),
    ],
)
def test_packed_set(one, text, changed):
    assert one([strings.packed_set("a", "b", "9")], a=text) == (changed,)


def test_packed_set_then_get_returns_what_was_set(one):
    text = strings.packed_set("a", "k2", F.col("v"))
    assert one([strings.packed_get(text, f"k{i}") for i in (1, 2, 3)],
               a="k1=x|k2=y|k3=z", v="new") == ("x", "new", "z")


def test_json_field_and_label(one):
    assert one([strings.json_field("a", "k"), strings.json_field("a", "x")], a='{"k": 4}') == ("4", None)
    assert one([strings.json_field("a", "k")], a="{bad") == (None,)
    assert one([strings.concat_long_string("a", "b")], a="12", b="Rome") == ("12:Rome",)


def test_flow_pairs(one):
    assert one([strings.flow_pairs("a")], a="1,2,3") == (["1_2", "2_3"],)
    assert one([strings.flow_pairs("a")], a="1") == ([],)


def test_comma_longs_keep_only_numbers(one):
    assert one([strings.comma_longs("a")], a="1, 22,x,") == ([1, 22, None, None],)


def test_predicates_pass_without_parameter_and_fail_on_null(spark):
    df = spark.createDataFrame([(5, "a,b", "m"), (None, None, None)], "n long, l string, s string")
    assert df.where(predicates.in_range("n", None, 9)).count() == 2
    assert df.where(predicates.in_range("n", 5, 5)).count() == 1
    assert df.where(predicates.any_of("l", None)).count() == 2
    assert df.where(predicates.any_of("l", "b,z")).count() == 1
    assert df.where(predicates.any_of("l", "ab")).count() == 0
    assert df.where(predicates.equals("s", None)).count() == 2
    assert df.where(predicates.equals("s", "m")).count() == 1


def test_bucket_edges(spark):
    seconds = {0: None, 1: "1s_3s", 3: "1s_3s", 4: "4s_6s", 6: "4s_6s", 7: "7s_9s", 9: "7s_9s",
               10: "10s_30s", 30: "10s_30s", 31: "30s_60s", 60: "30s_60s", 61: "1m_3m",
               180: "1m_3m", 181: "3m_10m", 600: "3m_10m", 601: "10m_30m", 1800: "10m_30m",
               1801: "30m"}
    steps = {0: None, 1: "1_3", 3: "1_3", 4: "4_6", 6: "4_6", 7: "7_9", 9: "7_9", 10: "10_30",
             30: "10_30", 31: "30_60", 60: "30_60", 61: "60"}
    for expected, label in ((seconds, labels.visit_length_bucket), (steps, labels.step_length_bucket)):
        df = spark.createDataFrame([(n,) for n in expected], "n long")
        assert {r[0]: r[1] for r in df.select("n", label("n")).collect()} == expected


def test_area_level_and_product_status(spark):
    areas = ["China North", "China Middle", "West South", "Elsewhere", None]
    df = spark.createDataFrame([(a,) for a in areas], "area string")
    got = [r[0] for r in df.select(labels.area_level("area")).collect()]
    assert got == ["A Level", "B Level", "C Level", "D Level", "D Level"]
    info = spark.createDataFrame([('{"product_status":0}',), ('{"product_status":1}',), (None,)], "j string")
    got = [r[0] for r in info.select(labels.product_status("j")).collect()]
    assert got == [labels.SELF_OPERATED, labels.THIRD_PARTY, labels.THIRD_PARTY]


def test_prefix_comes_off_whole_and_only_once(spark):
    df = spark.range(200).select("id", F.lit("4_a_b").alias("t"))
    salted = df.select(salting.random_prefix("t", 10, "id").alias("s"))
    assert salted.distinct().count() == 10
    assert [r[0] for r in salted.select(salting.remove_random_prefix("s")).distinct().collect()] == ["4_a_b"]
    with pytest.raises(ValueError):
        salting.salt(10)


def test_group_concat_distinct_is_no_substring_test(spark):
    df = spark.createDataFrame([("11:A",), ("1:A",), ("1:A",), (None,)], "c string")
    assert df.agg(aggregates.group_concat_distinct("c")).head()[0] == "11:A,1:A"
    numbers = spark.createDataFrame([(10,), (9,), (None,)], "c long")
    assert numbers.agg(aggregates.group_concat_distinct("c")).head()[0] == "9,10"


def test_sql_functions(spark):
    register_sql_functions(spark)
    row = spark.sql(
        """SELECT concat_long_string(1, 'Rome', ':'), get_json_field('{"k": 2}', 'k'),
           remove_random_prefix(random_prefix('a_b', 10, 123)),
           join_sorted(collect_set(c), ',') FROM VALUES ('b'), ('a'), ('b') t(c)"""
    ).head()
    assert tuple(row) == ("1:Rome", "2", "a_b", "a,b")


def test_rounding_is_half_up_and_ratio_over_zero_is_null(spark):
    df = spark.createDataFrame([(0.125, 0.375, -0.125)], "a double, b double, c double")
    got = df.select(*[numbers.format_double(c, 2) for c in "abc"], numbers.ratio("a", F.lit(0))).head()
    assert tuple(got) == (0.13, 0.38, -0.13, None)
