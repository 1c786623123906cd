"""Bucketed tables: what an update and a join read and move."""

import re

import pytest
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.operators import ad_stats, sessions, upserts
from clickloom.schemas import USER_VISIT_ACTION
from clickloom.sources import bucketed


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def counts(spark, tmp_path):
    name = "counts_" + re.sub(r"\W", "", tmp_path.name)
    bucketed.create_bucketed(spark, name, schemas.AD_USER_CLICK_COUNT, ["user_id", "ad_id"], 4, str(tmp_path / "t"))
    yield name
    spark.sql(f"DROP TABLE {name}")


def _counts(spark, rows):
    return spark.createDataFrame(rows, schemas.AD_USER_CLICK_COUNT)


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_added_counts_equal_the_plain_upsert(spark, counts):
    stored = [(f"2024-01-0{d}", u, a, 10 * d + u) for d in (1, 2, 3) for u in range(20) for a in (1, 2)]
    change = [("2024-01-02", u, 2, 1) for u in range(10, 30)] + [("2024-01-04", 1, 1, 5), ("2024-01-04", 1, 1, 6)]
    names = schemas.AD_USER_CLICK_COUNT.names
    target, delta = _counts(spark, stored), _counts(spark, change)
    bucketed.land(target, counts)
    expected = _rows(upserts.upsert_add(target, delta, ad_stats.USER_AD_KEYS).select(names))
    bucketed.add_counts(spark, counts, delta)
    assert _rows(spark.table(counts).select(names)) == expected
    bucketed.add_counts(spark, counts, delta.where("false"))
    assert _rows(spark.table(counts).select(names)) == expected


def test_an_update_moves_and_reads_no_more_than_it_must(spark, counts, tmp_path):
    stored = [(f"2024-01-0{d}", u, 1, 1) for d in range(1, 8) for u in range(50)]
    bucketed.land(_counts(spark, stored), counts)
    # One file for each day and bucket.
    assert all(len(list(p.glob("*.parquet"))) == 4 for p in (tmp_path / "t").glob("date=*"))
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("date=*/*.parquet")}
    delta = _counts(spark, [("2024-01-03", 7, 1, 1)])
    changed = bucketed.added_counts(spark, counts, delta)
    plan = _plan(changed)
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "PartitionFilters" in scan and "2024-01-03" in scan and "Bucketed: true" in scan
    # The one Exchange besides that of the delta's own sum would be on the table: there is none.
    side = plan[plan.index("FileScan parquet") - 400 : plan.index("FileScan parquet")]
    assert "Exchange" not in side
    inputs = {re.search(r"date=([\d-]+)", f)[1] for f in bucketed.of_days(spark, counts, "2024-01-03", "2024-01-03").inputFiles()}
    assert inputs == {"2024-01-03"}
    bucketed.add_counts(spark, counts, delta)
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("date=*/*.parquet")}
    kept = {p for p in before if "date=2024-01-03" not in str(p)}
    assert kept == {p for p in before if after.get(p) == before[p]}


def test_null_keys_are_an_error(spark, counts):
    with pytest.raises(Exception, match="a count without user_id"):
        bucketed.add_counts(spark, counts, _counts(spark, [("2024-01-03", None, 1, 1)]))


def test_sessions_and_details_of_landed_actions_move_no_actions(spark, actions, tmp_path):
    rows = [
        {"date": f"2024-01-0{1 + s % 3}", "session_id": f"s{s}", "user_id": s, "page_id": p, "action_time": f"2024-01-0{1 + s % 3} 10:00:0{p}"}
        for s in range(30) for p in range(4)
    ]
    name = "landed_actions_test"
    bucketed.create_bucketed(spark, name, USER_VISIT_ACTION, ["session_id"], 4, str(tmp_path / "actions"))
    try:
        bucketed.land(actions(rows), name)
        landed = bucketed.of_days(spark, name, "2024-01-01", "2024-01-02")
        found = sessions.aggregate_sessions(landed)
        assert "Exchange" not in _plan(found)
        few = found.where(F.col("user_id") < 10)
        details = sessions.landed_session_details(few, landed)
        plan = _plan(details)
        assert "Exchange" not in plan and plan.count("Bucketed: true") == 2
        plain = actions([r for r in rows if r["date"] < "2024-01-03"])
        expected = sessions.session_details(sessions.aggregate_sessions(plain).where(F.col("user_id") < 10), plain)
        assert sorted(map(str, details.collect())) == sorted(map(str, expected.collect()))
    finally:
        spark.sql(f"DROP TABLE {name}")
