"""Sets of users as bitmaps against plain sets and the anti join."""

import pytest

from clickloom.operators import ad_stats
from clickloom.operators import user_bitmaps as ops

IDS = [0, 1, 7, 8, 32767, 32768, 32769, 65536, 65537, -1, -32768, -32769, 1 << 40, -(1 << 40)]


def _users(spark, rows):
    return spark.createDataFrame(rows, "date string, user_id long")


def test_bitmaps_give_back_their_users(spark):
    rows = [(f"d{n % 2}", u) for n, u in enumerate(IDS)] + [("d0", IDS[0]), ("d0", None), ("d2", None)]
    sets = ops.user_bitmaps(_users(spark, rows), "date")
    assert sorted(tuple(r) for r in ops.bitmap_users(sets, "date").collect()) == sorted(
        {r for r in rows if r[1] is not None}
    )
    merged = ops.merged_bitmaps(sets.unionByName(sets))
    assert sorted(r.user_id for r in ops.bitmap_users(merged).collect()) == sorted(IDS)
    sizes = {r.date: r.users for r in ops.bitmap_sizes(sets, "date").collect()}
    assert sizes == {"d0": 7, "d1": 7}


@pytest.mark.parametrize("limit", [1 << 24, 4096])
def test_members_are_those_of_the_anti_join(spark, limit):
    near = [u + d for u in IDS for d in (-2, -1, 0, 1, 2)]
    clicks = _users(spark, [("d", u) for u in near] + [("d", None)] * 2)
    listed = _users(spark, [("d", u) for u in IDS] + [("e", 5), ("e", None)])
    got = ops.without_members(clicks, ops.user_bitmaps(listed, "date"), limit)
    assert got.columns == clicks.columns
    want = ad_stats.without_blacklisted(clicks, listed)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert ops.without_members(clicks, ops.user_bitmaps(listed.limit(0)), limit).count() == clicks.count()


def test_clicks_are_not_moved(spark, tmp_path):
    path = str(tmp_path / "clicks")
    _users(spark, [("d", u) for u in range(1000)]).write.parquet(path)
    listed = ops.user_bitmaps(_users(spark, [("d", u) for u in range(0, 1000, 3)]))
    left = ops.without_members(spark.read.parquet(path), listed)
    assert left.count() == 666
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
