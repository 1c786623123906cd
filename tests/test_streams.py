"""Streams against their batch forms, in one file or many, with restarts and replays."""

import os
import time

import pytest
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.operators import ad_stats
from clickloom.plans.ad_job import start_ad_job
from clickloom.sources.ad_log import file_lines, parse_ad_log
from clickloom.streaming import ad_streams
from clickloom.streaming.tables import BatchTable

NOW = {"availableNow": True}
MINUTE = 60_000


def _drop(folder, number, lines):
    """A file whose age puts it at ``number`` in the reading order."""
    folder.mkdir(exist_ok=True)
    path = folder / f"part-{number}.txt"
    path.write_text("".join(f"{line}\n" for line in lines))
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def _log(n=240):
    """Clicks in time order over two days; user 1 makes a third of them."""
    lines = []
    for i in range(n):
        user = 1 if i % 3 == 0 else 2 + i % 17
        lines.append(f"{i * 12 * MINUTE} P{i % 3} C{i % 4} {user} {i * i % 5}")
    return lines


def _files(folder, lines, n):
    size = -(-len(lines) // n)
    for i in range(n):
        _drop(folder, i, lines[i * size : (i + 1) * size])


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _batch_clicks(spark, lines):
    return parse_ad_log(spark.createDataFrame([(x,) for x in lines], "value string"))


def _tables(spark, tmp_path, **more):
    return ad_streams.AdTables(spark, str(tmp_path / "tables"), **more)


def _forget_last_commit(tables, query):
    """As if the last micro-batch had been cut off before it was marked as done."""
    commits = f"{tables.checkpoint(query)}/commits"
    last = max((n for n in os.listdir(commits) if n.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        if os.path.exists(f"{commits}/{name}"):
            os.remove(f"{commits}/{name}")


@pytest.mark.parametrize(("files", "fold_every"), [(1, 100), (4, 2)])
def test_streams_equal_batch(spark, tmp_path, files, fold_every):
    lines = _log()
    _files(tmp_path / "in", lines, files)
    tables = _tables(spark, tmp_path, fold_every=fold_every)
    source = file_lines(spark, str(tmp_path / "in"), 1)
    clicks = _batch_clicks(spark, lines)

    ad_streams.start_dynamic_blacklist(source, tables, 1000, NOW).awaitTermination()
    assert _rows(tables.accepted.table()) == _rows(clicks)
    assert _rows(tables.user_click_count.table()) == _rows(
        ad_stats.daily_user_ad_clicks(clicks).select(schemas.AD_USER_CLICK_COUNT.names))
    assert tables.blacklist.table().count() == tables.late.table().count() == 0

    accepted = tables.accepted.stream(files_at_once=8)
    ad_streams.start_ad_stat(accepted, tables, trigger=NOW).awaitTermination()
    stat = ad_stats.ad_stat(clicks)
    assert _rows(tables.stat.table()) == _rows(stat)

    ad_streams.start_province_top(accepted, tables, trigger=NOW, slots=3).awaitTermination()
    counts = ad_stats.province_ad_clicks(stat)
    assert _rows(tables.province_top3()) == _rows(ad_stats.province_top_ads(counts))
    assert _rows(tables.province_top3(1)) == _rows(ad_stats.province_top_ads(counts, 1))

    ad_streams.start_ad_click_trend(accepted, tables, trigger=NOW).awaitTermination()
    assert _rows(tables.trend.table()) == _rows(ad_stats.ad_click_trend(clicks))


@pytest.mark.parametrize("files", [1, 5])
def test_final_blacklist_equals_batch(spark, tmp_path, files):
    lines = _log()
    _files(tmp_path / "in", lines, files)
    tables = _tables(spark, tmp_path)
    source = file_lines(spark, str(tmp_path / "in"), 1)
    ad_streams.start_dynamic_blacklist(source, tables, 4, NOW).awaitTermination()
    expected = _rows(ad_stats.daily_blacklist(_batch_clicks(spark, lines), 4))
    assert expected and _rows(tables.blacklist.table()) == expected


def test_listed_user_is_filtered_from_the_next_batch_on(spark, tmp_path):
    _drop(tmp_path / "in", 0, ["0 P C 1 1", "1 P C 1 1", "2 P C 1 1", "3 P C 2 1", "broken"])
    _drop(tmp_path / "in", 1, ["4 P C 1 1", "5 P C 2 1"])
    _drop(tmp_path / "in", 2, ["6 P C 1 2", "7 P C 2 1", "8 P C 3 1"])
    tables = _tables(spark, tmp_path)
    source = file_lines(spark, str(tmp_path / "in"), 1)
    ad_streams.start_dynamic_blacklist(source, tables, 3, NOW).awaitTermination()
    by_user = {u: tables.accepted.table().where(F.col("user_id") == u).count() for u in (1, 2, 3)}
    assert by_user == {1: 3, 2: 3, 3: 1}
    assert _rows(tables.blacklist.table()) == [(1,), (2,)]
    assert _rows(tables.rejected.table()) == [("broken",)]


def test_lines_ahead_of_the_clock_are_kept_by_default(spark, tmp_path):
    ahead = f"{4_000_000_000_000} P C 2 1"
    _drop(tmp_path / "in", 0, ["0 P C 1 1", ahead, "broken"])
    tables = _tables(spark, tmp_path)
    source = file_lines(spark, str(tmp_path / "in"), 1)
    none = spark.createDataFrame([], "user_id long")
    ad_streams.start_blacklist_filter(source, lambda: none, tables, NOW).awaitTermination()
    ad_streams.start_dynamic_blacklist(source, tables, 3, NOW).awaitTermination()
    for table in (tables.passed_rejected(), tables.rejected.table()):
        assert _rows(table) == [(ahead,), ("broken",)]


def test_no_line_is_lost_at_the_bound_of_the_clock(spark, tmp_path):
    """Lines whose times pass the bound while the micro-batch runs, also when it is repeated."""
    bound = int(time.time() * 1000) + 3_600_000
    lines = [f"{bound + 50 * i} P C {i} 1" for i in range(-200, 400)]
    _drop(tmp_path / "in", 0, lines)
    tables = _tables(spark, tmp_path)
    none = spark.createDataFrame([], "user_id long")

    def run():
        source = file_lines(spark, str(tmp_path / "in"), 1)
        ad_streams.start_blacklist_filter(source, lambda: none, tables, NOW).awaitTermination()
        ad_streams.start_dynamic_blacklist(source, tables, 1000, NOW).awaitTermination()

    def found():
        pairs = [
            (tables.passed(), tables.passed_rejected()),
            (tables.accepted.table(), tables.rejected.table()),
        ]
        return [([r["user_id"] for r in a.collect()], _rows(b)) for a, b in pairs]

    run()
    first = found()
    for users, rejected in first:
        assert len(users) + len(rejected) == len(lines) and len(set(users)) == len(users)
        assert users and rejected
    for query in ("blacklist_filter", "dynamic_blacklist"):
        _forget_last_commit(tables, query)
    time.sleep(2)
    run()
    assert [(sorted(u), r) for u, r in found()] == [(sorted(u), r) for u, r in first]


def test_outside_blacklist_is_read_anew_for_each_batch(spark, tmp_path):
    for i in range(3):
        _drop(tmp_path / "in", i, ["0 P C 1 1", "0 P C 2 1"])
    listed = iter([[], [(1,)], [(1,), (2,)]])

    def read():
        return spark.createDataFrame(next(listed), "user_id long")

    tables = _tables(spark, tmp_path)
    source = file_lines(spark, str(tmp_path / "in"), 1)
    ad_streams.start_blacklist_filter(source, read, tables, NOW).awaitTermination()
    assert [r["user_id"] for r in tables.passed().orderBy("user_id").collect()] == [1, 2, 2]


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    lines = _log()
    folder = tmp_path / "in"
    tables = _tables(spark, tmp_path)

    def run():
        source = file_lines(spark, str(folder), 1)
        ad_streams.start_dynamic_blacklist(source, tables, 4, NOW).awaitTermination()
        ad_streams.start_ad_stat(tables.accepted.stream(), tables, trigger=NOW).awaitTermination()

    _drop(folder, 0, lines[:100])
    run()
    _drop(folder, 1, lines[100:150])
    _drop(folder, 2, lines[150:])
    run()
    run()
    expected = _rows(ad_stats.daily_blacklist(_batch_clicks(spark, lines), 4))
    assert _rows(tables.blacklist.table()) == expected
    assert _rows(tables.stat.table()) == _rows(ad_stats.ad_stat(tables.accepted.table()))


def test_expiring_counts_equal_batch_when_nothing_is_late(spark, tmp_path):
    lines = _log()
    _files(tmp_path / "in", lines, 4)
    tables = _tables(spark, tmp_path)
    clicks = parse_ad_log(file_lines(spark, str(tmp_path / "in"), 1))
    ad_streams.start_ad_stat(clicks, tables, late_after="1 day", trigger=NOW).awaitTermination()
    assert _rows(tables.stat.table()) == _rows(ad_stats.ad_stat(_batch_clicks(spark, lines)))


def _stat_table(spark, tmp_path, fold_every=100):
    keys = ["date", "province", "city", "ad_id"]
    largest = lambda log: log.groupBy(*keys).agg(F.max("click_count").alias("click_count"))
    return BatchTable(spark, str(tmp_path / "t"), schemas.AD_STAT, "date", largest, fold_every)


def test_repeated_batch_changes_nothing(spark, tmp_path):
    table = _stat_table(spark, tmp_path)

    def stat(*rows):
        return spark.createDataFrame(list(rows), schemas.AD_STAT)

    one, two = ("2024-01-01", "P", "C", 1, 3), ("2024-01-02", "P", "C", 1, 5)
    assert table.table().count() == 0
    table.write(stat(one), 0)
    table.write(stat(one), 0)
    assert _rows(table.table()) == [one] and table.log().count() == 1
    table.write(stat((*one[:4], 4), two), 1)
    table.write(stat((*one[:4], 4), two), 1)
    assert _rows(table.table()) == [(*one[:4], 4), two] and table.log().count() == 3
    table.write(stat(one), 0)
    assert _rows(table.table()) == [(*one[:4], 4), two]
    table.write(stat(one).where("false"), 2)
    assert _rows(table.table()) == [(*one[:4], 4), two]


def test_folds_drop_what_they_hold(spark, tmp_path):
    table = _stat_table(spark, tmp_path, fold_every=2)
    for n in range(5):
        rows = [(f"2024-01-0{1 + n // 2}", "P", "C", ad, 10 * n + ad) for ad in range(3)]
        table.write(spark.createDataFrame(rows, schemas.AD_STAT), n)
    expected = [(f"2024-01-0{1 + d}", "P", "C", ad, 10 * n + ad) for d, n in enumerate((1, 3, 4)) for ad in range(3)]
    assert _rows(table.table()) == expected
    # Two folds of one day each, and the last batch.
    assert sorted({r["batch_id"] for r in table.log().collect()}) == [-4, -2, 4]
    assert table.log().count() == 9


def test_counts_repeat_with_their_batch(spark, tmp_path):
    lines = _log(60)
    _files(tmp_path / "in", lines, 2)
    tables = _tables(spark, tmp_path)
    queries = {"ad_stat": ad_streams.start_ad_stat, "province_top": ad_streams.start_province_top,
               "ad_click_trend": ad_streams.start_ad_click_trend, "sliding_trend": ad_streams.start_sliding_trend}

    def run():
        for start in queries.values():
            clicks = parse_ad_log(file_lines(spark, str(tmp_path / "in"), 1))
            start(clicks, tables, trigger=NOW).awaitTermination()

    def found():
        shown = (tables.stat.table(), tables.province_top3(), tables.trend.table(), tables.slides.table())
        return [_rows(t) for t in shown]

    run()
    first = found()
    for query in queries:
        _forget_last_commit(tables, query)
    run()
    assert found() == first


def test_late_clicks_have_a_table(spark, tmp_path):
    hour = 60 * MINUTE
    times = [[10 * hour, 11 * hour], [50 * hour, 12 * hour], [13 * hour, 49 * hour + 1, 60 * hour], [48 * hour, 51 * hour, 59 * hour]]
    lines = [[f"{t} P C {n % 2} {n}" for n, t in enumerate(ts)] + ["broken"] for ts in times]
    for n, part in enumerate(lines):
        _drop(tmp_path / "in", n, part)
    tables = _tables(spark, tmp_path)
    source = file_lines(spark, str(tmp_path / "in"), 1)
    more = {"trigger": NOW, "late_after": "2 hours"}
    query = ad_streams.start_dynamic_blacklist(source, tables, 1000, **more)
    query.awaitTermination()

    def millis(table):
        return [r[0] for r in table.select(F.unix_millis("ts").alias("t")).orderBy("t").collect()]

    # Bounds before each file: none, 9, 48 and 58 hours.
    late = [13 * hour, 48 * hour, 51 * hour]
    assert millis(tables.late.table()) == late
    assert millis(tables.accepted.table()) == sorted(t for ts in times for t in ts if t not in late)
    assert tables.rejected.table().count() == 4
    # Days that can have no more clicks are out of the state.
    assert query.lastProgress["stateOperators"][0]["customMetrics"]

    clicks = tables.accepted.table()
    accepted = tables.accepted.stream(files_at_once=5)
    for start in (ad_streams.start_ad_stat, ad_streams.start_province_top,
                  ad_streams.start_ad_click_trend, ad_streams.start_sliding_trend):
        start(accepted, tables, **more).awaitTermination()
    stat = ad_stats.ad_stat(clicks)
    assert _rows(tables.stat.table()) == _rows(stat)
    assert _rows(tables.province_top3()) == _rows(ad_stats.province_top_ads(ad_stats.province_ad_clicks(stat)))
    assert _rows(tables.trend.table()) == _rows(ad_stats.ad_click_trend(clicks))
    assert _rows(tables.sliding_trend(600, 10)) == _rows(ad_stats.sliding_ad_trend(clicks, 600, 10))


def test_days_leave_the_state_of_users(spark, tmp_path):
    day = 24 * 60 * MINUTE
    for n in range(6):
        _drop(tmp_path / "in", n, [f"{n * day} P C {u} 1" for u in range(5)])
    state_rows = {}
    for late_after in (None, "1 hour"):
        tables = ad_streams.AdTables(spark, str(tmp_path / f"tables-{late_after is None}"))
        source = file_lines(spark, str(tmp_path / "in"), 1)
        query = ad_streams.start_dynamic_blacklist(source, tables, 1000, NOW, late_after=late_after)
        query.awaitTermination()
        last = [p for p in query.recentProgress if p["stateOperators"]][-1]
        state_rows[late_after] = last["stateOperators"][0]["numRowsTotal"]
        assert tables.accepted.table().count() == 30
    assert state_rows[None] == 30 > state_rows["1 hour"]


def test_whole_job_runs_on_its_default_trigger(spark, tmp_path):
    lines = _log(60)
    _files(tmp_path / "in", lines + ["broken"], 2)
    tables = _tables(spark, tmp_path)
    queries = start_ad_job(file_lines(spark, str(tmp_path / "in"), 1), tables, 1000)
    try:
        for query in queries:
            query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
    clicks = _batch_clicks(spark, lines)
    assert _rows(tables.stat.table()) == _rows(ad_stats.ad_stat(clicks))
    assert _rows(tables.trend.table()) == _rows(ad_stats.ad_click_trend(clicks))
    assert _rows(tables.rejected.table()) == [("broken",)]


def test_a_line_from_the_future_is_rejected_and_nothing_is_lost(spark, tmp_path):
    lines = _log(40)
    future = "4100000000000 P C 1 1"
    _drop(tmp_path / "in", 0, [*lines[:10], future])
    for n in (1, 2, 3):
        _drop(tmp_path / "in", n, lines[10 * n : 10 * n + 10])
    tables = _tables(spark, tmp_path)
    source = file_lines(spark, str(tmp_path / "in"), 1)
    ad_streams.start_dynamic_blacklist(source, tables, 1000, NOW).awaitTermination()
    assert tables.accepted.table().count() == 40
    assert _rows(tables.rejected.table()) == [(future,)]
    accepted = tables.accepted.stream(files_at_once=5)
    ad_streams.start_ad_click_trend(accepted, tables, trigger=NOW).awaitTermination()
    ad_streams.start_sliding_trend(accepted, tables, 1200, trigger=NOW).awaitTermination()
    clicks = _batch_clicks(spark, lines)
    assert _rows(tables.trend.table()) == _rows(ad_stats.ad_click_trend(clicks))
    assert _rows(tables.sliding_trend(3600, 1200)) == _rows(ad_stats.sliding_ad_trend(clicks, 3600, 1200))


def test_two_filters_on_the_same_tables_keep_their_rows(spark, tmp_path):
    _drop(tmp_path / "in", 0, ["0 P C 1 1", "1 P C 2 1", "2 P C 3 1"])
    tables = _tables(spark, tmp_path)
    source = file_lines(spark, str(tmp_path / "in"), 1)
    none = spark.createDataFrame([], "user_id long")
    ad_streams.start_dynamic_blacklist(source, tables, 1000, NOW).awaitTermination()
    ad_streams.start_blacklist_filter(source, lambda: none, tables, NOW).awaitTermination()
    assert tables.accepted.table().count() == tables.passed().count() == 3


@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai", "Europe/Berlin"])
def test_days_are_those_of_the_session_zone(spark, tmp_path, zone):
    # The night of 30 to 31 March 2024, when clocks change in Berlin, and the next one.
    start = 1711828800000 - 6 * 3_600_000
    lines = [f"{start + i * 40 * MINUTE} P C {i} 1" for i in range(60)]
    _files(tmp_path / "in", lines, 3)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        tables = _tables(spark, tmp_path)
        clicks = parse_ad_log(file_lines(spark, str(tmp_path / "in"), 1))
        ad_streams.start_ad_stat(clicks, tables, late_after="60 minutes", trigger=NOW).awaitTermination()
        assert _rows(tables.stat.table()) == _rows(ad_stats.ad_stat(_batch_clicks(spark, lines)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_sliding_windows_keep_one_row_of_state_per_slide(spark, tmp_path):
    lines = _log(40)
    _files(tmp_path / "in", lines, 3)
    tables = _tables(spark, tmp_path)
    clicks = parse_ad_log(file_lines(spark, str(tmp_path / "in"), 1))
    query = ad_streams.start_sliding_trend(clicks, tables, 10, trigger=NOW)
    query.awaitTermination()
    batch = _batch_clicks(spark, lines)
    # 60 minutes every 10 seconds: a click is in 360 windows, and in one row of state.
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == len(lines)
    assert _rows(tables.sliding_trend(3600, 10)) == _rows(ad_stats.sliding_ad_trend(batch, 3600, 10))
    day = ("1970-01-01", "1970-01-01")
    first = batch.where("date = '1970-01-01'")
    assert _rows(tables.sliding_trend(60, 10, day)) == _rows(ad_stats.sliding_ad_trend(first, 60, 10))


def test_filter_costs_few_state_entries_and_keeps_users_of_a_bucket_apart(spark, tmp_path):
    """Users share keys of state: an entry per bucket and day, none of a listed user, the results per user."""
    day = 24 * 60 * MINUTE
    files = [[f"{(n + d) * day + u} P{u % 2} C {u} {a}" for d in range(3) for u in range(40) for a in (1, 2000)]
             + 2 * [f"{(n + d) * day} P C {u} 1" for d in range(3) for u in range(10 * n, 10 * n + 5)]
             for n in (0, 1, 2)]
    for n, lines in enumerate(files):
        _drop(tmp_path / "in", n, lines)
    tables = _tables(spark, tmp_path)
    source = file_lines(spark, str(tmp_path / "in"), 1)
    query = ad_streams.start_dynamic_blacklist(source, tables, 4, NOW, buckets=2)
    query.awaitTermination()

    # The same by hand, user by user.
    counts, listed, accepted, recorded = {}, set(), [], {}
    for lines in files:
        now = [(x, f"1970-01-0{1 + int(x.split()[0]) // day}", *map(int, x.split()[3:])) for x in lines]
        now = [x for x in now if x[2] not in listed]
        accepted += [x[0] for x in now]
        for _, date, user, ad in now:
            recorded[date, user, ad] = counts[date, user, ad] = counts.get((date, user, ad), 0) + 1
        listed |= {user for (_, user, _), n in counts.items() if n >= 4}
        counts = {k: n for k, n in counts.items() if k[1] not in listed}
    assert 0 < len(listed) < 40
    assert _rows(tables.blacklist.table()) == [(u,) for u in sorted(listed)]
    clicks = _batch_clicks(spark, accepted).select(*schemas.AD_CLICK.names)
    assert _rows(tables.accepted.table()) == _rows(clicks)
    totals = tables.user_click_count.table().select("date", "user_id", "ad_id", "click_count")
    assert _rows(totals) == sorted((*k, n) for k, n in recorded.items())
    assert tables.rejected.table().count() == tables.late.table().count() == 0
    # Two lists of users, and at most two entries for each of the five days.
    last = [p for p in query.recentProgress if p["stateOperators"]][-1]
    assert last["stateOperators"][0]["numRowsTotal"] <= 2 + 2 * 5


def test_more_lines_and_totals_than_a_row_holds(spark, tmp_path):
    """One user with very many clicks on very many ads in one micro-batch, and odd lines."""
    lines = [f"{i} P C 1 {i % 2500}" for i in range(4000)] + ["5 P C 2 7 and more", "6  C -2 -7"]
    _drop(tmp_path / "in", 0, lines)
    tables = _tables(spark, tmp_path)
    source = file_lines(spark, str(tmp_path / "in"), 1)
    ad_streams.start_dynamic_blacklist(source, tables, 3, NOW).awaitTermination()
    clicks = _batch_clicks(spark, lines)
    assert _rows(tables.accepted.table()) == _rows(clicks)
    assert _rows(tables.user_click_count.table()) == _rows(
        ad_stats.daily_user_ad_clicks(clicks).select(schemas.AD_USER_CLICK_COUNT.names))
    assert tables.blacklist.table().count() == 0
