"""The ad-click streams.

    log lines -> filter by user -> accepted clicks -> running counts
                 (keyed state)                     -> top ads per province (keyed state)
                    |                              -> clicks per minute, clicks per slide
                    +-> rejected lines, late clicks, totals per user and ad, listed users

The filter remembers users' totals and whether they are listed, and writes all it
gives out through one file sink. The other streams follow the accepted clicks and keep
running counts in the state store, so a micro-batch costs what its own rows cost and no
table is read back.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import ArrayType, LongType

from clickloom import schemas
from clickloom.functions.times import format_date
from clickloom.operators.ad_stats import (
    BLACKLIST_THRESHOLD,
    USER_AD_KEYS,
    ad_click_trend,
    ad_stat,
    slide_counts,
    windows_of_slides,
    without_blacklisted,
)
from clickloom.sources.ad_log import split_ad_log, typed_fields
from clickloom.streaming.keyed_state import CLICK, OUTCOME, TOP_ADS, ClickFilter, TopAds
from clickloom.streaming.tables import BatchTable, SinkTable

# How far a click's time may be ahead of the clock.
MAX_AHEAD = "1 HOUR"
LINES = schemas.columns("value string")
FILTERED = schemas.columns(
    "value string, ts timestamp, date string, province string, city string, user_id bigint, "
    "ad_id bigint, click_count bigint, kind string"
)
CHECKED = schemas.columns(
    "value string, ts timestamp, date string, province string, city string, user_id bigint, "
    "ad_id bigint, outcome string"
)
PROVINCE_SLOTS = schemas.columns("date string, province string, slot bigint, version bigint")
for _name in ("ad_ids", "click_counts"):
    PROVINCE_SLOTS.add(_name, ArrayType(LongType()))
# Users are dealt to so many keys of state.
USER_BUCKETS = 4096
# A province's ads are dealt to so many keys of state.
SLOTS = 16
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _largest(*keys: str) -> Callable[[DataFrame], DataFrame]:
    """Running counts as they stand: they only grow."""
    return lambda log: log.groupBy(*keys).agg(F.max("click_count").alias("click_count"))


def _latest_slots(log: DataFrame) -> DataFrame:
    newest = F.max_by(F.struct("version", "ad_ids", "click_counts"), "version").alias("newest")
    slots = log.groupBy("date", "province", "slot").agg(newest)
    return slots.select("date", "province", "slot", "newest.*")


class AdTables:
    """The tables of the streams below one folder, and their checkpoints."""

    def __init__(self, spark: SparkSession, root: str, fold_every: int = 100):
        self.root = root
        self.filtered_path = f"{root}/filtered"

        def filtered(kind, schema, resolve=None):
            return SinkTable(spark, self.filtered_path, FILTERED, kind, schema, resolve)

        def running(name, schema, resolve, by="date", fold_every=fold_every):
            return BatchTable(spark, f"{root}/{name}", schema, by, resolve, fold_every)

        self.accepted = filtered("click", schemas.AD_CLICK)
        self.late = filtered("late", schemas.AD_CLICK)
        self.rejected = filtered("rejected", LINES)
        self.user_click_count = filtered(
            "count", schemas.AD_USER_CLICK_COUNT, _largest(*USER_AD_KEYS)
        )
        self.blacklist = filtered(
            "listed", schemas.AD_BLACKLIST, lambda log: log.select("user_id").distinct()
        )
        self.checked = running("checked_line", CHECKED, lambda log: log, "outcome", None)
        self.stat = running("ad_stat", schemas.AD_STAT, _largest("date", "province", "city", "ad_id"))
        self.trend = running(
            "ad_click_trend", schemas.AD_CLICK_TREND, _largest("date", "hour", "minute", "ad_id")
        )
        self.slides = running(
            "ad_slide_count", schemas.AD_SLIDE_COUNT, _largest("date", "slide_start", "ad_id")
        )
        self.province_slots = running("ad_province_top", PROVINCE_SLOTS, _latest_slots)

    def passed(self) -> DataFrame:
        """The clicks that the filter by an outside list has let pass."""
        rows = self.checked.table().where(F.col("outcome") == "passed")
        return schemas.as_schema(rows, schemas.AD_CLICK)

    def passed_rejected(self) -> DataFrame:
        return self.checked.table().where(F.col("outcome") == "rejected").select("value")

    def province_top3(self, k: int = 3) -> DataFrame:
        """Top ads per day and province; ``k`` is at most that of the stream."""
        top = F.arrays_zip(F.col("ad_ids").alias("ad_id"), F.col("click_counts").alias("click_count"))
        ads = self.province_slots.table().select("date", "province", F.inline(top))
        best = Window.partitionBy("date", "province").orderBy(F.desc("click_count"), F.asc("ad_id"))
        ranked = ads.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        return schemas.as_schema(ranked, schemas.AD_PROVINCE_TOP3)

    def sliding_trend(
        self, length_seconds: int = 3600, slide_seconds: int = 10, days: tuple[str, str] | None = None
    ) -> DataFrame:
        """Clicks per ad in sliding windows, from the counts per slide (of ``days`` only, if given)."""
        slides = self.slides.table()
        if days is not None:
            slides = slides.where(F.col("date").between(*days))
        return windows_of_slides(slides, length_seconds, slide_seconds)

    def checkpoint(self, query: str) -> str:
        return f"{self.root}/_checkpoints/{query}"


@contextmanager
def _settings(spark: SparkSession, settings: Mapping[str, str | None]):
    """Session settings for a while; a streaming query takes them over when it starts."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            if value is not None:
                spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _started(
    stream: DataFrame,
    sink: Callable[[DataStreamWriter], DataStreamWriter],
    checkpoint: str,
    trigger: dict | None,
    mode: str = "append",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start a stream; the number of its state partitions stays as its first start sets it."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = sink(writer.trigger(**(trigger or {"processingTime": "5 seconds"})))
    partitions = None if state_partitions is None else str(state_partitions)
    settings = {
        "spark.sql.shuffle.partitions": partitions,
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    }
    with _settings(stream.sparkSession, settings):
        return writer.start()


def _per_batch(on_batch: Callable[[DataFrame, int], None]):
    return lambda writer: writer.foreachBatch(on_batch)


def start_blacklist_filter(
    lines: DataFrame,
    read_blacklist: Callable[[], DataFrame],
    tables: AdTables,
    trigger: dict | None = None,
    max_ahead: str | None = MAX_AHEAD,
) -> StreamingQuery:
    """Keep clicks of users not on a list kept elsewhere, read anew for each micro-batch.

    What passes and the lines that are broken or too far ahead of the clock go to
    ``tables.checked``, in one write that a repeated batch replaces as a whole. The clock is
    that of the micro-batch, so a line is one or the other.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        passing = without_blacklisted(batch.where("accepted"), read_blacklist())
        passed = passing.withColumn("outcome", F.lit("passed"))
        rejected = batch.where(~F.col("accepted")).withColumn("outcome", F.lit("rejected"))
        tables.checked.write(passed.unionByName(rejected), batch_id)

    split = split_ad_log(lines, max_ahead)
    return _started(split, _per_batch(on_batch), tables.checkpoint("blacklist_filter"), trigger)


def start_dynamic_blacklist(
    lines: DataFrame,
    tables: AdTables,
    threshold: int = BLACKLIST_THRESHOLD,
    trigger: dict | None = None,
    max_ahead: str | None = MAX_AHEAD,
    late_after: str | None = None,
    state_partitions: int | None = None,
    files_per_batch: int = 4,
    buckets: int = USER_BUCKETS,
) -> StreamingQuery:
    """Filter by the list, add up clicks per (date, user, ad), list users over the threshold.

    A user listed by one micro-batch is filtered from the next one on; only those clicks
    leave no record. All other lines go to one of ``tables.accepted``, ``tables.rejected``
    (broken, or more than ``max_ahead`` ahead of the clock of their micro-batch) and
    ``tables.late``. A click is late if, ``late_after`` being asked for, it is that much
    older than the newest click of the micro-batches before; days that can have no more
    clicks then leave the state. The clicks of one bucket in one micro-batch go through one
    task, as a stream of rows. Users are dealt to ``buckets`` keys of state, whose number must
    stay as the first start sets it; a micro-batch reads and writes its days in its buckets.
    """
    split = split_ad_log(lines, max_ahead)
    clicks = split.where("accepted")
    if late_after is not None:
        clicks = clicks.withWatermark("ts", late_after)
    # The operator itself tells late clicks from others, so it gets times, as plain numbers.
    bucket = F.pmod(F.xxhash64("user_id"), F.lit(buckets)).alias("bucket")
    click = F.concat_ws(" ", *[c.cast("string") for c in _narrow(CLICK)]).alias("click")
    keyed = clicks.select(bucket, click).groupBy("bucket")
    mode = "none" if late_after is None else "eventTime"
    outcomes = keyed.transformWithState(
        ClickFilter(threshold, late_after is not None), OUTCOME, "append", mode
    )
    found = _filtered_rows(outcomes)
    rejected = split.where(~F.col("accepted")).select("value", F.lit("rejected").alias("kind"))
    # Few files: only clicks are spread, each other kind of row goes into one.
    spread = F.when(F.col("kind") == "click", F.pmod(F.xxhash64("user_id", "ts"), F.lit(files_per_batch)))
    out = found.unionByName(rejected, allowMissingColumns=True)
    out = out.repartition(files_per_batch, "kind", spread)

    def sink(writer: DataStreamWriter) -> DataStreamWriter:
        return writer.format("parquet").partitionBy("kind").option("path", tables.filtered_path)

    checkpoint = tables.checkpoint("dynamic_blacklist")
    return _started(out, sink, checkpoint, trigger, state_partitions=state_partitions)


def _filtered_rows(outcomes: DataFrame) -> DataFrame:
    """What :class:`ClickFilter` gives out in lists, as a row for each click, total and listed user."""
    totals = F.arrays_zip("dates", "user_ids", "ad_ids", "click_counts")

    def total(t: Column) -> Column:
        return _found("count", date=t["dates"], user=t["user_ids"], ad=t["ad_ids"], n=t["click_counts"])

    found = F.concat(
        F.transform("clicks", lambda line: _found("click", line=line)),
        F.transform("late", lambda line: _found("late", line=line)),
        F.transform(totals, total),
        F.transform("listed", lambda user: _found("listed", user=user)),
    )
    rows = outcomes.select(F.inline(found))
    # Lines are read again here: taking all of their fields through the state costs far more.
    ts, province, city, user_id, ad_id = typed_fields(F.split("line", " "))
    return rows.select(
        F.lit(None).cast("string").alias("value"),
        ts,
        F.coalesce("date", format_date(ts)).alias("date"),
        province,
        city,
        F.coalesce("user", user_id).alias("user_id"),
        F.coalesce("ad", ad_id).alias("ad_id"),
        F.col("n").alias("click_count"),
        "kind",
    )


def _found(kind: str, **known: Column) -> Column:
    types = {"line": "string", "date": "string", "user": "long", "ad": "long", "n": "long"}
    values = [known.get(name, F.lit(None)).cast(t).alias(name) for name, t in types.items()]
    return F.struct(F.lit(kind).alias("kind"), *values)


def start_ad_stat(
    clicks: DataFrame,
    tables: AdTables,
    late_after: str | None = None,
    trigger: dict | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Running counts by (date, province, city, ad).

    Counts never expire, unless ``late_after`` is asked for: then a day's counts may leave
    the state once a click that long after the next day's end has come, and clicks on that day
    that come still later are dropped. The filter stream with the same ``late_after`` has put
    those into ``tables.late`` before, so of accepted clicks none is dropped here. Days are
    those of the session time zone either way.
    """
    if late_after is None:
        running = ad_stat(clicks)
    else:
        # The end of the day is what the watermark looks at; a click's own day ends up to
        # a day after the click.
        marked = _with_day_end(clicks).withWatermark("day_end", f"1 day {late_after}")
        per_day = marked.groupBy("day_end", "date", "province", "city", "ad_id")
        running = per_day.agg(F.count(F.lit(1)).alias("click_count")).drop("day_end")
    sink, checkpoint = _per_batch(tables.stat.write), tables.checkpoint("ad_stat")
    return _started(running, sink, checkpoint, trigger, "update", state_partitions)


def start_province_top(
    clicks: DataFrame,
    tables: AdTables,
    k: int = 3,
    late_after: str | None = None,
    trigger: dict | None = None,
    state_partitions: int | None = None,
    slots: int = SLOTS,
) -> StreamingQuery:
    """The ``k`` most clicked ads of each province and day, as :meth:`AdTables.province_top3`.

    The counts behind them are keyed state, and only tops that have changed are written.
    With ``late_after`` a day leaves the state that long after its end.
    """
    if late_after is not None:
        clicks = clicks.withWatermark("ts", late_after)
    slot = F.pmod(F.xxhash64("ad_id"), F.lit(slots)).cast("long").alias("slot")
    keyed = clicks.select("date", "province", slot, "ad_id", *_narrow(["day_end_ms"]))
    mode = "none" if late_after is None else "eventTime"
    tops = keyed.groupBy("date", "province", "slot").transformWithState(
        TopAds(k, late_after is not None), TOP_ADS, "update", mode
    )
    sink, checkpoint = _per_batch(tables.province_slots.write), tables.checkpoint("province_top")
    return _started(tops, sink, checkpoint, trigger, "update", state_partitions)


def start_ad_click_trend(
    clicks: DataFrame,
    tables: AdTables,
    late_after: str | None = None,
    trigger: dict | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Clicks per minute and ad.

    All minutes stay in the state and no click is dropped, unless ``late_after`` is asked
    for: then a minute leaves the state that long after its end.
    """
    per_minute = ad_click_trend(_marked(clicks, late_after))
    sink, checkpoint = _per_batch(tables.trend.write), tables.checkpoint("ad_click_trend")
    return _started(per_minute, sink, checkpoint, trigger, "update", state_partitions)


def start_sliding_trend(
    clicks: DataFrame,
    tables: AdTables,
    slide_seconds: int = 10,
    late_after: str | None = None,
    trigger: dict | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Clicks per ad and slide of time, from which :meth:`AdTables.sliding_trend` makes windows.

    A slide and ad are one row of state, however many windows a click falls into. Slides
    expire as in :func:`start_ad_click_trend`.
    """
    per_slide = slide_counts(_marked(clicks, late_after), slide_seconds)
    sink, checkpoint = _per_batch(tables.slides.write), tables.checkpoint("sliding_trend")
    return _started(per_slide, sink, checkpoint, trigger, "update", state_partitions)


def _marked(clicks: DataFrame, late_after: str | None) -> DataFrame:
    return clicks if late_after is None else clicks.withWatermark("ts", late_after)


def _with_day_end(clicks: DataFrame) -> DataFrame:
    return clicks.withColumn("day_end", F.date_trunc("day", "ts") + F.expr("INTERVAL 1 DAY"))


def _narrow(columns: list[str]) -> list:
    """Columns for keyed state, times as numbers that need no conversion in Python."""
    day_end = F.date_trunc("day", "ts") + F.expr("INTERVAL 1 DAY")
    made = {
        "ts_us": F.unix_micros("ts").alias("ts_us"),
        "day_end_ms": F.unix_millis(day_end).alias("day_end_ms"),
    }
    return [made.get(c, F.col(c)) for c in columns]
