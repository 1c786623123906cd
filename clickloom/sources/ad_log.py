"""The ad log: ``<epoch ms> <province> <city> <user id> <ad id>`` per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.times import format_date


def typed_fields(parts: Column) -> list[Column]:
    """The fields of a log line that was split at blanks; null where one is missing or broken."""

    def field(i: int) -> Column:
        return F.try_element_at(parts, F.lit(i))

    return [
        F.timestamp_millis(field(1).try_cast("long")).alias("ts"),
        field(2).alias("province"),
        field(3).alias("city"),
        field(4).try_cast("long").alias("user_id"),
        field(5).try_cast("long").alias("ad_id"),
    ]


def _fields(lines: DataFrame) -> DataFrame:
    parts = lines.select("value", F.split("value", " ").alias("parts"))
    return parts.select("value", *typed_fields(F.col("parts")))


def _is_complete(max_ahead: str | None) -> Column:
    # The last field is there only if the four before it are.
    whole = F.col("ts").isNotNull() & F.col("user_id").isNotNull() & F.col("ad_id").isNotNull()
    if max_ahead is None:
        return whole
    return whole & (F.col("ts") <= F.current_timestamp() + F.expr(f"INTERVAL {max_ahead}"))


def parse_ad_log(lines: DataFrame, max_ahead: str | None = None) -> DataFrame:
    """Typed clicks of the well-formed lines in column ``value``.

    With ``max_ahead``, an interval such as ``1 HOUR``, a line whose time is further ahead
    of the clock is not well-formed: one of them would move a stream's watermark past all
    clicks to come.

    The test for well-formed lines is part of the row generator: as a filter it would be
    pushed below the split and repeat it once for every field tested.
    """
    click = F.struct("ts", "province", "city", "user_id", "ad_id")
    clicks = _fields(lines).select(F.inline(F.when(_is_complete(max_ahead), F.array(click))))
    date = format_date("ts").alias("date")
    return clicks.select("ts", date, "province", "city", "user_id", "ad_id")


def split_ad_log(lines: DataFrame, max_ahead: str | None = None) -> DataFrame:
    """Every line once: ``value``, the click in it, and ``accepted``, whether it is well-formed.

    On a stream, use this before ``foreachBatch``: the clock is then the time of the micro-batch
    that Spark has put on record, the same for all rows and for a batch that is repeated.
    """
    complete = F.coalesce(_is_complete(max_ahead), F.lit(False)).alias("accepted")
    row = F.struct("value", "ts", "province", "city", "user_id", "ad_id", complete)
    rows = _fields(lines).select(F.inline(F.array(row)))
    date = format_date("ts").alias("date")
    return rows.select("value", "ts", date, "province", "city", "user_id", "ad_id", "accepted")


def rejected_ad_log(lines: DataFrame, max_ahead: str | None = None) -> DataFrame:
    """The lines that :func:`parse_ad_log` leaves out, as they came."""
    return _fields(lines).where(~F.coalesce(_is_complete(max_ahead), F.lit(False))).select("value")


def kafka_options(servers: str, topics: str, **more: str) -> dict[str, str]:
    """Options of the Kafka source: topic list, newest offsets first, offsets in the checkpoint."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(t.strip() for t in topics.split(",")),
        "startingOffsets": "latest",
        **more,
    }


def kafka_lines(spark: SparkSession, servers: str, topics: str, **more: str) -> DataFrame:
    """Stream of log lines from Kafka (needs the Kafka connector on the class path)."""
    stream = spark.readStream.format("kafka").options(**kafka_options(servers, topics, **more))
    return stream.load().select(F.col("value").cast("string").alias("value"))


def file_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of log lines from text files dropped into a folder."""
    # A stream that was down for long must not skip old files.
    stream = spark.readStream.format("text").option("maxFileAge", "36500d")
    if files_per_batch is not None:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    return stream.load(path)
