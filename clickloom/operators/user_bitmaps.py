"""Sets of users as bitmaps of their ids: built, merged, asked and listed.

A row holds 32,768 neighbouring ids in 4 KB, so a set of dense ids is a few bits a user and
small enough to be broadcast where the users themselves are not. Sets merge by OR, in any
order and any number of times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.ad_stats import without_blacklisted
from clickloom.sources.tables import BROADCAST_LIMIT_BYTES
from clickloom.sources.workspace import stored

BITMAP_BYTES = 4096
BITMAP_BITS = 8 * BITMAP_BYTES


def user_bitmaps(users: DataFrame, *by: str) -> DataFrame:
    """Rows (``by``, bucket, bits): the users of each group. Null ids are in no set."""
    placed = users.where(F.col("user_id").isNotNull()).select(
        *by,
        F.bitmap_bucket_number("user_id").alias("bucket"),
        F.bitmap_bit_position("user_id").alias("position"),
    )
    return placed.groupBy(*by, "bucket").agg(F.bitmap_construct_agg("position").alias("bits"))


def merged_bitmaps(bitmaps: DataFrame, *by: str) -> DataFrame:
    """One row per group and bucket, of rows from any number of sets."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def _byte(bits: Column, at: Column) -> Column:
    one = F.substring(bits, at + 1, F.lit(1))
    return F.conv(F.hex(one), 16, 10).cast("int")


def without_members(
    clicks: DataFrame, bitmaps: DataFrame, limit: int = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """Clicks of users that are in no bitmap; those without a user stay.

    The merged bitmaps are stored and counted. Up to ``limit`` bytes they are broadcast
    and no click is moved; ids too sparse or too many for that are listed and anti-joined.
    """
    index = stored(merged_bitmaps(bitmaps), "user-bitmaps")
    if index.count() * BITMAP_BYTES > limit:
        return without_blacklisted(clicks, bitmap_users(index))
    index = F.broadcast(index.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits")))
    found = clicks.join(index, F.bitmap_bucket_number(clicks["user_id"]) == F.col("_bucket"), "left")
    position = F.bitmap_bit_position(clicks["user_id"])
    byte = _byte(F.col("_bits"), F.floor(position / 8).cast("int"))
    listed = F.coalesce(F.getbit(byte, F.pmod(position, F.lit(8)).cast("int")) == 1, F.lit(False))
    return found.where(~listed).select(*(clicks[c] for c in clicks.columns))


def bitmap_users(bitmaps: DataFrame, *by: str) -> DataFrame:
    """Rows (``by``, user_id), one for each member; ``bitmaps`` are merged ones."""
    places = F.sequence(F.lit(0), F.lit(BITMAP_BYTES - 1))
    taken = bitmaps.select(*by, "bucket", "bits", F.explode(places).alias("at")).select(
        *by, "bucket", "at", _byte(F.col("bits"), F.col("at")).alias("byte")
    )
    bits = taken.where(F.col("byte") > 0).select(
        *by, "bucket", "at", "byte", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("bit")
    )
    position = F.col("at") * 8 + F.col("bit")
    user = F.when(
        F.col("bucket") > 0, (F.col("bucket") - 1) * BITMAP_BITS + position + 1
    ).otherwise(F.col("bucket") * BITMAP_BITS - position)
    return bits.where(F.getbit("byte", "bit") == 1).select(*by, user.alias("user_id"))


def bitmap_sizes(bitmaps: DataFrame, *by: str) -> DataFrame:
    """Rows (``by``, users): distinct users of each group; ``bitmaps`` are merged ones."""
    return bitmaps.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias("users"))
