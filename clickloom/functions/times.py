"""Time helpers over text times, date keys and minute keys.

Text times may carry an hour that is not zero-padded, so they are never compared
or sorted as text: parse first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text patterns of the data contract.
TIME_PARSE = "yyyy-MM-dd H:mm:ss"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
DATE_KEY_FORMAT = "yyyyMMdd"
DATE_HOUR_FORMAT = "yyyy-MM-dd_HH"
MINUTE_KEY_FORMAT = "yyyyMMddHHmm"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_time(c: Column | str) -> Column:
    """Timestamp of a text time; null when it does not parse."""
    return F.try_to_timestamp(_col(c), F.lit(TIME_PARSE))


def parse_date_key(c: Column | str) -> Column:
    """Timestamp at midnight of a ``yyyyMMdd`` key; null when it does not parse."""
    return F.try_to_timestamp(_col(c), F.lit(DATE_KEY_FORMAT))


def before(a: Column | str, b: Column | str) -> Column:
    return F.coalesce(parse_time(a) < parse_time(b), F.lit(False))


def after(a: Column | str, b: Column | str) -> Column:
    return F.coalesce(parse_time(a) > parse_time(b), F.lit(False))


def minus_seconds(a: Column | str, b: Column | str) -> Column:
    """Whole seconds from ``b`` to ``a``; 0 when either does not parse."""
    diff = F.unix_timestamp(parse_time(a)) - F.unix_timestamp(parse_time(b))
    return F.coalesce(diff, F.lit(0).cast("long"))


def format_date(ts: Column | str) -> Column:
    return F.date_format(_col(ts), DATE_FORMAT)


def format_time(ts: Column | str) -> Column:
    return F.date_format(_col(ts), TIME_FORMAT)


def format_date_key(ts: Column | str) -> Column:
    return F.date_format(_col(ts), DATE_KEY_FORMAT)


def format_minute_key(ts: Column | str) -> Column:
    return F.date_format(_col(ts), MINUTE_KEY_FORMAT)


def date_hour(ts: Column | str) -> Column:
    return F.date_format(_col(ts), DATE_HOUR_FORMAT)


def minute_parts(ts: Column | str) -> tuple[Column, Column, Column]:
    """Date, hour and minute text of a timestamp."""
    ts = _col(ts)
    return format_date(ts), F.date_format(ts, "HH"), F.date_format(ts, "mm")


def minute_key_parts(key: Column | str) -> tuple[Column, Column, Column]:
    """Date, hour and minute text of a ``yyyyMMddHHmm`` key."""
    return minute_parts(F.try_to_timestamp(_col(key), F.lit(MINUTE_KEY_FORMAT)))


def today() -> Column:
    return F.date_format(F.current_date(), DATE_FORMAT)


def yesterday() -> Column:
    return F.date_format(F.date_sub(F.current_date(), 1), DATE_FORMAT)
