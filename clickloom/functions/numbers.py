"""Number helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def format_double(c: Column | str, scale: int) -> Column:
    """A double rounded half up to ``scale`` decimals."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), scale)


def ratio(part: Column | str, whole: Column | str) -> Column:
    """``part / whole`` as a double; null over 0."""
    part = F.col(part) if isinstance(part, str) else part
    whole = F.col(whole) if isinstance(whole, str) else whole
    return F.try_divide(part.cast("double"), whole.cast("double"))
