"""Optional predicates: an absent parameter passes every row.

Made for ``where``, in which a null comparison drops the row just as ``false``
does; leaving out a ``coalesce`` lets range and equality tests reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickloom.functions.strings import comma_list


def in_range(c: Column | str, low: int | None, high: int | None) -> Column:
    """``low <= c <= high``; both bounds must be given for the test to apply."""
    c = F.col(c) if isinstance(c, str) else c
    if low is None or high is None:
        return F.lit(True)
    return c.between(low, high)


def any_of(c: Column | str, wanted: str | None) -> Column:
    """True when the comma list in ``c`` shares an item with the list ``wanted``."""
    if wanted is None:
        return F.lit(True)
    return F.arrays_overlap(comma_list(c), F.array(*[F.lit(w) for w in wanted.split(",")]))


def equals(c: Column | str, wanted: str | None) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    if wanted is None:
        return F.lit(True)
    return c == F.lit(wanted)
