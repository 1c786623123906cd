"""Salts for hot keys.

A salt is a hash of columns that tell the rows of one group apart. It is the same
when a lost task is run again, which a random number is not, so partial results of
the first run and the second never disagree.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def salt(n: int, *row_columns: Column | str) -> Column:
    """A number in ``0 .. n-1``; never pass only the group key, it would be constant."""
    if n < 1 or not row_columns:
        raise ValueError("a salt needs n >= 1 and at least one column")
    return F.pmod(F.xxhash64(*row_columns), F.lit(n)).cast("int")


def random_prefix(text: Column | str, n: int, *row_columns: Column | str) -> Column:
    """``7_text``: the text behind a salt and an underscore."""
    text = F.col(text) if isinstance(text, str) else text
    return F.concat_ws("_", salt(n, *row_columns).cast("string"), text)


def remove_random_prefix(c: Column | str) -> Column:
    """Strip the salt only; underscores inside the text stay."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, "^[0-9]+_", "")
