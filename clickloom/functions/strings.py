"""Text helpers: emptiness, commas, packed records, JSON fields and labels."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_empty(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit("")) == ""


def is_not_empty(c: Column | str) -> Column:
    return ~is_empty(c)


def trim_comma(c: Column | str) -> Column:
    """Drop one comma at either end."""
    return F.regexp_replace(_col(c), "^,|,$", "")


def zero_pad2(c: Column | str) -> Column:
    """Two-character text as it is, any other with a zero in front."""
    c = _col(c)
    return F.when(F.length(c) == 2, c).otherwise(F.concat(F.lit("0"), c))


def comma_list(c: Column | str) -> Column:
    return F.split(_col(c), ",")


def comma_longs(c: Column | str) -> Column:
    """Comma-joined ids as an array of longs; items that are no number become null."""
    return comma_list(c).try_cast("array<bigint>")


def packed_get(c: Column | str, field: str, delimiter: str = "|") -> Column:
    """Value of ``field`` in ``k=v|k=v|…``; first match wins, null when absent or empty.

    Blanks around names and values do not count, and an item with more than one
    ``=`` is not a field. The delimiter is one character.
    """
    if len(delimiter) != 1:
        raise ValueError("the delimiter of packed text is one character")
    d = re.escape(delimiter)
    pattern = rf"(?:^|{d})\s*{re.escape(field)}\s*=\s*([^={d}]*[^={d}\s])\s*(?={d}|$)"
    return F.nullif(F.regexp_extract(_col(c), pattern, 1), F.lit(""))


def packed_set(
    c: Column | str, field: str, value: Column | str, delimiter: str = "|"
) -> Column:
    """Replace the value of an existing ``field``; order is kept, nothing is added.

    ``value`` as ``str`` is a literal; the result is joined with ``|``.
    """
    d = re.escape(delimiter)
    new = F.lit(value) if isinstance(value, str) else value
    item = F.concat(F.lit(f"{field}="), F.coalesce(new.cast("string"), F.lit("")))
    items = F.split(F.regexp_replace(_col(c), f"(?:{d})+$", ""), d)
    replaced = F.transform(
        items,
        lambda x: F.when(F.trim(F.substring_index(x, "=", 1)) == field, item).otherwise(x),
    )
    return F.array_join(replaced, "|")


def json_field(c: Column | str, field: str) -> Column:
    """Text of a top-level JSON field; null for bad JSON or an absent field."""
    return F.get_json_object(_col(c), f"$.{field}")


def concat_long_string(number: Column | str, text: Column | str, sep: str = ":") -> Column:
    """``12`` and ``Springfield`` as ``12:Springfield``."""
    return F.concat_ws(sep, _col(number).cast("string"), _col(text))


def flow_pairs(c: Column | str) -> Column:
    """``1,2,3`` as the array ``[1_2, 2_3]``; a flow of one page gives an empty array."""
    pages = F.transform(comma_list(c), lambda page: F.trim(page))
    n = F.greatest(F.size(pages) - 1, F.lit(0))
    return F.zip_with(
        F.slice(pages, F.lit(1), n),
        F.slice(pages, F.lit(2), n),
        lambda a, b: F.concat_ws("_", a, b),
    )
