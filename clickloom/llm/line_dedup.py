"""Boilerplate lines by the number of distinct sites that carry them.

Each line is known by a 128-bit hash. Per hash, HyperLogLog sketches of the sites merge by
aggregation, so a line on millions of pages shuffles one sketch per task. Lines whose
estimate is close to the threshold get an exact distinct count; the rest are decided by the
estimate, from which the threshold is further away than its error. A line of too many
sites stays in its first document and is removed from all others, so that nothing
vanishes from the corpus altogether. All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.batches import free_name, written
from clickloom.operators.skew import key_copy

MIN_SITES = 5
MIN_WORDS = 3
LG_SKETCH = 12
# Sketches of 4,096 entries err by 1.6 % (one sigma): half as much again is far off.
NEAR = (0.5, 1.5)


def with_line_spread(
    docs: DataFrame,
    site_col: str = "source",
    min_sites: int = MIN_SITES,
    min_words: int = MIN_WORDS,
    spread: str = "_lines",
) -> DataFrame:
    """``docs`` with cleaned ``text`` and a column ``spread``: (n_lines, n_removed).

    Lines are split at ``\\n`` and compared with white space runs as one space and without
    ends. A line with ``min_words`` words or more on ``min_sites`` distinct sites or more
    goes from every document but the one of the lowest ``doc_id``. Shorter and empty lines
    stay. Repeats inside one document stay or go together.

    A null text stays null and has no lines; a null site is a site of its own; among null
    ids only lines without any other document stay. Rows that are equal in id and text are
    treated alike. An empty table gives no rows. A column named as ``spread`` is an error.
    """
    if spread.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"the documents have a column {spread} already")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    lines = written(_line_rows(docs, site_col, min_words), "lines")
    removed = _occurrences(lines, _spread_lines(lines, min_sites))
    places = removed.groupBy("k1", "k2").agg(F.collect_set("place").alias("places"))
    joined = docs.select(row, *_row_key()).join(places, ["k1", "k2"], "left")
    text = F.col("doc")["text"]
    cut = joined.select(
        "doc", "places", F.when(F.col("places").isNotNull(), F.split(text, "\n")).alias("lines")
    )
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "places")
    kept = F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")
    n_lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    result = F.struct(
        F.when(F.col("places").isNull(), text).otherwise(kept).alias("kept_text"),
        F.coalesce(n_lines, F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.array_size("places"), F.lit(0)).cast("long").alias("n_removed"),
    )
    # A generator's output is computed once; a filter on it is not pushed below it.
    made = cut.select("doc", F.inline(F.array(result)))
    shown = [F.col("kept_text" if c == "text" else f"doc.`{c}`").alias(c) for c in docs.columns]
    return made.select(*shown, F.struct("n_lines", "n_removed").alias(spread))


def without_spread_lines(docs: DataFrame, site_col: str = "source") -> DataFrame:
    """Documents without boilerplate lines; one that had nothing else goes.

    A document goes only if lines were removed and no word is left: all it said is still
    said in other documents.
    """
    spread = free_name(docs, "_lines")
    cleaned = with_line_spread(docs, site_col, spread=spread)
    said = F.col("text").rlike(r"[^ \x09-\x0D]")
    return cleaned.where((F.col(f"`{spread}`.n_removed") == 0) | said).drop(spread)


def _row_key() -> list[Column]:
    return [
        F.xxhash64("doc_id", "text").alias("k1"),
        F.xxhash64("text", F.lit(1), "doc_id").alias("k2"),
    ]


def _line_rows(docs: DataFrame, site_col: str, min_words: int) -> DataFrame:
    """(row key, place, line hash, site, doc_id) of each line long enough to count."""
    site = F.coalesce(F.col(site_col).cast("string"), F.lit("\0")).alias("site")
    # White space and the row key are dealt with once per document, below the generator.
    keyed = docs.select("doc_id", site, *_row_key(), F.split(_plain_lines(), "\n").alias("lines"))
    rows = keyed.select("doc_id", "k1", "k2", "site", F.posexplode("lines").alias("place", "line"))
    long_enough = rows.where(_has_words(F.col("line"), min_words))
    return long_enough.select(
        "doc_id", "k1", "k2", "place", "site",
        F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"),
    )


def _plain_lines() -> Column:
    """The text with white space runs inside its lines as one space and none at their ends."""
    text = F.col("text")
    for c in "\t\x0b\x0c\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    single = F.when(F.instr(text, "  ") == 0, text)
    text = F.coalesce(single, F.regexp_replace(text, " +", " "))
    text = F.replace(F.replace(text, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n"))
    return F.trim(text)


def _has_words(line: Column, n: int) -> Column:
    """Whether a line with single spaces inside has so many words."""
    if n <= 1:
        return line != ""
    place = F.instr(line, " ")
    for _ in range(n - 2):
        following = F.call_function("locate", F.lit(" "), line, place + 1)
        place = F.when(place > 0, following).otherwise(0)
    return place > 0


def _spread_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """(line hash, first document) of the lines on too many sites."""
    sketched = lines.groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("doc_id").alias("first_id"),
        F.hll_sketch_agg("site", LG_SKETCH).alias("sites"),
    )
    estimate: Column = F.hll_sketch_estimate("sites")
    # A line cannot be on more sites than it has rows.
    often = sketched.where(F.col("n") >= min_sites).withColumn("estimate", estimate)
    far = often.where(F.col("estimate") > NEAR[1] * min_sites).select("h1", "h2", "first_id")
    near = often.where(
        F.col("estimate").between(NEAR[0] * min_sites, NEAR[1] * min_sites)
    ).select(F.col("h1").alias("n1"), F.col("h2").alias("n2"))
    rows_near = lines.join(
        near, (key_copy("n1") == F.col("h1")) & (F.col("n2") == F.col("h2")), "left_semi"
    )
    counted = (
        rows_near.groupBy("h1", "h2", "site")
        .agg(F.min("doc_id").alias("first_id"))
        .groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n_sites"), F.min("first_id").alias("first_id"))
    )
    exact = counted.where(F.col("n_sites") >= min_sites).select("h1", "h2", "first_id")
    return far.unionByName(exact)


def _occurrences(lines: DataFrame, spread: DataFrame) -> DataFrame:
    """(row key, place) of the lines to remove."""
    spread = spread.select(
        F.col("h1").alias("s1"), F.col("h2").alias("s2"), F.col("first_id").alias("first_id")
    )
    same = (key_copy("s1") == F.col("h1")) & (F.col("s2") == F.col("h2"))
    found = lines.join(spread, same)
    return found.where(~F.col("doc_id").eqNullSafe(F.col("first_id"))).select("k1", "k2", "place")
