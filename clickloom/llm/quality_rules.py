"""Quality rules by how far a document's histograms are from those of its language.

Two histograms are taken of each text: its characters by class, and how often the common
words of its language occur among all words. The same histograms over all documents of a
language that pass the base rules are the reference. A document whose Jensen-Shannon
distance to the reference is too large goes. All of it is DataFrame expressions: words and
windows are arrays inside the row, so no row is ever exploded or shuffled; only the sums
per language are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.batches import free_name, written

MIN_WORDS = 50
REPEAT_PERCENT = 50
# Histograms of few words are noise: below these lengths a distance decides nothing.
CHAR_TEST_WORDS = 50
WORD_TEST_WORDS = 100
MAX_CHAR_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.25

# White space, symbols, other character classes, and common words.
SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[ \x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
CLASSES = (
    SYMBOLS,
    "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ",
    "0123456789",
    ".,",
    "!?;:'\"()[]{}-_/\\@^~`+=",
)
PUNCTUATION = ".,!?;:'\"()"
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "it", "as", "with", "was"],
    "fr": ["le", "la", "les", "de", "des", "et", "en", "un", "une", "que", "est", "dans"],
    "de": ["der", "die", "das", "und", "in", "den", "von", "zu", "mit", "sich", "ist", "nicht"],
    "es": ["el", "la", "los", "de", "del", "y", "en", "que", "un", "una", "se", "por"],
}
# References of so many languages are broadcast, at some 500 bytes each.
BROADCAST_LANGS = 10_000
ALL_COMMON = sorted({w for words in COMMON_WORDS.values() for w in words})


def with_quality(
    docs: DataFrame, quality: str = "_quality", keep: Sequence[str] | None = None
) -> DataFrame:
    """``docs`` with a struct column: counts, ``base_failed`` and ``kept`` of each row.

    ``keep`` names the columns to return, all by default. The rows are measured once and
    written with those columns; references and verdicts start from there.

    Base rules: fewer than ``MIN_WORDS`` words, or more than ``REPEAT_PERCENT`` % of the
    words inside repeated three-word windows. A document that passes them is kept unless a
    histogram with enough words behind it is too far from its language's reference.

    A null or empty text has no words and fails. A null ``lang`` is a language of its own,
    as is every unknown one; their common words are those of all known languages. Where a
    language has no document that passes the base rules there is nothing to compare. Equal
    rows get equal results; an empty table gives no rows. A column named as ``quality`` among
    those kept is an error.
    """
    keep = list(docs.columns if keep is None else keep)
    if quality.lower() in {c.lower() for c in keep}:
        raise ValueError(f"the documents have a column {quality} already")
    measured = written(_measured(docs, keep), "quality")
    references = written(_references(measured), "quality-references")
    # Documents are not moved to meet the one row of their language, unless an odd column
    # makes languages without number.
    if references.count() <= BROADCAST_LANGS:
        references = F.broadcast(references)
    return _judged(measured, references, keep, quality)


def quality_filter(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with their columns as they are."""
    quality = free_name(docs, "_quality")
    return with_quality(docs, quality).where(f"`{quality}`.kept").drop(quality)


def _measured(docs: DataFrame, keep: Sequence[str]) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    plain = F.lower(F.translate(text, PUNCTUATION, ""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^ \x09-\x0D]"))
    n_chars = F.length(text)
    in_class = [n_chars - F.length(F.translate(text, c, "")) for c in (SPACE, *CLASSES)]
    common = F.filter(F.split(plain, SPACES), lambda w: w.isin(ALL_COMMON))
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc")
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    read = docs.select(
        row, lang.alias("lang"), words.alias("words"), common.alias("common"),
        lines.alias("lines"), n_chars.alias("n_chars"), F.array(*in_class).alias("in_class"),
    )
    n = F.size("words")
    windows = F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.struct(
                F.xxhash64(*[F.get("words", i + j) for j in range(3)]).alias("h"), i.alias("at")
            ),
        ),
    )
    listed = read.select(
        "doc", "lang", "lines", "n_chars", "in_class", n.alias("n_words"),
        F.sort_array(windows).alias("windows"), _common_counts().alias("word_counts"),
    )

    def twin(x, i):
        other = lambda j: F.get("windows", j)["h"]
        after, before = other(i + 1), other(F.greatest(i - 1, F.lit(0)))
        return F.coalesce(x["h"] == after, F.lit(False)) | ((i > 0) & (x["h"] == before))

    repeated = F.transform(F.filter("windows", twin), lambda x: x["at"])
    found = listed.select(
        "doc", "lang", "lines", "n_chars", "in_class", "n_words", "word_counts",
        repeated.alias("repeated"),
    )
    covered = F.flatten(F.transform("repeated", lambda p: F.array(p, p + 1, p + 2)))
    n_repeat = F.coalesce(F.size(F.array_distinct(covered)), F.lit(0))
    n_repeat = F.when(F.size("repeated") > 0, n_repeat).otherwise(0)
    space, symbols, *others = [F.get("in_class", i) for i in range(1 + len(CLASSES))]
    rest = F.col("n_chars") - sum((F.get("in_class", i) for i in range(len(CLASSES) + 1)), F.lit(0))
    measures = F.struct(
        "n_words", n_repeat.alias("n_repeat"), "word_counts",
        (F.col("n_chars") - space).alias("word_chars"),
        symbols.alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.array(space, symbols, *others, rest).alias("char_counts"),
    )
    # A generator's output is computed once, whatever refers to it.
    counted = found.select("doc", "lang", "n_chars", F.inline(F.array(measures)))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat") > REPEAT_PERCENT * F.col("n_words")
    )
    return counted.withColumn("base_failed", failed)


def _common_counts() -> Column:
    """How often each common word of the row's language occurs, in the order of its list."""
    lists = F.when(F.lit(False), F.array(F.lit("")))
    for lang, words in COMMON_WORDS.items():
        lists = lists.when(F.col("lang") == lang, F.array(*map(F.lit, words)))
    lists = lists.otherwise(F.array(*map(F.lit, ALL_COMMON)))
    return F.transform(lists, lambda x: F.size(F.filter("common", lambda w: w == x)))


def _references(measured: DataFrame) -> DataFrame:
    """Summed histograms per language, of the documents that pass the base rules."""
    passed = measured.where(~F.col("base_failed"))
    n_classes = len(CLASSES) + 2
    sums = passed.groupBy("lang").agg(
        F.array(*[F.sum(F.get("char_counts", F.lit(i))) for i in range(n_classes)]).alias("ref_chars"),
        F.array(
            *[F.sum(F.get("word_counts", F.lit(i))) for i in range(len(ALL_COMMON))]
        ).alias("ref_words"),
        F.sum("n_chars").alias("ref_n_chars"),
        F.sum("n_words").alias("ref_n_words"),
    )
    return sums.withColumnRenamed("lang", "ref_lang")


def _judged(measured: DataFrame, references: DataFrame, columns: list[str], q: str) -> DataFrame:
    joined = measured.join(references, F.col("lang") == F.col("ref_lang"), "left")
    ref_words = F.slice("ref_words", F.lit(1), F.size("word_counts"))
    joined = joined.withColumns(
        {
            "char_distance": _distance(
                F.col("char_counts"), F.col("n_chars"), F.col("ref_chars"), F.col("ref_n_chars")
            ),
            "word_distance": _distance(
                _with_rest(F.col("word_counts"), F.col("n_words")), F.col("n_words"),
                _with_rest(ref_words, F.col("ref_n_words")), F.col("ref_n_words"),
            ),
        }
    )
    far_chars = (F.col("n_words") >= CHAR_TEST_WORDS) & (F.col("char_distance") > MAX_CHAR_DISTANCE)
    far_words = (F.col("n_words") >= WORD_TEST_WORDS) & (F.col("word_distance") > MAX_WORD_DISTANCE)
    kept = ~F.col("base_failed") & ~F.coalesce(far_chars | far_words, F.lit(False))
    long = lambda name, alias=None: F.col(name).cast("long").alias(alias or name)
    verdict = F.struct(
        long("n_words"), long("word_chars"), long("n_symbols"), long("n_dup_lines"),
        long("n_repeat", "n_repeat_words"), "base_failed", kept.alias("kept"),
    )
    return joined.select(*[F.col("doc")[c].alias(c) for c in columns], verdict.alias(q))


def _with_rest(counts: Column, total: Column) -> Column:
    """Counts, and what they leave of the total as a last bin."""
    rest = F.aggregate(counts, total.cast("long"), lambda a, x: a - x)
    return F.concat(counts.cast("array<long>"), F.array(rest))


def _distance(left: Column, n_left: Column, right: Column, n_right: Column) -> Column:
    """Jensen-Shannon distance (base 2, from 0 to 1) of two histograms of equal length."""
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    term = lambda x, y: part(x, (x + y) / 2) + part(y, (x + y) / 2)
    terms = F.zip_with(left, right, lambda x, y: term(x / n_left, y / n_right))
    divergence = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2
    return F.sqrt(F.greatest(divergence, F.lit(0.0)))
