"""Languages of texts, span by span.

Words are runs of letters of one script. The script of a word leaves only the languages
that were seen to use it; those score the word by its letter groups. A Viterbi path over the
words of a text, with a penalty for each change, then labels spans, so that a few foreign
words do not break a sentence while a quoted passage gets its own language.

The counts behind the scores are summed in Spark. Scoring runs over Arrow batches in numpy:
each distinct word of a batch is scored once, and all texts of a batch take a step of
their paths together.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.batches import by_bytes, texts_of

# Counted are about so many documents of each language: those with the lowest hash of doc_id.
SAMPLE_PER_LANG = 4_000
FOLDS, HELD_OUT = 4, 2
FEATURES = 1 << 16
GRAMS = (2, 3, 4)
SMOOTHING = 0.5
SWITCH_PENALTY = 10.0
# A language uses a script if it has this share of its letters, and other scripts cost this.
SCRIPT_SHARE = 0.01
WRONG_SCRIPT = -30.0
# Longer runs of letters are cut: not all scripts put spaces between words.
WORD_LETTERS = 32
PIECE = 1 << 20
UNDETERMINED = "und"

# First and last code point of the blocks of each script.
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF), (0xFB1D, 0xFB4F)),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "devanagari": ((0x900, 0x97F), (0xA8E0, 0xA8FF)),
    "bengali": ((0x980, 0x9FF),),
    "gurmukhi": ((0xA00, 0xA7F),),
    "gujarati": ((0xA80, 0xAFF),),
    "tamil": ((0xB80, 0xBFF),),
    "telugu": ((0xC00, 0xC7F),),
    "kannada": ((0xC80, 0xCFF),),
    "malayalam": ((0xD00, 0xD7F),),
    "sinhala": ((0xD80, 0xDFF),),
    "thai": ((0xE00, 0xE7F),),
    "lao": ((0xE80, 0xEFF),),
    "tibetan": ((0xF00, 0xFFF),),
    "myanmar": ((0x1000, 0x109F),),
    "georgian": ((0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)),
    "hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    "ethiopic": ((0x1200, 0x139F),),
    "khmer": ((0x1780, 0x17FF),),
    "kana": ((0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)),
}
OTHER, MARK = len(SCRIPTS) + 1, len(SCRIPTS) + 2


def is_held_out(doc_id: Column | str) -> Column:
    """Whether a document belongs to the fold that is never learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == HELD_OUT


class LanguageModel:
    """Log probabilities of letter groups by language, and who uses which script."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        """``counts``: a row per language, features first and then letters by script."""
        self.langs = langs
        grams = counts[:, :FEATURES].astype(np.float64) + SMOOTHING
        self.log_p = np.log(grams / grams.sum(1, keepdims=True)).astype(np.float32).T.copy()
        letters = counts[:, FEATURES:]
        share = letters / np.maximum(letters.sum(1, keepdims=True), 1)
        self.uses = (share >= SCRIPT_SHARE).T.copy()

    def word_scores(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """A row per word: how much worse each language is than the best one."""
        features, word = _features(codes, starts, lengths)
        sums = np.zeros((len(starts), len(self.langs)), np.float32)
        if len(features):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            sums[word[first]] = np.add.reduceat(self.log_p[features], first, axis=0)
        sums /= len(GRAMS) + 1
        uses = self.uses[_table()[0][codes[starts]]]
        known = uses.any(1)
        best = np.where(uses, sums, -np.inf).max(1, initial=-np.inf, keepdims=True)
        scores = np.where(uses, sums - np.where(known[:, None], best, 0), WRONG_SCRIPT)
        # A script that no language was seen to use tells nothing.
        scores[~known] = 0
        return scores.astype(np.float32)


def fit_languages(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> LanguageModel:
    """A model of the languages that ``docs`` are marked with, from text and ``lang`` alone.

    Held-out documents, null languages, ids and texts teach nothing. Of a language with
    more than ``per_lang`` documents about that many are counted, those with the lowest hash
    of ``doc_id``; counts of letter groups are summed in Spark and arrive here as at most
    ``FEATURES`` numbers a language. Without any such document no language is known.
    """
    known = docs.where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~F.coalesce(is_held_out("doc_id"), F.lit(True))
    ).select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").collect()
    langs = [r["lang"] for r in sizes]
    number = {lang: i for i, lang in enumerate(langs)}
    if not langs:
        return LanguageModel([], np.zeros((0, FEATURES + MARK + 1), np.int64))
    drawn = F.lit(False)
    for r in sizes:
        drawn = F.when(F.col("lang") == r["lang"], place < per_lang / r["n"]).otherwise(drawn)
    sample = known.where(drawn).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            coded = batch["lang"].dictionary_encode()
            counts = _counts(texts_of(batch).to_pylist(), coded.indices.to_numpy(), len(coded.dictionary))
            lang, feature = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [coded.dictionary.take(pa.array(lang)), pa.array(feature), pa.array(counts[lang, feature])],
                names=["lang", "feature", "n"],
            )

    counted = sample.mapInArrow(count, "lang string, feature long, n long")
    totals = counted.groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((len(langs), FEATURES + MARK + 1), np.int64)
    rows = np.array([number[x] for x in totals["lang"].to_pylist()], np.int64)
    counts[rows, totals["feature"].to_numpy()] = totals["n"].to_numpy()
    return LanguageModel(langs, counts)


def predicted_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Rows (doc_id, lang_pred, score, spans), one for each row of ``docs``; no shuffle.

    ``spans`` are (start, end, lang) in code points, from the first to the last letter of
    neighbouring words with one language. ``lang_pred`` is the language with most letters
    in its spans, ties going to the better sum of word scores, and ``score`` its share of
    all letters. Whole texts are labelled, and nothing but the text is looked at.

    A text that is null or has no letter is ``und`` with score 0 and no spans, as is every
    text if no language is known. Equal texts get equal results; an empty table gives no rows.
    """
    named = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = (
        f"doc_id {named.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, "
        "spans array<struct<start:bigint,end:bigint,lang:string>>"
    )

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            columns = _labelled(held.value, texts_of(batch).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *columns], names=["doc_id", "lang_pred", "score", "spans"]
            )

    return named.mapInArrow(label, schema)


@lru_cache(maxsize=1)
def _table() -> tuple[np.ndarray, np.ndarray]:
    """(script of each code point, its lower case); 0 is no letter, ``MARK`` goes with one."""
    script = np.zeros(0x110000, np.uint8)
    lower = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))
        if kind[0] == "L":
            script[c] = OTHER
            small = chr(c).lower()
            if len(small) == 1:
                lower[c] = ord(small)
        elif kind[0] == "M":
            script[c] = MARK
    for number, blocks in enumerate(SCRIPTS.values(), 1):
        for first, last in blocks:
            block = script[first : last + 1]
            block[block == OTHER] = number
    return script, lower


class _Words:
    """The words of texts: text number, place, size, letters, and a hash of the lower case."""

    def __init__(self, texts: list[str]):
        # A line end between texts is no letter.
        raw = "\n".join(texts).encode("utf-32-le", "surrogatepass")
        self.codes = np.frombuffer(raw, "<u4")
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.text_starts = np.cumsum(sizes + 1) - sizes - 1
        parts = [_words_of(self.codes[at : at + PIECE], at) for at in range(0, len(self.codes), PIECE)]
        empty = np.empty(0, np.int64)
        self.starts, self.lengths, self.letters, hashes = (
            np.concatenate(p) if parts else empty for p in (zip(*parts) if parts else [()] * 4)
        )
        self.text = np.searchsorted(self.text_starts, self.starts, side="right") - 1
        _, self.first, self.distinct = np.unique(hashes, return_index=True, return_inverse=True)


def _words_of(codes: np.ndarray, base: int):
    """Words of a piece. A word across the border of two pieces becomes two words."""
    table, lower = _table()
    script = table[codes]
    before = np.concatenate((np.zeros(1, np.uint8), script[:-1]))
    inside = script > 0
    change = (script != before) & (script != MARK) & (before != MARK)
    begin = inside & (change | (before == 0))
    letters_at = np.flatnonzero(inside)
    if not len(letters_at):
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    starts_at = np.flatnonzero(begin[letters_at])
    within = np.arange(len(letters_at)) - np.repeat(
        starts_at, np.diff(np.append(starts_at, len(letters_at)))
    )
    within %= WORD_LETTERS
    first = np.flatnonzero(within == 0)
    lengths = np.diff(np.append(first, len(letters_at)))
    power = np.cumprod(np.full(WORD_LETTERS, 0x9E3779B97F4A7C15, np.uint64))
    values = _mixed(lower[codes[letters_at]].astype(np.uint64)) * power[within]
    hashes = np.add.reduceat(values, first)
    letters = np.add.reduceat((script[letters_at] != MARK).astype(np.int64), first)
    spoken = letters > 0
    return (letters_at[first] + base)[spoken], lengths[spoken], letters[spoken], hashes[spoken]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread bits of 64-bit numbers."""
    x = (x + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _features(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """(feature, word number) of the letter groups of words, by word; borders are letters."""
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    lower = _table()[1]
    sizes = lengths + 2
    ends = np.cumsum(sizes)
    word = np.repeat(np.arange(len(starts)), sizes)
    place = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
    source = np.repeat(starts, sizes) + place - 1
    edge = (place == 0) | (place == sizes[word] - 1)
    letters = np.where(edge, 1, lower[codes[np.clip(source, 0, len(codes) - 1)]]).astype(np.uint64)
    spread = _mixed(letters)
    power = np.uint64(0x9E3779B97F4A7C15)
    whole = np.add.reduceat(spread * (place + 1).astype(np.uint64) ** np.uint64(3), ends - sizes)
    found, owner = [_mixed(whole)], [np.arange(len(starts))]
    for n in GRAMS:
        fits = np.flatnonzero(place + n <= sizes[word])
        gram = np.full(len(fits), n, np.uint64)
        for i in range(n):
            gram = gram * power + spread[fits + i]
        found.append(_mixed(gram))
        owner.append(word[fits])
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return (np.concatenate(found)[order] % np.uint64(FEATURES)).astype(np.int64), owner[order]


def _counts(texts: list[str], lang: np.ndarray, n_langs: int) -> np.ndarray:
    """Features and letters by script of texts, a row per language."""
    words = _Words(texts)
    counts = np.zeros((n_langs, FEATURES + MARK + 1), np.int64)
    spoken = lang[words.text]
    # How often each distinct word occurs in each language.
    often = np.zeros((n_langs, len(words.first)), np.int64)
    np.add.at(often, (spoken, words.distinct), 1)
    features, word = _features(words.codes, words.starts[words.first], words.lengths[words.first])
    script = _table()[0][words.codes[words.starts]] if len(words.starts) else words.starts
    for i in range(n_langs):
        counts[i, :FEATURES] = np.bincount(features, often[i, word], FEATURES)
        mine = spoken == i
        counts[i, FEATURES:] = np.bincount(script[mine], words.letters[mine], MARK + 1)
    return counts


def _labelled(model: LanguageModel, texts: list[str]):
    """Arrow columns lang_pred, score and spans."""
    n_texts, n_langs = len(texts), len(model.langs)
    words = _Words(texts)
    n_words = len(words.starts) if n_langs else 0
    if n_words:
        scores = model.word_scores(words.codes, words.starts[words.first], words.lengths[words.first])
        label = viterbi(scores, words.distinct, np.bincount(words.text, minlength=n_texts))
        cell = words.text * n_langs + label
        letters = np.bincount(cell, words.letters, n_texts * n_langs).reshape(n_texts, n_langs)
        total = np.zeros((n_texts, n_langs))
        for i in range(n_langs):
            total[:, i] = np.bincount(words.text, scores[words.distinct, i], n_texts)
        most = letters == letters.max(1, keepdims=True)
        pick = np.where(most, total, -np.inf).argmax(1)
        said = letters.sum(1)
        share = letters[np.arange(n_texts), pick] / np.maximum(said, 1)
        names = pa.array(model.langs).take(pa.array(pick, pa.int64(), mask=said == 0))
        first = np.flatnonzero(
            (np.diff(words.text, prepend=-1) != 0) | (np.diff(label, prepend=-1) != 0)
        )
        last = np.append(first[1:], n_words) - 1
        text = words.text[first]
        spans = [
            pa.array(words.starts[first] - words.text_starts[text]),
            pa.array(words.starts[last] + words.lengths[last] - words.text_starts[text]),
            pa.array(model.langs).take(pa.array(label[first].astype(np.int64))),
        ]
    else:
        names, share, text = pa.nulls(n_texts, pa.string()), np.zeros(n_texts), np.empty(0, np.int64)
        spans = [pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.string())]
    offsets = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=n_texts))))
    rows = pa.StructArray.from_arrays(spans, names=["start", "end", "lang"])
    listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)
    return names.fill_null(UNDETERMINED), pa.array(share, pa.float64()), listed


def viterbi(
    scores: np.ndarray, words: np.ndarray, sizes: np.ndarray, penalty: float = SWITCH_PENALTY
) -> np.ndarray:
    """The best label of each word; a change of label between neighbours costs ``penalty``.

    ``words`` are rows of ``scores``, text after text, ``sizes`` the words of each text.
    Texts are taken from long to short, so that at each step those still going on are the
    first ones, and one step is taken for all of them together. Equally good paths keep
    the label, then take the lower one.
    """
    firsts = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    firsts, sizes = firsts[order], sizes[order]
    longest = int(sizes[0]) if len(sizes) else 0
    going = np.searchsorted(-sizes, -np.arange(longest), side="left")
    at = np.concatenate(([0], np.cumsum(going)))
    best = np.zeros((len(sizes), scores.shape[1]), np.float32)
    switched = np.empty((at[-1], scores.shape[1]), bool)
    source = np.empty(at[-1], np.int16)
    rows = np.arange(len(sizes))
    for t in range(longest):
        m = going[t]
        now = best[:m]
        top = now.argmax(1)
        other = now[rows[:m], top] - penalty
        other = other[:, None]
        switched[at[t] : at[t + 1]] = now < other
        source[at[t] : at[t + 1]] = top
        now = np.maximum(now, other) + scores[words[firsts[:m] + t]]
        best[:m] = now - now.max(1, keepdims=True)
    label = np.empty(len(words), np.int16)
    current = best.argmax(1)
    for t in range(longest - 1, -1, -1):
        m = going[t]
        now = current[:m]
        label[firsts[:m] + t] = now
        step = switched[at[t] + rows[:m], now]
        current[:m] = np.where(step, source[at[t] : at[t + 1]], now)
    return label
