"""Periodic runs of words: stretches that repeat one block of words again and again.

A run of period q is a longest stretch in which words q apart are equal, q being the
smallest such number. It has at least ``MIN_WORDS`` words and ``MIN_REPEATS`` periods, so
words of it agree with those q later over a guaranteed length, the overlap. Seeds are
k-grams of that length found again q words later in the same document.

Periods are looked for by octave, 2^j to 2^(j+1) - 1. All runs of an octave share its
smallest overlap, which with three periods or more is never below a period of that octave.
A k-gram inside a run then comes again exactly one period later and not before, so only an occurrence and the
next one are paired: n pairs at most, however often a word repeats. Seeds of equal lag
are extended from left to right; those that an extension has covered are passed over.

K-grams have exact names, made by doubling: equal names, equal words. A place whose k-gram
occurs once in its document can hold no longer one that repeats, and leaves. So the cost is
that of a few sorts of the words of a batch, for texts of any length and any content.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.batches import by_bytes

MIN_WORDS = 6
MIN_REPEATS = 4

RUN = "struct<start:bigint,length:bigint,period:bigint>"


def with_runs(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    min_repeats: int = MIN_REPEATS,
    report: str = "_runs",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with a struct column: (n_words, runs, collapsed).

    Words are what ASCII white space separates, numbered from 0. ``runs`` are all runs as
    (start, length, period) by start and period; ``collapsed`` are the words joined by one
    space without those that a run repeats, i.e. a run keeps its first period only.

    A null or empty text has no words, no runs and an empty ``collapsed``. A text is looked
    at as a whole, however long. Equal rows get equal results, other columns stay; an empty
    table gives no rows. A column named as ``report`` is an error.
    """
    if report.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"the documents have a column {report} already")
    if min_repeats < 3 or min_words < 3:
        raise ValueError("a run needs three periods and three words or more")
    result = f"struct<n_words:bigint,runs:array<{RUN}>,collapsed:string>"
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    packed = docs.select(row, F.col(f"`{text_col}`").cast("string").alias("text"))
    row_type = packed.schema["doc"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            found = _report(batch["text"].to_pylist(), min_words, min_repeats)
            yield pa.RecordBatch.from_arrays([batch["doc"], found], names=["doc", "report"])

    made = packed.mapInArrow(find, f"doc {row_type}, report {result}")
    return made.select("doc.*", F.col("report").alias(report))


def longest_run(runs: Column | str) -> Column:
    """The run with most words of an array of runs; ties go to the first, then shortest period."""
    order = F.transform(runs, lambda r: F.struct(-r["length"], r["start"], r["period"], r.alias("run")))
    return F.array_min(order)["run"]


def _report(texts: list[str | None], min_words: int, min_repeats: int) -> pa.Array:
    words, sizes = [], []
    for text in texts:
        # The white space of bytes is that of the contract: space and \t to \r.
        split = text.encode().split() if text else []
        words += split
        sizes.append(len(split))
    ends = np.cumsum(np.array(sizes, np.int64))
    firsts = ends - sizes
    starts, lengths, periods = find_runs(word_codes(words), ends, min_words, min_repeats)
    doc = np.searchsorted(ends, starts, side="right")
    drop = _repeated(len(words), starts, lengths, periods)
    touched = np.zeros(len(sizes), bool)
    touched[doc] = True
    collapsed = []
    for i, (first, end) in enumerate(zip(firsts.tolist(), ends.tolist())):
        kept = words[first:end]
        if touched[i]:
            kept = [kept[j] for j in np.flatnonzero(~drop[first:end]).tolist()]
        collapsed.append(b" ".join(kept))
    offsets = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=len(sizes)))))
    runs = pa.StructArray.from_arrays(
        [pa.array(starts - firsts[doc]), pa.array(lengths), pa.array(periods)],
        names=["start", "length", "period"],
    )
    return pa.StructArray.from_arrays(
        [
            pa.array(sizes, pa.int64()),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs),
            pa.array(collapsed, pa.binary()).cast(pa.string()),
        ],
        names=["n_words", "runs", "collapsed"],
    )


def word_codes(words: list[bytes]) -> np.ndarray:
    """A number per word, equal for equal words."""
    coded = pa.array(words, pa.large_binary()).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def find_runs(
    codes: np.ndarray, ends: np.ndarray, min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of documents laid end to end, by start and period.

    ``ends`` are the documents' ends; no run goes across one.
    """
    n = len(codes)
    found: list[tuple[int, int, int]] = []
    if n:
        doc = np.searchsorted(ends, np.arange(n), side="right")
        grams = _Grams(doc, codes)
        octave = 1
        while len(grams.places):
            # The smallest overlap of this octave and those to come; with three periods or
            # more it is no shorter than any period of this one.
            lags = range(octave, max(octave + 1, min_words))
            k = min(max(min_words, min_repeats * q) - q for q in lags)
            at, lag = grams.next_occurrences(k)
            near = (lag >= octave) & (lag < 2 * octave)
            found += _extended(codes, doc, at[near], lag[near], min_words, min_repeats)
            octave *= 2
    runs = np.array(sorted(found), np.int64).reshape(-1, 3)
    return runs[:, 0], runs[:, 2], runs[:, 1]


class _Grams:
    """Names of the 2^m-grams of each place that may still begin a repeated one."""

    def __init__(self, doc: np.ndarray, codes: np.ndarray):
        self._doc = doc
        self._size = 1
        width = int(codes.max()) + 1
        # The document is part of the name: only repeats inside one count.
        self._name(np.arange(len(codes)), doc * width + codes)

    def _name(self, places: np.ndarray, keys: np.ndarray) -> None:
        names, counts = _ranked(keys)
        again = counts[names] > 1
        self.places = places[again]
        # A place that is not listed, or beyond the end, has no name.
        self._names = np.full(len(self._doc) + 1, -1, np.int64)
        self._names[self.places] = names[again]

    def _pair(self, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and keys of the grams made of one here and one ``distance`` further on."""
        after = self._names[np.minimum(self.places + distance, len(self._doc))]
        whole = after >= 0
        places = self.places[whole]
        return places, self._names[places] * (len(self._doc) + 1) + after[whole]

    def next_occurrences(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(place, distance to the next one) of k-grams; k grows from call to call."""
        while 2 * self._size <= k and len(self.places):
            self._name(*self._pair(self._size))
            self._size *= 2
        if k == self._size:
            places, keys = self.places, self._names[self.places]
        else:
            places, keys = self._pair(k - self._size)
        order = np.argsort(keys, kind="stable")
        places, keys = places[order], keys[order]
        same = keys[1:] == keys[:-1]
        return places[:-1][same], (places[1:] - places[:-1])[same]


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each key among the distinct ones, and how often each of those occurs."""
    if not len(keys):
        return keys, keys
    _, names, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return names, counts


def _extended(codes, doc, at, lag, min_words, min_repeats) -> list[tuple[int, int, int]]:
    """Runs (start, period, length) from seeds: ``at`` is equal to what is ``lag`` further on."""
    order = np.lexsort((at, lag))
    at, lag = at[order], lag[order]
    # A seed one place after another of its lag is covered by that one's extension.
    head = np.ones(len(at), bool)
    head[1:] = (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + 1)
    furthest: dict[int, int] = {}
    runs = []
    for i, q in zip(at[head].tolist(), lag[head].tolist()):
        if i < furthest.get(q, -1):
            continue
        left = i - _agreeing(codes, doc, i - 1, i - 1 + q, -1)
        right = i + _agreeing(codes, doc, i, i + q, 1)
        furthest[q] = right
        length = right - left + q
        if length >= max(min_words, min_repeats * q):
            runs.append((left, q, length))
    return runs


def _agreeing(codes, doc, i: int, j: int, step: int) -> int:
    """How many words from ``i`` on equal those from ``j`` on, looked at in growing slices."""
    n, done, width = len(codes), 0, 64
    while True:
        room = (i + 1 if step < 0 else n - j) - done
        width = min(width, room)
        if width <= 0:
            return done
        a, b = i + step * done, j + step * done
        if step < 0:
            left, right = slice(a - width + 1, a + 1), slice(b - width + 1, b + 1)
        else:
            left, right = slice(a, a + width), slice(b, b + width)
        equal = (codes[left] == codes[right]) & (doc[left] == doc[right])
        if step < 0:
            equal = equal[::-1]
        if not equal.all():
            return done + int(np.argmin(equal))
        done += width
        width *= 2


def _repeated(n: int, starts, lengths, periods) -> np.ndarray:
    """Whether each word lies in some run behind that run's first period."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts + periods, 1)
    np.add.at(edges, starts + lengths, -1)
    return np.cumsum(edges)[:-1] > 0
