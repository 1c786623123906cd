"""Benchmark passages in training documents: find them, report them, cut them out.

The test items become a broadcast set of window hashes, sorted, with the items' words as
plain bytes beside it. Each task hashes the words of its documents, rolls the hashes over
windows, looks these up in the set, and compares every find word by word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.batches import by_bytes, free_name, written

WINDOW_WORDS = 10
# Bounds of the items that one broadcast holds; about 20 bytes a word and the text itself.
BLOCK_BYTES = 16 << 20
BLOCK_WORDS = 2 << 20
# A larger benchmark is matched in several passes, this many broadcasts at a time.
BLOCKS_AT_ONCE = 4
# In UTF-8 with A-Z in lower case: digits, a-z and every character beyond ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_WORD_SQL = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_IN_WORD = np.array([_WORD.match(bytes([b])) is not None for b in range(256)])
_PART_BYTES = 1 << 20
_FILTER_BITS = 22
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTE_BASE = 0xBF58476D1CE4E5B9
HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n - 1 of a base and of its inverse, both modulo 2**64."""
    out = []
    for base in (_BYTE_BASE, pow(_BYTE_BASE, -1, 1 << 64)):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


class Words:
    """The words of some texts in a row: their hashes, places in ``raw``, and texts."""

    def __init__(self, texts: Sequence[bytes]):
        self.raw = b"\n".join(texts).lower()
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.begins = np.cumsum(sizes + 1) - sizes - 1
        parts = list(self._parts())
        columns = zip(*parts) if parts else [np.empty(0, np.int64)] * 3
        self.starts, self.ends, hashes = (np.concatenate(c) if parts else c for c in columns)
        self.hashes = hashes.astype(np.uint64)
        self.text = np.searchsorted(self.begins, self.starts, side="right") - 1

    def _parts(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(starts, ends, hashes) of the words of about ``_PART_BYTES`` at a time."""
        codes = np.frombuffer(self.raw, np.uint8)
        at = 0
        while at < len(codes):
            stop = at + _PART_BYTES
            # A word is in one part.
            while stop < len(codes) and _IN_WORD[codes[stop]]:
                stop += 1
            part = codes[at:stop]
            inside = np.concatenate([[False], _IN_WORD[part], [False]])
            edges = np.flatnonzero(inside[1:] != inside[:-1])
            starts, ends = edges[::2], edges[1::2]
            size = max(_PART_BYTES, 1 << int(len(part)).bit_length())
            up, down = _powers(size)
            sums = np.concatenate([[np.uint64(0)], np.cumsum((part + np.uint64(1)) * up[: len(part)])])
            yield starts + at, ends + at, (sums[ends] - sums[starts]) * down[starts]
            at = stop

    def window(self, at: int, size: int) -> bytes:
        starts, ends = self.starts[at : at + size].tolist(), self.ends[at : at + size].tolist()
        return b" ".join([self.raw[a:b] for a, b in zip(starts, ends)])

    def rolled(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions of the windows of ``size`` words inside one text, their hashes)."""
        if len(self.hashes) < size:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        at = np.flatnonzero(self.text[size - 1 :] == self.text[: len(self.text) - size + 1])
        return at, _rolling(self.hashes, size)[at]


class Windows:
    """The windows of some items: sorted hashes, where each begins, and the items' words.

    An item of fewer than ``width`` words is one window; one without words has none.
    """

    def __init__(self, items: Sequence[tuple[str, str]], width: int):
        self.names = [name for name, _ in items]
        words = Words([text.encode() for _, text in items])
        lengths = np.bincount(words.text, minlength=len(items))
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in np.unique(np.minimum(lengths[lengths > 0], width)).tolist():
            at, hashes = words.rolled(size)
            wanted = lengths[words.text[at]]
            mine = (wanted >= width) if size == width else (wanted == size)
            at, hashes = at[mine], hashes[mine]
            order = np.lexsort((words.text[at], hashes))
            at, hashes = at[order], hashes[order]
            # An item that repeats a window needs it once.
            text = words.text[at]
            again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])) + 1
            same = [i for i in again.tolist() if words.window(at[i], size) == words.window(at[i - 1], size)]
            at, hashes = np.delete(at, same), np.delete(hashes, same)
            near = np.zeros(1 << min(_FILTER_BITS, 3 + len(hashes).bit_length()), bool)
            near[_top(hashes, near)] = True
            self.by_size[size] = near, hashes, at.astype(np.int32)
        self.words = words
        words.hashes = None
        words.starts, words.ends = words.starts.astype(np.int32), words.ends.astype(np.int32)
        # The item of a window is looked up by its place.
        words.text = None

    def find(self, words: Words) -> Iterator[tuple[int, int, frozenset[str]]]:
        """(position, width, items) of each window found in some texts."""
        known: dict[bytes, frozenset[str]] = {}
        for size, (near, hashes, places) in self.by_size.items():
            at, rolled = words.rolled(size)
            maybe = near[_top(rolled, near)]
            at, rolled = at[maybe], rolled[maybe]
            low = np.searchsorted(hashes, rolled, side="left")
            high = np.searchsorted(hashes, rolled, side="right")
            hit = high > low
            known.clear()
            for a, i, j in zip(at[hit].tolist(), low[hit].tolist(), high[hit].tolist()):
                window = words.window(a, size)
                items = known.get(window)
                if items is None:
                    found = (p for p in places[i:j].tolist() if self.words.window(p, size) == window)
                    items = known[window] = frozenset(map(self._item, found))
                if items:
                    yield a, size, items

    def _item(self, place: int) -> str:
        start = self.words.starts[place]
        return self.names[int(np.searchsorted(self.words.begins, start, side="right")) - 1]


def with_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = WINDOW_WORDS,
    item_col: str = "item_id",
    cut: bool = False,
    keep: Sequence[str] | None = None,
    hits: str = "_hits",
) -> DataFrame:
    """``docs`` with a column ``hits``: (n_words, spans, items) of each row; no shuffle.

    ``spans`` are the [start, end) word positions covered by windows of any item, merged;
    ``items`` the sorted ids of the items found, as text. With ``cut`` the spans are taken
    out of ``text``, each from its first to its last word. ``keep`` names the columns to
    return, all by default.

    Null texts have no words. Items without id or words match nothing, items that share an
    id count as one, an empty benchmark hits nothing. Repeated rows are judged each. The
    items are broadcast in blocks of about ``BLOCK_WORDS`` words and ``BLOCK_BYTES`` of
    text, an item being in one block whole. All rows meet one block after another; every
    ``BLOCKS_AT_ONCE`` blocks they are stored, so that no more sets are in memory at a time.
    """
    if hits in docs.columns:
        raise ValueError(f"the documents already have a column {hits}")
    named = benchmark.select(
        F.col(item_col).cast("string").alias("item"), F.col("text").alias("text")
    ).dropna()
    total_bytes, total_words = named.agg(
        F.coalesce(F.sum(F.octet_length("text")), F.lit(0)),
        F.coalesce(F.sum(F.regexp_count("text", F.lit(_WORD_SQL))), F.lit(0)),
    ).head()
    blocks = max(1, -(-total_bytes // BLOCK_BYTES), -(-total_words // BLOCK_WORDS))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    keep = list(docs.columns if keep is None else keep)
    found = docs.withColumn(hits, F.lit(None).cast(HITS))
    for b in range(blocks):
        items = [tuple(r) for r in named.where(block == b).toLocalIterator()]
        windows = docs.sparkSession.sparkContext.broadcast(Windows(items, width))
        last = b == blocks - 1
        names = [*(keep if last else docs.columns), hits]
        schema = T.StructType([found.schema[n] for n in names])
        scan = partial(_scan, windows=windows, names=names, hits_col=hits, cut=cut and last)
        found = found.mapInArrow(scan, schema)
        if not last and b % BLOCKS_AT_ONCE == BLOCKS_AT_ONCE - 1:
            found = written(found, "benchmark-hits")
    return found


def hit_words(hits: str = "_hits"):
    """Number of words inside the spans of a row."""
    return F.aggregate(
        f"{hits}.spans", F.lit(0).cast("long"), lambda total, s: total + s[1] - s[0]
    )


def hit_report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and a digest of the items per row of :func:`with_hits`."""
    n_hit = hit_words()
    return found.select(
        id_col,
        "_hits.n_words",
        n_hit.alias("n_hit"),
        F.size("_hits.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "_hits.items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def without_passages(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW_WORDS) -> DataFrame:
    """Documents with all benchmark passages cut out; those left without a word go.

    Rows that never had a word stay as they are.
    """
    hits = free_name(docs, "_hits")
    found = with_hits(docs, benchmark, width, cut=True, hits=hits)
    n_hit = hit_words(hits)
    return found.where((n_hit == 0) | (n_hit < F.col(f"{hits}.n_words"))).drop(hits)


def _top(hashes: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Places of hashes in a filter, by their highest bits."""
    return (hashes >> np.uint64(65 - len(near).bit_length())).astype(np.int64)


def _rolling(values: np.ndarray, size: int) -> np.ndarray:
    n = len(values) - size + 1
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out = out * _BASE + values[j : j + n]
    return out


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _without(text: str, spans: list[list[int]]) -> str:
    """``text`` without its spans of words."""
    raw = text.encode()
    places = [m.span() for m in _WORD.finditer(raw.lower())]
    kept, at = [], 0
    for start, end in spans:
        kept.append(raw[at : places[start][0]])
        at = places[end - 1][1]
    return b"".join([*kept, raw[at:]]).decode()


def _scan(batches, windows, names, hits_col, cut):
    book: Windows = windows.value
    hits_type = pa.struct(
        [
            ("n_words", pa.int64()),
            ("spans", pa.list_(pa.list_(pa.int64()))),
            ("items", pa.list_(pa.string())),
        ]
    )
    for batch in by_bytes(batches, "text"):
        texts = batch["text"].to_pylist()
        words = Words([(text or "").encode() for text in texts])
        counts = np.bincount(words.text, minlength=len(texts)).tolist()
        first = np.searchsorted(words.text, np.arange(len(texts)))
        spans: dict[int, list[list[int]]] = {}
        items: dict[int, set[str]] = {}
        for at, size, found in book.find(words):
            doc = int(words.text[at])
            start = at - int(first[doc])
            spans.setdefault(doc, []).append([start, start + size])
            items.setdefault(doc, set()).update(found)
        hits = []
        for doc, earlier in enumerate(batch[hits_col].to_pylist()):
            earlier = earlier or {"spans": [], "items": []}
            all_spans = _merged([*earlier["spans"], *spans.get(doc, [])])
            all_items = sorted({*earlier["items"], *items.get(doc, ())})
            hits.append({"n_words": counts[doc], "spans": all_spans, "items": all_items})
            if cut and all_spans:
                texts[doc] = _without(texts[doc], all_spans)
        columns = {n: batch[n] for n in names if n != hits_col}
        if cut and "text" in columns:
            columns["text"] = pa.array(texts, batch["text"].type)
        columns[hits_col] = pa.array(hits, hits_type)
        yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)
