"""Token ids of whole texts by a public tokenizer, each distinct piece of text encoded once.

A byte-level tokenizer splits a text into words before it encodes them, and where it splits
shows from the characters beside the border: no token crosses from a visible character to
the space or line end after it, from a letter or digit to an ASCII sign, or from a single
line end to a letter. Texts are cut at those borders into units, which are slices of the
batch's own bytes. Only distinct units not seen lately are encoded; the ids of all others
are put in place by array operations. The result equals that of encoding the whole text.
Tokenizers of another kind encode texts whole.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

JOINED_UNITS = 128
MEMO_UNITS = 400_000

# A unit that is one word for certain: a space at most, then Latin letters.
_WORD = re.compile("(?: ?[A-Za-zÀ-ÖØ-öø-ɏ]+)")


def tokenizer_path(name: str) -> str:
    """Where this machine keeps a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of many texts at a time.

    Units seen lately are kept with their ids in arrays of at most ``MEMO_UNITS`` and one
    batch; beyond that the half used last stays. So memory is bounded however many distinct
    words a corpus has.
    """

    def __init__(self, path: str):
        self._cuts = False
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._encode = lambda texts: [model.encode(t, num_threads=1) for t in texts]
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self._encode = lambda texts: [
                e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            ]
            self._model = tokenizer.model
            self._added, self._stop = _added_tokens(path)
            self._cuts = self._stop is not None
        self._known = pa.array([], pa.large_string())
        self._ids = np.empty(0, "<u4")
        self._lengths = np.empty(0, np.int64)
        self._used = np.empty(0, np.int64)
        self._batch = 0

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text)."""
        if not self._cuts:
            ids = self._encode(texts.to_pylist())
            counts = np.fromiter(map(len, ids), np.int64, len(ids))
            return _flat(ids), counts
        codes, lengths, flat, counts = self._coded(texts)
        starts = np.cumsum(lengths) - lengths
        each = lengths[codes]
        before = np.cumsum(each) - each
        return flat[np.repeat(starts[codes] - before, each) + np.arange(each.sum())], counts

    def count(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of each text; the ids are not put together."""
        if not self._cuts:
            return np.fromiter(map(len, self._encode(texts.to_pylist())), np.int64, len(texts))
        return self._coded(texts)[3]

    def _coded(self, texts: pa.Array):
        """(unit of each place, ids per unit, ids of all units, number of ids of each text)."""
        data, offsets = _bytes_of(texts)
        odd = np.zeros(len(texts), bool)
        for content in self._added:
            odd |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        first = _unit_starts(data, offsets, odd)
        ends = np.append(first, len(data))
        units = pa.LargeStringArray.from_buffers(
            len(first), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)
        )
        coded = units.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        lengths, flat = self._units(coded.dictionary)
        total = np.concatenate([[0], np.cumsum(lengths[codes])])
        bounds = total[np.searchsorted(first, offsets)]
        return codes, lengths, flat, np.diff(bounds)

    def _units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each unit, ids of all in a row), from memory or encoded now."""
        self._batch += 1
        at = pc.index_in(units, self._known)
        new = units.filter(pc.is_null(at))
        ids = self._new_ids(new.to_pylist())
        at = pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        at[at < 0] = len(self._known) + np.arange(len(new))
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        self._known = pa.concat_arrays([self._known, new])
        self._ids = np.concatenate([self._ids, _flat(ids)])
        self._lengths = np.concatenate([self._lengths, lengths])
        self._used = np.concatenate([self._used, np.zeros(len(new), np.int64)])
        self._used[at] = self._batch
        found = self._take(at)
        if len(self._known) > MEMO_UNITS:
            kept = np.sort(np.argsort(self._used, kind="stable")[-(MEMO_UNITS // 2) :])
            self._lengths, self._ids = self._take(kept)
            self._known, self._used = self._known.take(pa.array(kept)), self._used[kept]
        return found

    def _take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = (np.cumsum(self._lengths) - self._lengths)[at]
        lengths = self._lengths[at]
        before = np.cumsum(lengths) - lengths
        return lengths, self._ids[np.repeat(starts - before, lengths) + np.arange(lengths.sum())]

    def _new_ids(self, units: list[str]) -> list[list[int]]:
        """Ids of each unit: words by the model alone, the others together, as texts."""
        out: list[list[int]] = [[]] * len(units)
        others, alone = [], []
        stop, stop_id = self._stop
        is_word, tokenize, table = _WORD.fullmatch, self._model.tokenize, _BYTE_LETTERS
        for i, u in enumerate(units):
            if is_word(u):
                word = u.encode().decode("latin-1").translate(table)
                out[i] = [t.id for t in tokenize(word)]
            elif stop in u:
                alone.append(i)
            else:
                others.append(i)
        for i, ids in zip(alone, self._encode([units[i] for i in alone]), strict=True):
            out[i] = ids
        groups = [others[k : k + JOINED_UNITS] for k in range(0, len(others), JOINED_UNITS)]
        joined = self._encode([stop.join(units[i] for i in g) for g in groups])
        for group, ids in zip(groups, joined, strict=True):
            ends = [k for k, t in enumerate(ids) if t == stop_id] + [len(ids)]
            start = 0
            for i, end in zip(group, ends, strict=True):
                out[i] = ids[start:end]
                start = end + 1
        return out


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    return Encoder(path)


def _flat(ids: list[list[int]]) -> np.ndarray:
    n = sum(map(len, ids))
    return np.fromiter((t for row in ids for t in row), "<u4", n)


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of large strings without nulls, and the place of each text in them."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    if data is None or len(texts) == 0:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _byte_classes() -> np.ndarray:
    kinds = np.zeros(256, np.uint8)
    kinds[[ord(" "), ord("\n")]] = _GAP
    kinds[33:127] = _SIGN
    for c in range(33, 127):
        if chr(c).isalnum():
            kinds[c] = _LETTER if chr(c).isalpha() else _DIGIT
    kinds[128:] = _WIDE
    return kinds


_GAP, _SIGN, _DIGIT, _LETTER, _WIDE = 1, 2, 3, 4, 5
_CLASS = _byte_classes()


def _unit_starts(data: np.ndarray, offsets: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """Where units begin: at texts that are not empty, and at borders inside texts.

    A text marked ``odd`` holds a special string, which must not be cut: only borders before
    white space count in it, as no special string has any.
    """
    n = len(data)
    starts = np.zeros(n, bool)
    starts[offsets[:-1][np.diff(offsets) > 0]] = True
    if n < 2:
        return np.flatnonzero(starts)
    kind = _CLASS[data]
    before, here = kind[:-1], kind[1:]
    gap = (here == _GAP) & (before >= _SIGN)
    sign = (here == _SIGN) & (before >= _DIGIT)
    # After a character of several bytes only where it is no white space for certain.
    wide = np.flatnonzero((gap | sign) & (before == _WIDE)) + 1
    letter, visible = _wide_before(data, wide)
    gap[wide - 1] &= visible
    sign[wide - 1] &= letter
    # A line end that follows something visible is a word of its own before a letter.
    line = (here[1:] == _LETTER) & gap[:-1] & (data[1:-1] == ord("\n"))
    inner = sign
    inner[1:] |= line
    for i in np.flatnonzero(odd):
        inner[offsets[i] : offsets[i + 1] - 1] = False
    starts[1:] |= gap | inner
    return np.flatnonzero(starts)


def _wide_before(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the character of several bytes that ends before each place is a letter from
    U+00C0 to U+024F, and whether it is visible at all; no where that would take a table."""
    one, two = data[at - 1], data[at - 2]
    three = data[np.maximum(at - 3, 0)]
    signs = (two == 0xC3) & ((one == 0x97) | (one == 0xB7))
    letter = ((two >= 0xC3) & (two <= 0xC8) & ~signs) | ((two == 0xC9) & (one < 0x90))
    pair = (two >= 0xC3) & (two <= 0xDF)
    triple = (two >= 0x80) & (two < 0xC0) & (
        ((three >= 0xE4) & (three <= 0xEE)) | ((three == 0xE3) & (two >= 0x81))
    )
    return letter, pair | triple


def _byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte: visible Latin-1 characters
    stand for themselves, the others follow from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_BYTE_LETTERS = _byte_letters()


def _added_tokens(path: str) -> tuple[list[str], tuple[str, int] | None]:
    """The strings that a tokenizer looks for first, and one special string among them that
    splits a text before it is encoded, with its id.

    None where the borders of units are not known to be safe for the tokenizer.
    """
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    before = model.get("pre_tokenizer") or {}
    added = model.get("added_tokens", [])
    safe = (
        model.get("normalizer") is None
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space")
        and not any(
            t["lstrip"] or t["rstrip"] or t["single_word"] or t["content"].split() != [t["content"]]
            or _WORD.fullmatch(t["content"])
            for t in added
        )
    )
    stop = next(((t["content"], t["id"]) for t in added if t["special"]), None) if safe else None
    return [t["content"] for t in added], stop
