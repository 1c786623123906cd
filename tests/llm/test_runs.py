"""Periodic runs against the definition, word by word."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from plain import DIR

from clickloom.llm.periodic_runs import find_runs, with_runs
from clickloom.llm.queries import QUERIES


def _brute(words, min_words=6, min_repeats=4, lags=None):
    """(start, length, period) of all runs: stretches of equal words q apart, q smallest."""
    found = []
    for q in lags or range(1, len(words)):
        at = 0
        while at + q < len(words):
            if words[at] != words[at + q]:
                at += 1
                continue
            start = at
            while at + q < len(words) and words[at] == words[at + q]:
                at += 1
            length = at + q - start
            if length >= max(min_words, min_repeats * q):
                run = words[start : at + q]
                if not any(run[p:] == run[:-p] for p in range(1, q)):
                    found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]


@pytest.mark.parametrize(("min_words", "min_repeats"), [(6, 4), (3, 3), (9, 3), (4, 5)])
def test_runs_of_random_words_equal_brute_force(min_words, min_repeats):
    draw = random.Random(min_words * 10 + min_repeats)
    for _ in range(400):
        docs = []
        for _ in range(draw.randint(1, 4)):
            n, k = draw.randint(0, 60), draw.choice([1, 2, 2, 3, 5])
            words = [draw.randrange(k) for _ in range(n)]
            if n > 8 and draw.random() < 0.5:
                first = draw.randrange(n)
                period = draw.randint(1, max(1, (n - first) // 4))
                for i in range(first + period, n):
                    words[i] = words[i - period]
            docs.append(words)
        codes = np.array([w for d in docs for w in d], np.int64)
        ends = np.cumsum([len(d) for d in docs])
        got = find_runs(codes, ends, min_words, min_repeats)
        expected, base = [], 0
        for d in docs:
            expected += [(s + base, n, q) for s, n, q in _brute(d, min_words, min_repeats)]
            base += len(d)
        assert list(zip(*(x.tolist() for x in got))) == expected


def test_edge_cases(spark, make_docs):
    long_text = " ".join(["w"] * 200_000 + [str(i) for i in range(1000)] * 5)
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (4, "a a a a a"), (5, "a\ta\na  a a a"),
        (6, "a b a b a b a b"), (6, "a b a b a b a b"), (None, "x x x x x x"),
        (7, "é é é é é é z z"), (8, long_text),
    ]
    found = with_runs(make_docs(rows))
    assert found.columns == [*make_docs(rows).columns, "_runs"]
    got = sorted(
        (r["doc_id"] or 0, r["_runs"]["n_words"], [tuple(x) for x in r["_runs"]["runs"]], r["_runs"]["collapsed"])
        for r in found.where("doc_id is null or doc_id < 8").collect()
    )
    assert got == [
        (0, 6, [(0, 6, 1)], "x"), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""),
        (4, 5, [], "a a a a a"), (5, 6, [(0, 6, 1)], "a"),
        (6, 8, [(0, 8, 2)], "a b"), (6, 8, [(0, 8, 2)], "a b"),
        (7, 7, [(0, 6, 1)], "é z z"),
    ]
    last = found.where("doc_id = 8").head()["_runs"]
    assert [tuple(x) for x in last["runs"]] == [(0, 200_000, 1), (200_000, 5000, 1000)]
    assert len(last["collapsed"].split()) == 1001
    assert with_runs(make_docs([])).count() == 0
    with pytest.raises(ValueError, match="_runs"):
        with_runs(found)
    with pytest.raises(ValueError, match="three"):
        with_runs(make_docs(rows), min_repeats=2)


def test_query_equals_brute_force(spark, table):
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op12_periodic_runs"](spark, DIR).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    planted = 0
    docs = table("documents").select("doc_id", "text").collect()
    for doc_id, text in docs:
        words = [w.decode() for w in (text or "").encode().split()]
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        lags = range(1, n // 4 + 1)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            planted += 1
        # Whole-text comparisons per lag, so that only lags with some stretch are walked.
        codes = np.unique(np.array(words), return_inverse=True)[1] if n else np.empty(0)
        lags = [q for q in lags if _stretch(codes[:-q] == codes[q:]) >= max(6, 4 * q) - q]
        runs = _brute(words, lags=lags) if lags else []
        best = min(((-length, s, q) for s, length, q in runs), default=None)
        four = (None,) * 4 if best is None else (best[1], -best[0], best[2], -1000 * best[0] // best[2])
        said = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        expected = (len(runs), *four, sha(said), sha(" ".join(_collapsed(words, runs))))
        assert got[doc_id] == expected
    assert planted and len(got) == len(docs)


def _stretch(equal):
    """Length of the longest stretch of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], equal.astype(np.int8), [0]))))
    return int((edges[1::2] - edges[::2]).max(initial=0))
