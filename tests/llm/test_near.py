import random

import numpy as np
import pandas as pd
import pytest
from plain import near_components

from clickloom.llm import near_dedup
from clickloom.llm.components import components
from clickloom.llm.near_dedup import link_sets, near_duplicates, sketch_forest, without_near_duplicates


def family(rng, size, copies, edits, tag):
    """Copies of one text, each with a few words of its own."""
    words = [f"{tag}{rng.randint(0, 10_000)}" for _ in range(size)]
    for c in range(copies):
        own = list(words)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(size)] = f"edit{rng.randint(0, 10**9)}"
        yield " ".join(own)


def check(found, rows, k):
    want = near_components(rows, k)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found}
    assert got == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


@pytest.mark.parametrize("k", [4, 5])
def test_components_match_all_pairs(table, k):
    docs = table("documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(near_duplicates(docs, k).collect(), rows, k)


@pytest.mark.parametrize("limit", [16, 1024])
def test_families_in_small_and_large_nodes(make_docs, monkeypatch, limit):
    monkeypatch.setattr(near_dedup, "NODE_SETS", limit)
    monkeypatch.setattr(near_dedup, "GROUP_SETS", limit)
    rng = random.Random(4)
    texts = [
        *family(rng, 150, 60, 3, "a"), *family(rng, 100, 40, 9, "b"), *family(rng, 60, 30, 6, "c"),
        *(f"{' '.join(f'shared{i}' for i in range(30))} own{j} {j}" for j in range(30)),
    ]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    check(near_duplicates(make_docs(rows), 4).collect(), rows, 4)


def test_edges(make_docs):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [
        (9, text), (3, text.upper()), (4, f"{text} more"), (5, None), (6, ""), (7, " \n"), (8, "one"),
        (10, "ONE"), (11, "two"), (None, text), (3, text),
    ]
    docs = make_docs(rows)
    found = near_duplicates(docs, 5).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == len(rows)
    assert {d: r.component_id for d, r in by_id.items()} == {
        9: 3, 3: 3, 4: 3, 5: 5, 6: 6, 7: 7, 8: 8, 10: 8, 11: 11, None: 3,
    }
    assert [by_id[d].n_shingles for d in (9, 5, 6, 7, 8)] == [36, 0, 0, 0, 1]
    left = without_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [3, 3, 5, 6, 7, 8, 11]
    assert near_duplicates(docs.limit(0)).count() == 0


def test_components_of_a_long_path(spark):
    n = 40
    edges = [(f"{i:03d}", f"{i + 1:03d}") for i in range(n)] + [("900", "901"), ("900", "900")]
    edges += [("007", "003"), (None, "001")]
    found = components(spark.createDataFrame(edges, "a string, b string")).collect()
    assert {r.node: r.root for r in found} == {f"{i:03d}": "000" for i in range(n + 1)} | {
        "900": "900", "901": "900",
    }
    assert len(found) == n + 3
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_forest_of_sketches_spans_similar_sets():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 256, (3, near_dedup.SKETCH), dtype=np.uint8)
    sketches = np.repeat(base, 5, axis=0)
    sketches[1::5, :10] += 1
    edges, distinct = sketch_forest(sketches)
    assert len(edges) == 12 and distinct == [0, 5, 10]


def far_ends():
    """Sketches p, a, b, q: p and a differ in 23 bytes, a and b in 44 (a pair of 0.8 that is
    estimated four sigma low), b and q in 23."""
    at = np.zeros((4, near_dedup.SKETCH), np.uint8)
    at[1:, :23] = 1
    at[2:, 23:67] = 1
    at[3:, 67:90] = 1
    return at


def test_a_pair_with_both_ends_stood_for_is_a_candidate():
    p, a, b, q = far_ends()
    node = {"parts": 2, "node": b"n", "radius": 0}
    rows = [("p", p, 0), ("a", a, 0), ("q", q, 1), ("b", b, 1)]
    frame = pd.DataFrame(
        [node | {"cls": c.encode(), "sketch": s.tobytes(), "p1": n, "p2": n} for c, s, n in rows]
    )
    found = pd.concat(near_dedup._compare_nodes([frame], last=False))
    assert {(r.a, r.b) for r in found.itertuples() if r.b} == {(b"p", b"a"), (b"q", b"b")}
    left = found[found["b"].isna()]
    assert dict(zip(left["a"], left["radius"])) == {b"p": 23, b"q": 23}
    below = frame.merge(left[["a", "radius"]], left_on="cls", right_on="a", suffixes=("_", ""))
    below = below.assign(parts=1, p1=0, p2=0)
    assert [(r.a, r.b) for r in pd.concat(near_dedup._compare_nodes([below], last=False)).itertuples()] == [
        (b"p", b"q")
    ]


def test_hops_of_standing_add_up():
    sketches = np.zeros((2, near_dedup.SKETCH), np.uint8)
    sketches[1, :20] = 1
    assert sketch_forest(sketches)[1] == [0]
    radius = np.array([0, 20])
    assert sketch_forest(sketches, radius) == ([(0, 1)], [0, 1]) and radius.tolist() == [0, 20]


def test_a_drifting_family_of_thousands(make_docs, monkeypatch):
    monkeypatch.setattr(near_dedup, "NODE_SETS", 64)
    monkeypatch.setattr(near_dedup, "GROUP_SETS", 256)
    rng = random.Random(6)
    words, texts = [f"w{i}" for i in range(80)], []
    for i in range(2500):
        words[rng.randrange(80)] = f"new{i}"
        words[rng.randrange(80)] = f"now{i}" if i % 50 == 0 else words[0]
        texts.append(" ".join(words))
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    check(near_duplicates(make_docs(rows), 4).collect(), rows, 4)


def test_links_are_exact_for_random_sets():
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(30):
        base = rng.integers(0, 1 << 40, 40, dtype=np.uint64)
        for _ in range(6):
            own = base.copy()
            own[: rng.integers(0, 8)] = rng.integers(0, 1 << 40, 1, dtype=np.uint64)
            sets.append(np.unique(own))
    links, *_ = link_sets(sets, 80)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in links:
        root[find(i)] = find(j)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both):
                assert find(i) == find(j)
