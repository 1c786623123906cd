"""Languages: paths against all paths, spans of mixed texts, held-out documents."""

import itertools
import zlib

import numpy as np
import pytest
from plain import DIR

from clickloom.llm import languages
from clickloom.llm.queries import QUERIES

RUSSIAN = "Съешь же ещё этих мягких французских булок да выпей чаю "
ENGLISH = "the quick brown fox jumps over the lazy dog and then he sleeps "
GERMAN = "der schnelle braune fuchs springt und über den faulen hund nicht "


@pytest.fixture(scope="module")
def model(spark):
    rows = []
    for n, (lang, text) in enumerate([("en", ENGLISH), ("de", GERMAN), ("ru", RUSSIAN)] * 8):
        rows.append((n, text * 3, lang))
    rows += [(100, ENGLISH, None), (101, None, "en"), (None, GERMAN, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return languages.fit_languages(docs)


def test_paths_equal_the_best_of_all_paths():
    rng = np.random.default_rng(3)
    for _ in range(60):
        n_langs, penalty = int(rng.integers(1, 4)), float(rng.choice([0.5, 2.0, 8.0]))
        sizes = rng.integers(0, 7, 5)
        scores = rng.normal(size=(9, n_langs)).astype(np.float32) * 3
        words = rng.integers(0, 9, sizes.sum())
        label = languages.viterbi(scores, words, sizes, penalty)
        at = 0
        for n in sizes:
            mine = words[at : at + n]

            def worth(path):
                changes = sum(a != b for a, b in zip(path, path[1:]))
                return sum(scores[w, x] for w, x in zip(mine, path)) - penalty * changes

            best = max(worth(p) for p in itertools.product(range(n_langs), repeat=int(n)))
            assert worth(label[at : at + n].tolist()) == pytest.approx(best, abs=1e-4)
            at += n


def test_spans_of_a_mixed_text(spark, model, make_docs):
    text = ENGLISH * 2 + "— 12. " + GERMAN * 2 + RUSSIAN + ENGLISH
    found = languages.predicted_languages(make_docs([(1, text)]), model).head()
    said = [(text[s["start"] : s["end"]], s["lang"]) for s in found["spans"]]
    assert [x for _, x in said] == ["en", "de", "ru", "en"]
    assert said[1][0] == (GERMAN * 2).strip() and said[2][0] == RUSSIAN.strip()
    assert found["lang_pred"] == "en" and 0.3 < found["score"] < 0.7


def test_a_foreign_word_does_not_break_a_span(model, spark, make_docs):
    text = ENGLISH + "und " + ENGLISH
    found = languages.predicted_languages(make_docs([(1, text)]), model).head()
    assert [s["lang"] for s in found["spans"]] == ["en"]


def test_edge_cases(spark, model, make_docs):
    rows = [
        (1, None), (2, ""), (3, "12 + 34 = 46 !?"), (4, "́̂"), (5, "булок"),
        (6, GERMAN), (6, GERMAN), (None, ENGLISH), (7, "été " * 3), (8, "x" * 3_000_000),
        (9, "漢字"), (10, ENGLISH * 20_000),
    ]
    found = languages.predicted_languages(make_docs(rows), model).collect()
    got = sorted((r["doc_id"] or 0, r["lang_pred"]) for r in found if r["doc_id"] not in (7, 8, 9))
    assert got == [(0, "en"), (1, "und"), (2, "und"), (3, "und"), (4, "und"), (5, "ru"), (6, "de"), (6, "de"), (10, "en")]
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[1]["score"] == 0 and by_id[3]["spans"] == []
    assert all(0 <= r["score"] <= 1 for r in found)
    # Scripts that nobody was seen to use leave all languages open.
    assert by_id[9]["lang_pred"] in model.langs
    assert len(by_id[10]["spans"]) == 1
    assert languages.predicted_languages(make_docs([]), model).count() == 0


def test_nothing_to_learn_from(spark, make_docs):
    docs = make_docs([(1, ENGLISH)], lang=None)
    model = languages.fit_languages(docs)
    assert model.langs == []
    found = languages.predicted_languages(docs, model).head()
    assert (found["lang_pred"], found["score"], found["spans"]) == ("und", 0.0, [])


def test_bounded_counts_take_a_part_of_each_language(spark, table):
    docs = table("documents")
    some, all_rows = languages.fit_languages(docs, 10), languages.fit_languages(docs)
    assert some.langs == all_rows.langs == ["de", "en", "es", "fr"]
    assert not np.array_equal(some.log_p, all_rows.log_p)


def test_held_out_documents(spark, table):
    rows = QUERIES["op13_languages"](spark, DIR).collect()
    docs = {r["doc_id"]: r for r in table("documents").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    held = [r for r in rows if r["held_out"]]
    right = [r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held]
    assert len(held) > 20 and np.mean(right) > 0.97
