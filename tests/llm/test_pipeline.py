import pytest
from plain import base_counts, cleaned_lines, hits, near_components, windows
from test_tokens import check_packing

import corpus_pipeline
from clickloom.llm.batches import written
from clickloom.llm.oracles import ORACLES
from clickloom.llm.queries import QUERIES

DIR = "/root/testdata/sf0.001"


def test_stages_match_plain_versions(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns = docs.columns
    states = [docs]
    for name, stage in corpus_pipeline.STAGES:
        states.append(written(stage(spark, states[-1], DIR), name))
    assert all(s.columns == columns for s in states[:-1])
    first, ruled, lined, near, clean, packed = ({r.doc_id: r for r in s.collect()} for s in states)

    assert set(ruled) <= {d for d, r in first.items() if not base_counts(r.text)[-1]}
    assert all(ruled[d] == first[d] for d in ruled)

    rows = [(r.doc_id, r.text, r.source) for r in ruled.values()]
    for (d, *_), (_, removed, text) in zip(rows, cleaned_lines(rows)):
        if removed and not text.strip():
            assert d not in lined
        else:
            assert lined[d].text == text and lined[d].n_chars == len(text)

    linked = near_components([(r.doc_id, r.text) for r in lined.values()], 5)
    assert set(near) == {d for d, (n, c) in linked.items() if c == d}
    assert all(near[d] == lined[d] for d in near)

    bench = spark.read.parquet(f"{DIR}/benchmark.parquet").collect()
    found = windows([(r.item_id, r.text) for r in bench])
    for d, r in near.items():
        words, hit, _ = hits(r.text, found)
        if hit and len(hit) == len(words):
            assert d not in clean
        elif not hit:
            assert clean[d] == r
        else:
            assert clean[d].n_chars == len(clean[d].text) < r.n_chars
            assert not set(hits(clean[d].text, found)[1]) or len(hit) > 0

    check_packing([(r.doc_id, r.text) for r in clean.values()], states[-1].collect(), 2048)


def test_run_is_all_stages(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "work_folder", lambda spark, name: f"{tmp_path}/{name}")
    packed = corpus_pipeline.run(spark, DIR)
    assert set(packed.columns) == {
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
    }
    assert [f.name for f in tmp_path.iterdir()] == ["decontamination"]
    kept = spark.read.parquet(f"{tmp_path}/decontamination")
    assert packed.select("doc_id").distinct().count() == kept.count()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    want = con.sql(ORACLES[name])
    found = QUERIES[name](spark, DIR).select(*want.columns)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want.fetchall()))


def test_every_operator_has_its_query():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
