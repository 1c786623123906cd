import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from plain import ids, tokenizer

from clickloom.llm import id_planes, tokens
from clickloom.llm.batches import by_bytes, work_folder
from clickloom.llm.packing import best_fit, crossover, evolve, packed_documents, rating, sequences
from clickloom.llm.token_counts import token_counts
from clickloom.llm.tokens import Encoder, tokenizer_path

NAME = "byte_bpe_50k.json"
PARTS = [*"ab Z09.,'s \n\n\t  \r\x0b\x0c\x1c\x85\xa0 ​　﻿é!|\0",
         "<|endoftext|>", " the", "'ll", "  ", "\n\n", "don't", " 's", "你好", "😀"]


def odd_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, 30))) for _ in range(n)]


def test_units_encode_as_whole_texts(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_UNITS", 500)
    texts = [*odd_texts(4000), "", " ", "\n", "a" * 5000]
    found, counts = Encoder(tokenizer_path(NAME)).encode(pa.array(texts, pa.large_string()))
    at = 0
    for text, n in zip(texts, counts):
        assert found[at : at + n].tolist() == ids(text), repr(text)
        at += n
    assert at == len(found)


def test_units_are_remembered_over_batches(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_UNITS", 300)
    rng = random.Random(11)
    parts = [*"ab'39,$-<|>\n \u00f1\u00d7\u00f7\u00df\u01c0\u024f\u0250\u00aa\u00b2\u3002\u30ab\u4e2d",
             "word", " Wörd", "end.", "'re", "<|endoftext|>", "\n\n", "\nLine", " (it's)", "***"]
    one = Encoder(tokenizer_path(NAME))
    for size in (1, 700, 0, 3000, 40):
        texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(size)]
        held = pa.array(["other", *texts, "more"], pa.large_string()).slice(1, size)
        found, counts = one.encode(held)
        want = [ids(t) for t in texts]
        assert counts.tolist() == one.count(held).tolist() == [len(w) for w in want]
        assert found.tolist() == [i for w in want for i in w]
        assert len(one._known) == len(one._lengths) == len(one._used) <= 300
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(tokens, "_added_tokens", lambda path: ([], None))
        assert Encoder(tokenizer_path(NAME)).encode(held)[0].tolist() == found.tolist()


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers_encode_whole(name):
    texts = ["Hello  there", "", "a\nb <|endoftext|> c"]
    counts = Encoder(tokenizer_path(name)).encode(pa.array(texts))[1].tolist()
    if name.endswith("json"):
        from tokenizers import Tokenizer

        one = Tokenizer.from_file(tokenizer_path(name))
        assert counts == [len(one.encode(t, add_special_tokens=False).ids) for t in texts]
    else:
        import sentencepiece

        one = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(name))
        assert counts == [len(one.encode(t)) for t in texts]


def test_batches_are_cut_by_bytes():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (5, 1, 1, 30, 2)] + [None]})
    assert [b.num_rows for b in by_bytes([batch], "text", 10)] == [3, 1, 2]


def test_token_counts(make_docs):
    rows = [(1, "one two"), (2, None), (3, ""), (None, "x\ny"), (1, "one two"), (4, "wörd " * 9000)]
    found = token_counts(make_docs(rows), NAME)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens"]
    want = [(d, len((t or "").encode()), len(ids(t))) for d, t in rows]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))
    assert token_counts(make_docs([]), NAME).count() == 0


@pytest.mark.parametrize("planes", ["byte", "bit"])
@pytest.mark.parametrize("n", [0, 1, 7, 64, 1000])
def test_planes_round_trip(planes, n):
    block = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint64).astype("<u4")
    parts = id_planes.to_planes(block, planes)
    assert len(parts) == id_planes.PLANES[planes]
    if n:
        assert (id_planes.from_planes(parts, n, planes) == block).all()


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_written_ids_come_back(spark, make_docs, planes):
    rows = [(5, "five five"), (2, None), (9, "x " * 700), (2, "two"), (None, "none"), (7, "")]
    rows += [(100 + i, t) for i, t in enumerate(odd_texts(200)) if "\0" not in t]
    path = work_folder(spark, "planes-test")
    id_planes.write_token_planes(make_docs(rows), path, NAME, 0, planes, block_ids=64, chunk_ids=300)
    found = id_planes.read_token_planes(spark, path).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, want = 0, []
    for d, t in order:
        row = [*ids(t), 0]
        want.append((d, start, len(row), zlib.crc32(np.array(row, "<u4").tobytes())))
        start += len(row)
    got = [(r.doc_id, r.start, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in found]
    assert sorted(got, key=lambda r: r[1]) == want
    assert spark.read.parquet(path).where("planes <> '%s'" % planes).count() == 0


def test_no_documents_give_no_chunks(spark, make_docs):
    path = work_folder(spark, "planes-test")
    id_planes.write_token_planes(make_docs([]), path, NAME)
    assert id_planes.read_token_planes(spark, path).count() == 0


def check_packing(rows, found, size):
    want = set()
    for d, t in rows:
        row = [*ids(t), 0]
        n = -(-len(row) // size)
        end = len(row) - (n - 1) * size
        at = 0
        for k in range(n):
            want.add((d, k, at, end - at, zlib.crc32(np.array(row[at:end], "<u4").tobytes())))
            at, end = end, end + size
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found]
    assert set(got) == want
    places = {}
    for r in found:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(places)


def test_packing(spark, table):
    docs = table("documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = packed_documents(docs, NAME).collect()
    n = check_packing(rows, found, 2048)
    assert len(found) == len({(r.doc_id, r.piece) for r in found})
    assert n <= -(-sum(r.length for r in found) // 2048) * 1.02 + 1


def test_packing_edges(spark, make_docs):
    rows = [(1, None), (2, ""), (3, "x " * 50), (4, "y"), (None, "z")]
    docs = make_docs([*rows, (4, "y")])
    found = packed_documents(docs, NAME, size=16, keep_ids=True)
    check_packing(rows, found.collect(), 16)
    assert found.where("doc_id = 4").count() == 2
    whole = {r.sequence_id: bytes(r.ids) for r in sequences(found).collect()}
    for r in found.collect():
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)
    assert packed_documents(make_docs([]), NAME).count() == 0


def test_islands_never_lose_to_best_fit():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 1400, 3000)
    start = best_fit(np.argsort(-lengths, kind="stable"), lengths, 2048)
    other = best_fit(rng.permutation(3000), lengths, 2048)
    child = crossover(start, other, lengths, 2048, rng)
    for p in (start, other, child):
        assert np.bincount(p, lengths).max() <= 2048 and np.bincount(p).min() > 0
    assert rating(evolve(lengths, 2048, rng), lengths, 2048)[0] <= start.max() + 1


def test_tokenizer_is_the_public_one():
    assert tokenizer().get_vocab_size() == 50257
