import zlib

import numpy as np
from pyspark.sql import functions as F

from clickloom.llm.byte_conv import CHUNK, ByteConv, chunks_of, train
from clickloom.llm.quality_model import fit_quality, is_held_out, quality_scores


def test_chunks_cover_every_byte():
    for size in (0, 1, 447, 448, 511, 512, 513, 960, 961, 5000):
        _, starts, lengths, owner = chunks_of([b"x" * 7, b"y" * size])
        seen = {s + i for s, n, o in zip(starts, lengths, owner) if o == 1 for i in range(n)}
        assert seen == set(range(7, 7 + size)) and (lengths <= CHUNK).all()


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(3)
    model = ByteConv.new(rng)
    for name in model.names:
        setattr(model, name, getattr(model, name).astype(float))
    longer = bytes(rng.integers(97, 123, 1400, dtype=np.uint8))
    texts, labels = [b"some text", b"x", longer], np.array([1.0, 0.0, 1.0])
    grads = model.gradients(texts, labels)

    def loss():
        p = model.scores(texts)
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    for name, at in (("weights", 3), ("offset", 0), ("bias", 5), ("filters", (2, 4)), ("weights", 30), ("embedding", (101, 2))):
        values = getattr(model, name)
        before, step = values[at], 1e-4
        values[at] = before + step
        up = loss()
        values[at] = before - step
        down = loss()
        values[at] = before
        assert abs((up - down) / (2 * step) - grads[name][at]) < 1e-5, name


def test_scores_do_not_depend_on_the_batch():
    model = train([b"good words", b"BAD!!"] * 8, np.array([1.0, 0.0] * 8), 20, 8, 0.01)
    texts = [b"", b"abc", b"z" * 3000, "é".encode() * 400]
    assert np.allclose(model.scores(texts), [model.scores([t])[0] for t in texts], atol=1e-5)
    assert model.scores([]).shape == (0,)


def test_one_label_gives_one_score():
    model = train([b"a", b"b"], np.array([1.0, 1.0]), 5, 4, 0.01)
    assert np.allclose(model.scores([b"a", b"c", b""]), 0.75)


def test_held_out_accuracy(spark):
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet")
    docs, labels = read("documents"), read("labels")
    model = fit_quality(docs, labels, per_label=400)
    held = docs.join(labels.select("doc_id", "quality"), "doc_id").where(is_held_out("doc_id"))
    scores = {r.doc_id: r for r in quality_scores(held, model).collect()}
    rows = held.select("doc_id", "quality").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    good = [scores[r.doc_id].score for r in rows if r.quality == 1]
    bad = [scores[r.doc_id].score for r in rows if r.quality == 0]
    rank = np.mean([g > b for g in good for b in bad])
    right = np.mean([scores[r.doc_id].predicted == r.quality for r in rows])
    assert rank > 0.97 and right > 0.95


def test_edges(make_docs, spark):
    docs = make_docs([(1, "some words"), (2, None), (3, ""), (None, "x"), (1, "some words")], score=9)
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 0, 0), (2, None, 0), (3, 7, 0), (None, 1, 0)], "doc_id long, quality int, toxic int"
    )
    model = fit_quality(docs, labels)
    found = quality_scores(docs, model)
    assert found.columns == ["doc_id", "score", "predicted"] and found.count() == 5
    assert found.where(F.col("score").between(0, 1)).count() == 5
    assert quality_scores(docs.limit(0), model).count() == 0
