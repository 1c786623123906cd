"""Quality scores of documents by a byte-level convolutional network."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.batches import by_bytes, texts_of
from clickloom.llm.byte_conv import ByteConv, train

# At most so many labelled documents of either label are learned from; each may have so
# many bytes on the driver, longer ones are not drawn.
SAMPLE_PER_LABEL = 1_500
SAMPLE_BYTES = 200_000
STEPS, BATCH, RATE = 400, 32, 0.004
FOLDS = 5
THRESHOLD = 0.3


def is_held_out(doc_id: Column | str) -> Column:
    """Whether a document belongs to the fold that is never learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0


def fit_quality(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> ByteConv:
    """A network fitted on a bounded sample of the labelled rows that are not held out.

    The sample holds the ``per_label`` rows of each label with the lowest hash of
    ``doc_id``. Rows with a null id or label, or another label than 0 and 1, and ids with
    both labels teach nothing; a null text is empty, repeats of an id count once. Without
    rows of both labels all documents get the same score.
    """
    given = (
        labels.where(F.col("quality").isin(0, 1) & ~is_held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
        .where(F.col("quality") == F.col("most"))
    )
    drawn = None
    for label in (0, 1):
        part = given.where(F.col("quality") == label).select("doc_id", "quality")
        part = part.orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)
        drawn = part if drawn is None else drawn.unionByName(part)
    # Two times per_label ids and labels: of known size.
    rows = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .where(F.octet_length("text") <= SAMPLE_BYTES)
        .join(F.broadcast(drawn), "doc_id")
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.min("quality").alias("quality"))
        .orderBy("doc_id")
        .toLocalIterator()
    )
    texts, marks = [], []
    for row in rows:
        texts.append(row["text"].encode())
        marks.append(row["quality"])
    return train(texts, np.array(marks, np.float32), STEPS, BATCH, RATE)


def quality_scores(docs: DataFrame, model: ByteConv) -> DataFrame:
    """Rows (doc_id, score, predicted), one for each row of ``docs``; no shuffle.

    The whole text is scored and nothing else is looked at; null and empty texts are scored
    as empty. An empty table gives no rows.
    """
    named = docs.select("doc_id", "text")
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = f"doc_id {named.schema['doc_id'].dataType.simpleString()}, score double"

    def score(batches):
        for batch in by_bytes(batches, "text", 1 << 20):
            texts = [t.encode() for t in texts_of(batch).to_pylist()]
            scores = pa.array(held.value.scores(texts), pa.float64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], scores], names=["doc_id", "score"])

    scored = named.mapInArrow(score, schema)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))

