"""Token counts of whole texts."""

from __future__ import annotations

from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.batches import by_bytes, texts_of
from clickloom.llm.tokens import encoder, tokenizer_path


def token_counts(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (id, n_bytes, n_tokens), one for each row of ``docs``; no shuffle.

    ``tokenizer`` names a public vocabulary file (``.json`` or ``.model``). An Arrow function
    takes batches of about equal bytes, cuts long texts at safe borders and returns lengths
    only. Null and empty texts have 0 bytes and 0 tokens, a null id stays null, repeated
    rows are counted each, an empty table gives no rows, and other columns are not read.
    """
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {named.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long"
    return named.mapInArrow(partial(_count, tokenizer=tokenizer), schema)


def _count(batches, tokenizer):
    for batch in by_bytes(batches, "text"):
        texts = texts_of(batch)
        counts = encoder(tokenizer_path(tokenizer)).count(texts)
        sizes = pa.compute.binary_length(texts).cast(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], sizes, pa.array(counts, pa.int64())],
            names=["doc_id", "n_bytes", "n_tokens"],
        )
