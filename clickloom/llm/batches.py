"""Arrow batches inside a task, and where a job keeps tables between its stages."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from clickloom.sources.workspace import work_folder

BATCH_BYTES = 4 << 20


def by_bytes(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches where the bytes of a text column reach ``limit``; one row may exceed it.

    A null text counts as empty. Batches of equal bytes take equal time and memory,
    however unequal the texts are.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The texts of a batch as large strings, null as empty."""
    return pc.fill_null(batch[column].cast(pa.large_string()), "")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def written(df: DataFrame, purpose: str, **options) -> DataFrame:
    """Write ``df`` below the folder the cluster shares and read it again.

    What follows starts from files: it is not computed twice, and a lost executor costs
    no more than the task it ran.
    """
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path, **options)
    return df.sparkSession.read.schema(df.schema).parquet(path)
