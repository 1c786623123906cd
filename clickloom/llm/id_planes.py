"""Token ids in a compact file format: chunks of blocks, each transposed to planes.

A table is a folder of Parquet files with one row per chunk. A chunk holds whole documents,
its ids cut into blocks of a fixed number of 32-bit ids. Each block is transposed so that
the first bytes (or bits) of all its ids lie together, then the second, and so on; each
plane is compressed by zstandard on its own. The high planes of a vocabulary of 50,000 are
all zero and cost next to nothing. The chunk index (the documents with their places, the
number of ids, the sizes of the planes) lies beside the payload in columns of its own, so
that looking for documents reads no payload.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.llm.batches import by_bytes, texts_of
from clickloom.llm.tokens import encoder, tokenizer_path

BLOCK_IDS = 16_384
CHUNK_IDS = 8 * BLOCK_IDS
# A row of 16 bytes for each task that wrote; beyond this many they join by shuffle.
BROADCAST_SHARDS = 1_000_000
PLANES = {"byte": 4, "bit": 32}
CHUNKS = """shard int, chunk int, shard_start long, n_ids long, planes string,
    block_ids int, doc_ids array<long>, doc_lengths array<long>,
    plane_sizes array<int>, payload binary"""


def to_planes(block: np.ndarray, planes: str = "byte") -> list[bytes]:
    """The planes of a block of ids, lowest byte or bit first."""
    as_bytes = np.ascontiguousarray(block, "<u4").view(np.uint8).reshape(-1, 4)
    if planes == "byte":
        return [np.ascontiguousarray(as_bytes[:, p]).tobytes() for p in range(4)]
    bits = np.unpackbits(as_bytes, axis=1, bitorder="little")
    return [np.packbits(bits[:, p], bitorder="little").tobytes() for p in range(32)]


def from_planes(parts: list[bytes], n: int, planes: str = "byte") -> np.ndarray:
    """The ids of a block of ``n`` from its planes."""
    rows = np.stack([np.frombuffer(p, np.uint8) for p in parts])
    if planes == "bit":
        bits = np.unpackbits(rows, axis=1, count=n, bitorder="little")
        rows = np.packbits(bits.T, axis=1, bitorder="little").T
    return np.ascontiguousarray(rows.T).view("<u4").reshape(-1)


def write_token_planes(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int | None = 0,
    planes: str = "byte",
    block_ids: int = BLOCK_IDS,
    chunk_ids: int = CHUNK_IDS,
) -> None:
    """Encode (doc_id, text) rows and write them in ascending ``doc_id`` order.

    Rows are dealt by ranges of ``doc_id`` and sorted in each; equal ids are ordered by
    text, null ids come first, a null text is empty. ``end_id`` closes each document.
    A chunk is closed at a document's end once it has ``chunk_ids`` ids. An empty table
    gives a folder without chunks. Other columns are not read.
    """
    if planes not in PLANES:
        raise ValueError(f"planes must be one of {sorted(PLANES)}")
    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    pack = partial(
        _write, tokenizer=tokenizer, end_id=end_id, planes=planes,
        block_ids=block_ids, chunk_ids=chunk_ids,
    )
    ordered.mapInArrow(pack, CHUNKS).write.parquet(path)


def read_token_planes(spark: SparkSession, path: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids) of a written folder.

    ``start`` is the number of ids before the document in the whole table, ``ids`` its ids
    as little-endian 32-bit integers. Chunks are decoded where they are read, without a
    shuffle of ids; only one total per shard is summed up over all shards.
    """
    chunks = spark.read.schema(CHUNKS).parquet(path)
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("total"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "shard", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before")
    )
    if starts.count() <= BROADCAST_SHARDS:
        starts = F.broadcast(starts)
    decoded = chunks.mapInArrow(_read, "shard int, doc_id long, local long, n_tokens long, ids binary")
    return decoded.join(starts, "shard").select(
        "doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids"
    )


def _write(batches, tokenizer, end_id, planes, block_ids, chunk_ids):
    shard = TaskContext.get().partitionId()
    compress = zstandard.ZstdCompressor(level=3).compress
    chunk, done = 0, 0
    doc_ids, lengths, parts = [], [], []

    def close():
        ids = np.concatenate(parts) if parts else np.empty(0, "<u4")
        packed = [
            compress(plane)
            for at in range(0, len(ids), block_ids)
            for plane in to_planes(ids[at : at + block_ids], planes)
        ]
        row = {
            "shard": shard, "chunk": chunk, "shard_start": done, "n_ids": len(ids),
            "planes": planes, "block_ids": block_ids, "doc_ids": list(doc_ids),
            "doc_lengths": list(lengths), "plane_sizes": [len(p) for p in packed],
            "payload": b"".join(packed),
        }
        return pa.RecordBatch.from_pylist([row], schema=_CHUNK_SCHEMA), len(ids)

    held = 0
    for batch in by_bytes(batches, "text"):
        ids, counts = encoder(tokenizer_path(tokenizer)).encode(texts_of(batch))
        if end_id is not None:
            ids = np.insert(ids, np.cumsum(counts), end_id).astype("<u4")
            counts = counts + 1
        ends = np.cumsum(counts)
        for doc_id, n, end in zip(batch["doc_id"].to_pylist(), counts.tolist(), ends.tolist()):
            doc_ids.append(doc_id)
            lengths.append(n)
            parts.append(ids[end - n : end])
            held += n
            if held >= chunk_ids:
                made, n_ids = close()
                yield made
                chunk, done, held = chunk + 1, done + n_ids, 0
                doc_ids, lengths, parts = [], [], []
    if doc_ids:
        yield close()[0]


def _read(batches):
    expand = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for row in batch.to_pylist():
            n, planes, block_ids = row["n_ids"], row["planes"], row["block_ids"]
            per_block = PLANES[planes]
            cuts = np.concatenate([[0], np.cumsum(row["plane_sizes"], dtype=np.int64)])
            payload = row["payload"]
            blocks = []
            for b, at in enumerate(range(0, n, block_ids)):
                size = min(block_ids, n - at)
                plane_bytes = size if planes == "byte" else -(-size // 8)
                parts = [
                    expand(payload[cuts[k] : cuts[k + 1]], max_output_size=plane_bytes)
                    for k in range(b * per_block, (b + 1) * per_block)
                ]
                blocks.append(from_planes(parts, size, planes))
            ids = (np.concatenate(blocks) if blocks else np.empty(0, "<u4")).tobytes()
            ends = np.cumsum(row["doc_lengths"], dtype=np.int64)
            starts = ends - np.asarray(row["doc_lengths"], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["shard"]] * len(ends), pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(starts + row["shard_start"]),
                    pa.array(ends - starts),
                    pa.array([ids[4 * s : 4 * e] for s, e in zip(starts, ends)], pa.binary()),
                ],
                names=["shard", "doc_id", "local", "n_tokens", "ids"],
            )


_CHUNK_SCHEMA = pa.schema(
    [
        ("shard", pa.int32()), ("chunk", pa.int32()), ("shard_start", pa.int64()),
        ("n_ids", pa.int64()), ("planes", pa.string()), ("block_ids", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())), ("doc_lengths", pa.list_(pa.int64())),
        ("plane_sizes", pa.list_(pa.int32())), ("payload", pa.binary()),
    ]
)
