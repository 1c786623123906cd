"""Packing of documents into sequences by a grouping genetic algorithm.

Documents become pieces of at most the sequence length. A piece that fills a sequence is one;
the others are dealt into blocks of bounded size, and each block is solved on several
islands. An island keeps a few packings; a crossover takes whole well-filled sequences of one
packing into another, removes the duplicates they make, and places displaced pieces by best
fit. After each epoch every island sends its best packing to the next island of its block;
in the end the best packing of each block stands.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.batches import by_bytes, texts_of, written
from clickloom.llm.tokens import encoder, tokenizer_path

SEQUENCE_TOKENS = 2048
BLOCK_PIECES = 32_768
ISLANDS = 3
EPOCHS = 2
PACKINGS = 4
GENERATIONS = 10
# Share of the sequences of a packing that a crossover takes over at most.
INJECTED = 0.15
# A sequence this full counts as well filled.
WELL_FILLED = 0.98
PIECES = "pid long, doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    end_id: int | None = 0,
    size: int = SEQUENCE_TOKENS,
    keep_ids: bool = False,
) -> DataFrame:
    """Rows (pid, doc_id, piece, start, length, ids_crc32[, ids]) of all documents.

    A document's ids, closed by ``end_id``, stay whole up to ``size``; a longer one is cut
    from its end into pieces of ``size``, so only its first piece may be shorter. Null texts
    are empty; without ``end_id`` they have no piece. ``pid`` is unique and holds for one
    run, so write the pieces before they are used twice. Equal rows are pieces of their own,
    null ids stay null, an empty table gives none, other columns are not read.
    """
    named = docs.select(F.col("doc_id").cast("long"), "text")
    cut = partial(_cut, tokenizer=tokenizer, end_id=end_id, size=size, keep_ids=keep_ids)
    return named.mapInArrow(cut, PIECES + ", ids binary" * keep_ids)


def pack(pieces: DataFrame, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """``pieces`` with (sequence_id, offset): sequences of at most ``size`` tokens.

    ``pieces`` has ``pid``, unique, and ``length`` from 1 to ``size``, and has to come from
    files, as :func:`written` gives them. Places in a sequence are gapless from 0.
    """
    loose = pieces.where(F.col("length") < size)
    n_blocks = max(1, -(-loose.count() // BLOCK_PIECES))
    block = F.pmod(F.xxhash64("pid"), F.lit(n_blocks))
    blocks = (
        loose.select(block.alias("block"), F.struct("pid", "length").alias("p"))
        .groupBy("block")
        .agg(F.sort_array(F.collect_list("p")).alias("p"))
        .select("block", F.col("p.pid").alias("pids"), F.col("p.length").alias("lengths"))
    )
    blocks = written(blocks, "pack-blocks")
    best = _best(_evolved(blocks, n_blocks, size))
    placed = blocks.join(best, "block")
    seats = placed.mapInPandas(_seats, "seat long, block long, bin long, offset long")
    # Even numbers for sequences of one piece, odd ones for the others.
    full = pieces.where(F.col("length") >= size).select(
        *pieces.columns,
        (2 * F.col("pid")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    packed = loose.join(seats, F.col("pid") == F.col("seat")).select(
        *pieces.columns,
        (2 * (F.col("block") * F.lit(1 << 24) + F.col("bin")) + 1).alias("sequence_id"),
        "offset",
    )
    return full.unionByName(packed)


def packed_documents(
    docs: DataFrame, tokenizer: str, end_id: int | None = 0, size: int = SEQUENCE_TOKENS,
    keep_ids: bool = False,
) -> DataFrame:
    """All pieces of ``docs`` with their sequences and places."""
    pieces = token_pieces(docs, tokenizer, end_id, size, keep_ids)
    return pack(written(pieces, "pieces"), size).drop("pid")


def sequences(packed: DataFrame) -> DataFrame:
    """Rows (sequence_id, length, ids) of pieces that carry their ``ids``."""
    parts = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"),
    )
    empty = F.lit(b"")
    ids = F.aggregate(F.col("parts.ids"), empty, lambda row, part: F.concat(row, part))
    return parts.select("sequence_id", "length", ids.alias("ids"))


def _cut(batches, tokenizer, end_id, size, keep_ids):
    pid = TaskContext.get().partitionId() << 36
    for batch in by_bytes(batches, "text"):
        ids, counts = encoder(tokenizer_path(tokenizer)).encode(texts_of(batch))
        if end_id is not None:
            ids = np.insert(ids, np.cumsum(counts), end_id).astype("<u4")
            counts = counts + 1
        first = np.cumsum(counts) - counts
        n_pieces = -(-counts // size)
        doc = np.repeat(np.arange(len(counts)), n_pieces)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
        end = counts[doc] - (n_pieces[doc] - 1 - piece) * size
        start = np.maximum(end - size, 0)
        raw = memoryview(ids.tobytes())
        spans = list(zip(((first[doc] + start) * 4).tolist(), ((first[doc] + end) * 4).tolist()))
        columns = [
            pa.array(np.arange(pid, pid + len(doc))),
            batch["doc_id"].take(pa.array(doc)),
            pa.array(piece.astype(np.int32)),
            pa.array(start),
            pa.array(end - start),
            pa.array([zlib.crc32(raw[a:b]) for a, b in spans], pa.int64()),
        ]
        names = ["pid", "doc_id", "piece", "start", "length", "ids_crc32"]
        if keep_ids:
            columns.append(pa.array([bytes(raw[a:b]) for a, b in spans], pa.binary()))
            names.append("ids")
        pid += len(doc)
        yield pa.RecordBatch.from_arrays(columns, names=names)


# ---- islands --------------------------------------------------------------------------


def _evolved(blocks: DataFrame, n_blocks: int, size: int) -> DataFrame:
    """The best packing of each island after the last epoch."""
    islands = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1)))
    start = blocks.select(
        "block", islands.alias("island"), "lengths",
        F.lit(None).cast("binary").alias("own"), F.lit(None).cast("binary").alias("guest"),
    )
    tasks = n_blocks * ISLANDS
    evolved = None
    for epoch in range(EPOCHS):
        if evolved is not None:
            guests = evolved.select(
                F.col("block").alias("to_block"),
                F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("to_island"),
                F.col("packing").alias("guest"),
            )
            arrived = (F.col("block") == F.col("to_block")) & (F.col("island") == F.col("to_island"))
            start = (
                evolved.join(guests, arrived)
                .select("block", "island", F.col("packing").alias("own"), "guest")
                .join(blocks.select("block", "lengths"), "block")
                .select("block", "island", "lengths", "own", "guest")
            )
        run = partial(_evolve, size=size, epoch=epoch)
        schema = "block long, island int, packing binary, n_sequences long, fitness double"
        dealt = start.repartition(tasks, "block", "island")
        evolved = written(dealt.mapInPandas(run, schema), "pack-islands")
    return evolved


def _best(evolved: DataFrame) -> DataFrame:
    """The packing of each block with the fewest, then the fullest sequences."""
    rank = F.struct(-F.col("n_sequences"), "fitness", "island")
    chosen = evolved.groupBy("block").agg(F.max_by("island", rank).alias("island"))
    return evolved.join(chosen, ["block", "island"]).select("block", "packing")


def _evolve(frames, size, epoch):
    for frame in frames:
        for row in frame.itertuples():
            lengths = np.asarray(row.lengths, np.int64)
            rng = np.random.default_rng([int(row.block), int(row.island), epoch])
            given = [np.frombuffer(p, np.int32) for p in (row.own, row.guest) if p is not None]
            packing = evolve(lengths, size, rng, given)
            count, fitness = rating(packing, lengths, size)
            yield pd.DataFrame(
                {
                    "block": [row.block], "island": [row.island],
                    "packing": [packing.astype(np.int32).tobytes()],
                    "n_sequences": [count], "fitness": [fitness],
                }
            )


def evolve(lengths, size, rng, given=(), generations=GENERATIONS) -> np.ndarray:
    """The best packing (a sequence number for each piece) of one island's epoch."""
    packings = list(given)
    if not packings:
        packings.append(best_fit(np.argsort(-lengths, kind="stable"), lengths, size))
    while len(packings) < PACKINGS:
        spread = rng.normal(0, 0.1 * size, len(lengths)) if len(packings) > 1 else rng.random(len(lengths))
        packings.append(best_fit(np.argsort(-(lengths + spread), kind="stable"), lengths, size))
    rated = [(rating(p, lengths, size), p) for p in packings]
    worth = lambda r: (-r[0][0], r[0][1])
    for _ in range(generations):
        one, two = rng.choice(len(rated), 2, replace=False)
        child = crossover(rated[one][1], rated[two][1], lengths, size, rng)
        rated.append((rating(child, lengths, size), child))
        rated.sort(key=worth, reverse=True)
        rated.pop()
    return max(rated, key=worth)[1]


def crossover(into, donor, lengths, size, rng) -> np.ndarray:
    """``into`` with some whole well-filled sequences of ``donor``.

    Sequences of ``into`` that share a piece with them are dissolved, as are its two
    emptiest; pieces that lose their place are placed by best fit.
    """
    if not len(lengths):
        return into.copy()
    fill = np.bincount(donor, lengths)
    good = np.flatnonzero(fill >= min(WELL_FILLED * size, fill.max()))
    n = max(1, int(len(fill) * INJECTED * rng.random()))
    taken = rng.choice(good, min(n, len(good)), replace=False)
    injected = np.isin(donor, taken)
    fill_into = np.bincount(into, lengths)
    hit = np.zeros(len(fill_into), bool)
    hit[into[injected]] = True
    hit[np.argsort(fill_into)[:2]] = True
    stays = ~hit[into] & ~injected
    child = np.full(len(lengths), -1, np.int64)
    child[stays] = np.unique(into[stays], return_inverse=True)[1]
    n_kept = int(child.max()) + 1
    child[injected] = n_kept + np.unique(donor[injected], return_inverse=True)[1]
    displaced = np.flatnonzero(child < 0)
    order = displaced[np.argsort(-lengths[displaced], kind="stable")]
    return best_fit(order, lengths, size, child)


def best_fit(order, lengths, size, packing=None) -> np.ndarray:
    """Places the pieces of ``order`` one by one where least room is left over.

    Rooms are kept by how much is left in them; a whole number whose bits mark the sizes
    of room that exist finds the smallest that suffices.
    """
    packing = np.full(len(lengths), -1, np.int64) if packing is None else packing.copy()
    fill = np.bincount(packing[packing >= 0], lengths[packing >= 0]).astype(np.int64)
    rooms: list[list[int]] = [[] for _ in range(size + 1)]
    there = 0
    for b, left in enumerate((size - fill).tolist()):
        rooms[left].append(b)
        there |= 1 << left
    n = len(fill)
    chosen = []
    for length in lengths[order].tolist():
        fits = there >> length
        if fits:
            left = length + (fits & -fits).bit_length() - 1
            b = rooms[left].pop()
            if not rooms[left]:
                there ^= 1 << left
        else:
            left, b = size, n
            n += 1
        chosen.append(b)
        left -= length
        if not rooms[left]:
            there |= 1 << left
        rooms[left].append(b)
    packing[order] = chosen
    return packing


def rating(packing, lengths, size) -> tuple[int, float]:
    """(number of sequences, mean square of how full they are)."""
    if not len(packing):
        return 0, 1.0
    fill = np.bincount(packing, lengths) / size
    return len(fill), float(np.mean(fill**2))


def _seats(frames):
    for frame in frames:
        for row in frame.itertuples():
            pids = np.asarray(row.pids)
            packing = np.frombuffer(row.packing, np.int32).astype(np.int64)
            lengths = np.asarray(row.lengths, np.int64)
            order = np.argsort(packing, kind="stable")
            ends = np.cumsum(lengths[order])
            starts = ends - lengths[order]
            first = np.searchsorted(packing[order], packing[order], side="left")
            offsets = starts - starts[first]
            yield pd.DataFrame(
                {"seat": pids[order], "block": row.block, "bin": packing[order], "offset": offsets}
            )
