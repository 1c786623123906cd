"""Prefix tries of conversations, by burst tries.

A conversation is a string of turn ids, 128-bit hashes of role and text. Equal strings are
counted first, so a conversation with many copies is one row from then on. The strings lie
in suffix containers under trie heads. A container with more than ``BURST`` strings bursts:
its head becomes a node of its own, and its strings are dealt by their next turn id to
new containers without that turn. Containers that are small enough are sorted, one next to
the other in a task, and swept: neighbours share the nodes of their common prefix, so a
stack of open nodes gives out every node once. Sums of the burst heads are then
aggregated from their children, the last round first.

Strings are cut into pieces of ``PIECE`` turns, so no conversation is ever one row or one
task. A later piece lies in a container whose head is known by a hash of all pieces before
it. Pieces that only one conversation has are chains and need no container; the others
are handled level by level, the deepest first. Most corpora have one level.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.batches import written
from clickloom.operators.skew import key_copy

BURST = 512
PIECE = 1024
BUCKET_TURNS = 256
WIDTH = 32
ROWS_OUT = 8192

NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved"]
END = ["n_ends", "end_conv", "end_key"]
SWEPT = (
    "gen int, node string, parent string, conv_id long, depth long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved long, n_ends long, end_conv long, "
    "end_key string"
)


def turn_ids(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, place, id, n_bytes) from (conv_id, turn, role, text), places from 0.

    Turns are ordered by ``turn``, null first, ties by role and then by the id; repeated
    rows are turns of their own. Null roles and texts are empty, ``n_bytes`` is the size of
    the text in UTF-8. ``conv_id`` must be a whole number; rows without one are left out.
    Places are counted inside buckets of turns and then over buckets, so that a very long
    conversation is spread over many tasks. Other columns are not read.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
        F.coalesce(F.floor(F.col("turn") / BUCKET_TURNS), F.lit(-(1 << 60))).alias("bucket"),
        F.md5(F.encode(said, "UTF-8")).alias("id"),
        F.octet_length(text).cast("int").alias("n_bytes"),
    )
    sizes = rows.groupBy("conv_id", "bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(
        "conv_id", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    order = Window.partitionBy("conv_id", "bucket").orderBy(F.asc_nulls_first("turn"), "role", "id")
    local = rows.withColumn("row", F.row_number().over(order) - 1)
    return local.join(before, ["conv_id", "bucket"]).select(
        "conv_id", (F.col("before") + F.col("row")).alias("place"), "id", "n_bytes"
    )


def prefix_trie(
    places: DataFrame, conversations: DataFrame, burst: int = BURST, piece: int = PIECE
) -> DataFrame:
    """The nodes of the trie of conversations, a row for each distinct run of first turns.

    ``places`` has rows as from :func:`turn_ids`, places from 0 without gaps; ``conversations``
    every ``conv_id`` once, also of those without turns, which are members of the root.
    Result: conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs
    (members), n_children, n_leaves (childless nodes from here down), saved_tokens (over the
    nodes from here down, bytes of the last text for every member but one), and ends_sha256
    (of the ids of members that end here, ascending, joined by commas). Node and parent are
    told apart by (conv_id, depth). Without any conversation there are no nodes.

    The digest of one node's ends is computed by one task, as a stream of sorted ids.
    """
    pieces = written(_pieces(places, conversations, piece), "trie-pieces")
    deeper = pieces.where(F.col("piece") > 0)
    if deeper.isEmpty():
        nodes, _ = _level(_strings(pieces, 0), burst, root=True)
    else:
        nodes = _levels(pieces, deeper, burst, piece)
    return _with_digests(nodes, pieces)


def _pieces(places: DataFrame, conversations: DataFrame, piece: int) -> DataFrame:
    """Pieces of conversations: (conv_id, piece, head, after, seq, sizes, more, end_key).

    ``seq`` are the turn ids in a row, ``head`` and ``after`` stand for all turns before
    the piece and up to its end, ``more`` says that another piece follows.
    """
    turn = F.struct("place", "id", "n_bytes")
    dealt = places.groupBy("conv_id", F.floor(F.col("place") / piece).alias("piece")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    )
    packed = dealt.select(
        "conv_id", "piece",
        F.array_join(F.transform("turns", lambda t: t["id"]), "").alias("seq"),
        F.transform("turns", lambda t: t["n_bytes"]).alias("sizes"),
    )
    ids = conversations.select("conv_id", F.lit(0).cast("long").alias("piece")).distinct()
    whole = ids.join(packed, ["conv_id", "piece"], "full").select(
        "conv_id", "piece", F.coalesce("seq", F.lit("")).alias("seq"),
        F.coalesce("sizes", F.array().cast("array<int>")).alias("sizes"),
    )
    upto = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, 0)
    # Hashes of (number, piece) whose exclusive or stands for the pieces so far.
    marks = [F.bit_xor(F.xxhash64(F.lit(s), "piece", "seq")).over(upto) for s in (1, 2)]
    following = F.lead("piece").over(Window.partitionBy("conv_id").orderBy("piece")).isNotNull()
    marked = whole.select("*", F.concat_ws("/", "piece", *marks).alias("after"), following.alias("more"))
    previous = F.lag("after").over(Window.partitionBy("conv_id").orderBy("piece"))
    return marked.select(
        "conv_id", "piece", F.coalesce(previous, F.lit("")).alias("head"), "after", "seq", "sizes", "more",
        F.md5(F.encode(F.concat_ws("/", "after", "seq"), "UTF-8")).alias("end_key"),
    )


def _strings(pieces: DataFrame, level: int) -> DataFrame:
    """Distinct strings of a level with their counts, all in the containers of their heads."""
    zero = F.lit(0).cast("long")
    ends = ~F.col("more")
    same = pieces.where(F.col("piece") == level).groupBy("head", "after", "end_key", "seq").agg(
        F.first("sizes").alias("sizes"),
        F.count(F.lit(1)).alias("n"),
        F.min("conv_id").alias("first"),
        F.count_if(ends).alias("n_ends"),
        F.min(F.when(ends, F.col("conv_id"))).alias("end_conv"),
    )
    return same.select(
        F.col("head").alias("node"), "after", F.lit(None).cast("string").alias("parent"),
        zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), zero.alias("bytes"),
        "seq", "sizes", "n", "first", *END,
        zero.alias("kids"), zero.alias("leaves"), zero.alias("saved"),
    )


def _level(strings: DataFrame, burst: int, root: bool) -> tuple[DataFrame, DataFrame]:
    """(nodes, tops of the first containers) of the strings of one level.

    The head of a first container is a node only of the level above, but for the root.
    """
    current = written(strings, "trie-strings")
    heads, generations, ready = [], [], []
    while True:
        gen = len(heads)
        stats = current.groupBy("node").agg(
            F.count(F.lit(1)).alias("strings"), F.sum("n").alias("n_convs"),
            F.min("first").alias("conv_id"), F.first("parent").alias("parent"),
            F.first("depth").alias("depth"), F.first("parent_conv_id").alias("parent_conv_id"),
            F.first("bytes").alias("bytes"),
        )
        if not (root and gen == 0):
            stats = stats.where(F.col("strings") > burst)
        big = written(stats, "trie-heads")
        if big.isEmpty():
            ready.append(current.withColumn("gen", F.lit(gen)))
            break
        # Above the first containers of a later level lies a node with more members than they have.
        big_conv = F.coalesce("parent_conv_id", "conv_id") if gen == 0 else F.col("conv_id")
        keys = big.select(key_copy("node").alias("big_node"), big_conv.alias("big_conv"))
        is_big = F.col("node") == F.col("big_node")
        if not (root and gen == 0):
            ready.append(current.join(keys, is_big, "left_anti").withColumn("gen", F.lit(gen)))
        opened = current.where(F.col("seq") != "").join(keys, is_big)
        turn, rest = F.substring("seq", 1, WIDTH), F.expr(f"substring(seq, {WIDTH + 1})")
        passed = [c for c in current.columns if c not in _MOVED]
        dealt = opened.select(
            F.md5(F.encode(F.concat_ws("/", "node", turn), "UTF-8")).alias("node"),
            F.col("node").alias("parent"), (F.col("depth") + 1).alias("depth"),
            F.col("big_conv").alias("parent_conv_id"),
            F.get("sizes", F.lit(0)).cast("long").alias("bytes"), rest.alias("seq"),
            F.slice("sizes", F.lit(2), F.greatest(F.size("sizes") - 1, F.lit(0))).alias("sizes"), *passed,
        )
        heads.append(big)
        generations.append(current)
        current = written(dealt.select(*current.columns), "trie-strings")
    swept = written(_swept(reduce(DataFrame.unionByName, ready)), "trie-swept")
    is_top = F.col("node").isNotNull()
    nodes = [swept.where(~is_top | (F.col("gen") > 0)).select(*NODE, *END)]
    tops, below = swept.where(is_top & (F.col("gen") == 0)), None
    for gen in range(len(heads) - 1, -1, -1):
        children = swept.where(is_top & (F.col("gen") == gen + 1)).select("parent", "n_leaves", "saved")
        if below is not None:
            children = children.unionByName(below.select("parent", "n_leaves", "saved"))
        below = written(_summed(heads[gen], generations[gen], children), "trie-nodes")
        if gen > 0 or root:
            nodes.append(below.select(*NODE, *END))
    if below is not None:
        tops = tops.select(*below.columns).unionByName(below)
    return reduce(DataFrame.unionByName, nodes), tops


_MOVED = ("node", "parent", "depth", "parent_conv_id", "bytes", "seq", "sizes")


def _summed(heads: DataFrame, strings: DataFrame, children: DataFrame) -> DataFrame:
    """Burst heads with what their child containers and the strings that end there add up to."""
    sums = children.groupBy(F.col("parent").alias("up")).agg(
        F.count(F.lit(1)).alias("up_n"), F.sum("n_leaves").alias("up_leaves"), F.sum("saved").alias("up_saved")
    )
    ended = strings.where(F.col("seq") == "").select(F.col("node").alias("end_node"), *END, "kids", "leaves", "saved")
    zero = F.lit(0)
    joined = heads.join(sums, F.col("node") == F.col("up"), "left").join(
        ended, F.col("node") == F.col("end_node"), "left"
    )
    n_children = F.coalesce("up_n", zero) + F.coalesce("kids", zero)
    n_leaves = F.coalesce("up_leaves", zero) + F.coalesce("leaves", zero)
    saved = F.coalesce("up_saved", zero) + F.coalesce("saved", zero)
    return joined.select(
        "node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs",
        n_children.alias("n_children"), F.greatest(n_leaves, F.lit(1)).cast("long").alias("n_leaves"),
        (saved + (F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
        F.coalesce("n_ends", zero).alias("n_ends"), "end_conv", "end_key",
    )


def _swept(strings: DataFrame) -> DataFrame:
    """All nodes of containers; tops, i.e. their heads, are the rows with a ``node``."""
    columns = [
        "gen", "node", "parent", "depth", "parent_conv_id", "bytes", "seq", "sizes", "n", "first",
        *END, "kids", "leaves", "saved",
    ]
    dealt = strings.select(*columns).repartition("node").sortWithinPartitions("node", "seq")
    return dealt.mapInArrow(_sweep, SWEPT)


class _Open:
    """A node whose members are still coming."""

    __slots__ = ("bytes", "children", "depth", "end", "first", "leaves", "n", "n_children", "saved")

    def __init__(self, depth: int, n_bytes: int):
        self.depth, self.bytes = depth, n_bytes
        self.n = self.leaves = self.saved = self.n_children = 0
        self.first = None
        self.end = (0, None, None)
        # Closed children wait here for the smallest member of their parent.
        self.children: list[tuple] = []


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of strings sorted by container and then by turn ids."""
    names = [part.split()[0] for part in SWEPT.split(", ")]
    types = [{"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[p.split()[1]] for p in SWEPT.split(", ")]
    rows: list[tuple] = []
    stack: list[_Open] = []
    seq, top = "", None

    def close(node: _Open) -> tuple:
        leaves = max(node.leaves, 1)
        saved = node.saved + (node.n - 1) * node.bytes
        first = node.first
        if not stack and top[0] == 0 and top[3] is not None:
            # The head of a later level: its node has members that end there, too.
            first = top[3]
        for child in node.children:
            rows.append((None, None, None, child[0], child[1], first, *child[2:]))
        return (node.first, node.depth, node.n, node.n_children, leaves, saved, *node.end)

    def shut(size: int) -> None:
        """Close the nodes below the first ``size`` open ones."""
        while len(stack) > size:
            node = stack.pop()
            done = close(node)
            if stack:
                parent = stack[-1]
                parent.children.append(done)
                parent.n_children += 1
                parent.n += node.n
                parent.first = node.first if parent.first is None else min(parent.first, node.first)
                parent.leaves += done[4]
                parent.saved += done[5]
            else:
                gen, name, above, above_conv = top
                rows.append((gen, name, above, done[0], done[1], above_conv, *done[2:]))

    def taken() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names=names
        )
        rows.clear()
        return batch

    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            gen, name, above, depth, above_conv, n_bytes, turns, sizes, n, first, *rest = row
            n_ends, end_conv, end_key, kids, leaves, saved = rest
            if top is None or name != top[1]:
                shut(0)
                if len(rows) >= ROWS_OUT:
                    yield taken()
                top, seq = (gen, name, above, above_conv), ""
                stack.append(_Open(depth, n_bytes))
            same, shortest = 0, min(len(seq), len(turns))
            while same < shortest and seq[same : same + WIDTH] == turns[same : same + WIDTH]:
                same += WIDTH
            shared = same // WIDTH
            shut(shared + 1)
            for i in range(shared, len(sizes)):
                stack.append(_Open(depth + i + 1, sizes[i]))
            last = stack[-1]
            last.n += n
            last.first = first if last.first is None else min(last.first, first)
            last.n_children += kids
            last.leaves += leaves
            last.saved += saved
            if n_ends:
                last.end = (n_ends, end_conv, end_key)
            seq = turns
    shut(0)
    if rows:
        yield taken()


def _levels(pieces: DataFrame, deeper: DataFrame, burst: int, piece: int) -> DataFrame:
    """Nodes of conversations of several pieces, the deepest shared level first."""
    shared = deeper.groupBy("head").agg(F.count(F.lit(1)).alias("n"), F.min("piece").alias("piece"))
    shared = written(shared, "trie-shared")
    alone = shared.where(F.col("n") == 1).select(key_copy("head").alias("alone_head"))
    together = shared.where(F.col("n") > 1)
    lone = deeper.join(alone, F.col("head") == F.col("alone_head"), "left_semi")
    many = written(deeper.join(alone, F.col("head") == F.col("alone_head"), "left_anti"), "trie-many")
    last = together.agg(F.max("piece")).head()[0] or 0
    first_pieces = pieces.where(F.col("piece") == 0)
    levels = {0: written(_strings(first_pieces, 0), "trie-level")}
    for k in range(1, last + 1):
        levels[k] = written(_under(_strings(many, k), levels[k - 1], k * piece), "trie-level")
    # A chain leaves a node that others may share; from its second turn on it is its own parent.
    above = reduce(DataFrame.unionByName, [s.select("after", "first") for s in levels.values()])
    nodes = [_chains(lone, above, piece)]
    below = lone.select(*_chain_sums())
    for k in range(last, -1, -1):
        marked = _with_below(levels[k], below)
        found, tops = _level(marked, burst, root=k == 0)
        nodes.append(found)
        below = lone.select(*_chain_sums()).unionByName(tops.select(
            F.col("node").alias("head"), F.col("n_children").alias("b_kids"),
            F.col("n_leaves").alias("b_leaves"), F.col("saved").alias("b_saved"),
        ))
    return reduce(DataFrame.unionByName, nodes)


def _chain_sums() -> list[Column | str]:
    one = F.lit(1).cast("long")
    return ["head", one.alias("b_kids"), one.alias("b_leaves"), F.lit(0).cast("long").alias("b_saved")]


def _under(strings: DataFrame, above: DataFrame, depth: int) -> DataFrame:
    """Strings of a later level with the depth and the smallest member of their heads."""
    heads = above.select(F.col("after").alias("above"), F.col("first").alias("above_first"))
    joined = strings.join(heads, key_copy("above") == F.col("node"))
    new = {"depth": F.lit(depth).cast("long"), "parent_conv_id": F.col("above_first")}
    return joined.select(*[new[c].alias(c) if c in new else c for c in strings.columns])


def _with_below(strings: DataFrame, below: DataFrame) -> DataFrame:
    """Strings with the sums of the pieces that follow them."""
    joined = strings.join(below.withColumnRenamed("head", "below_head"), F.col("after") == key_copy("below_head"), "left")
    new = {"kids": "b_kids", "leaves": "b_leaves", "saved": "b_saved"}
    zero = F.lit(0).cast("long")
    return joined.select(*[F.coalesce(new[c], zero).alias(c) if c in new else c for c in strings.columns])


def _chains(lone: DataFrame, above: DataFrame, piece: int) -> DataFrame:
    """Nodes of pieces that belong to one conversation each."""
    heads = above.select(F.col("after").alias("above"), F.col("first").alias("above_first"))
    joined = lone.join(heads, F.col("head") == key_copy("above"), "left")
    n = F.size("sizes")
    one = F.lit(1).cast("long")
    turns = joined.select(
        "conv_id", "piece", "more", "end_key", F.coalesce("above_first", "conv_id").alias("head_conv"),
        n.alias("n"), F.explode(F.sequence(F.lit(0), n - 1)).alias("i"),
    )
    is_end = (F.col("i") == F.col("n") - 1) & ~F.col("more")
    return turns.select(
        "conv_id", (F.col("piece") * piece + F.col("i") + 1).alias("depth"),
        F.when(F.col("i") == 0, F.col("head_conv")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        one.alias("n_convs"), F.when(is_end, 0).otherwise(1).cast("long").alias("n_children"),
        one.alias("n_leaves"), F.lit(0).cast("long").alias("saved"),
        is_end.cast("long").alias("n_ends"), F.when(is_end, F.col("conv_id")).alias("end_conv"),
        F.when(is_end, F.col("end_key")).alias("end_key"),
    )


def _with_digests(nodes: DataFrame, pieces: DataFrame) -> DataFrame:
    """Nodes with the digest of the ids that end there."""
    shown = [*NODE[:-1], F.col("saved").alias("saved_tokens")]
    ended = F.when(F.col("n_ends") == 1, F.col("end_conv").cast("string")).otherwise("")
    own = F.sha2(F.encode(ended, "UTF-8"), 256)
    few = nodes.where(F.col("n_ends") < 2).select(*shown, own.alias("ends_sha256"))
    several = nodes.where(F.col("n_ends") > 1)
    keys = several.select(key_copy("end_key").alias("key"))
    members = pieces.where(~F.col("more")).select("end_key", "conv_id")
    members = members.join(keys, F.col("end_key") == F.col("key"), "left_semi")
    sorted_ids = members.repartition("end_key").sortWithinPartitions("end_key", "conv_id")
    digests = sorted_ids.mapInArrow(_id_digests, "digest_key string, ends_sha256 string")
    many = several.join(digests, F.col("end_key") == F.col("digest_key"))
    return few.unionByName(many.select(*shown, "ends_sha256"))


def _id_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the sorted ids of each key, taken in as they come."""
    key, digest, done = None, None, []
    for batch in batches:
        for k, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k == key:
                digest.update(b",%d" % conv)
            else:
                if key is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256(b"%d" % conv)
    if key is not None:
        done.append((key, digest.hexdigest()))
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["digest_key", "ends_sha256"])
