"""Near-duplicate documents by a chosen-path set similarity join.

Documents are sets of word shingles. Equal word sequences collapse to one class first. Each
class gets minwise tokens: for a number of hash functions, the smallest hash of its set. A
tree branches the classes by the minwise token of one function; nodes of bounded size are
compared exhaustively by sketches, larger ones are dealt into parts of bounded size, and what
stays distinct inside its part goes one level down, branching by further functions. Enough
independent trees make a missed pair as unlikely as asked for. A node gives out no more than
a spanning forest of its similar pairs and not all pairs.

The forests' components are candidate groups: any two sets that are similar enough lie in
one group. Inside the groups the full sets are compared exactly, and the links found there
make the final components.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.batches import by_bytes, texts_of, written
from clickloom.llm.components import components
from clickloom.operators.skew import key_copy

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RECALL = 0.99999
# Bytes of the sketch; a sketch's estimate errs by 0.035 (one sigma) at a similarity of 0.8.
SKETCH = 128
# How much lower than the similarity asked for a sketch may estimate a pair that has it, and how
# close sets must be for one to stand for the other. Unequal bytes of sketches are a distance, so
# bounds of several hops add up: the room is needed once, for the pair itself.
ROOM, SAME = 0.2, 0.82
BRANCHES = 4
LEVELS = 3
NODE_SETS = 1024
GROUP_SETS = 1024
PIVOTS = 8

_MIX = np.uint64(0x9E3779B97F4A7C15)
_POWER = np.uint64(0x100000001B3)
_SPACE_BYTES = np.zeros(256, bool)
_SPACE_BYTES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one for each row of ``docs``.

    Words are runs without white space, A-Z in lower case; a text of fewer than
    ``shingle_words`` words is one shingle. Documents are linked when the intersection of
    their sets is at least ``similarity`` of the union; ``component_id`` is the lowest
    ``doc_id`` that links lead to, and ``kept`` marks the row that has it.

    Null and empty texts have no shingles and are linked with nothing, not with each other
    either. Rows of one ``doc_id`` are one document if their words are the same. Null ids
    never name a component unless it has no other. An empty table gives no rows.
    """
    percent = round(100 * similarity)
    trees = max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity)))
    rows = written(_sketched(docs, shingle_words, trees), "near-sketches")
    classes = written(
        rows.where(F.col("n_shingles") > 0)
        .groupBy("cls")
        .agg(
            F.min("doc_id").alias("rep_id"),
            F.min("sketch").alias("sketch"),
            F.min("paths").alias("paths"),
        ),
        "near-classes",
    )
    edges = _candidate_edges(classes, trees, similarity)
    groups = components(edges)
    links = _exact_links(docs, classes, groups, shingle_words, percent)
    return _labelled(rows, components(links))


def without_near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """One document of each component, that of the lowest ``doc_id``, and all empty ones.

    Rows that share a ``doc_id`` stay or go together.
    """
    found = near_duplicates(docs, shingle_words).where("kept").select(F.col("doc_id").alias("kept_id"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("kept_id"))
    return docs.join(found.hint("merge"), same, "left_semi")


# ---- sets -----------------------------------------------------------------------------


def _sketched(docs: DataFrame, shingle_words: int, trees: int) -> DataFrame:
    named = docs.select(F.col("doc_id").cast("long"), "text")
    n_paths = trees + BRANCHES * (LEVELS - 1)
    sketch = partial(_sketch_rows, k=shingle_words, n_paths=n_paths)
    schema = "doc_id long, cls binary, n_shingles long, sketch binary, paths binary"
    return named.mapInArrow(sketch, schema)


def _sketch_rows(batches, k, n_paths):
    rng = np.random.default_rng(20)
    size = SKETCH + n_paths
    mult = rng.integers(1, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 1 << 63, size, dtype=np.uint64)
    for batch in by_bytes(batches, "text"):
        names, counts, sketches, paths = [], [], [], []
        for words in word_hashes(texts_of(batch)):
            shingles = shingle_set(words, k)
            names.append(_sequence_name(words))
            counts.append(len(shingles))
            if len(shingles):
                lowest = _lowest(shingles, mult, add)
                sketches.append((lowest[:SKETCH] >> np.uint64(20)).astype(np.uint8).tobytes())
                paths.append((lowest[SKETCH:] >> np.uint64(16)).astype("<u8").tobytes())
            else:
                sketches.append(None)
                paths.append(None)
        yield pa.RecordBatch.from_arrays(
            [
                batch["doc_id"], pa.array(names, pa.binary()), pa.array(counts, pa.int64()),
                pa.array(sketches, pa.binary()), pa.array(paths, pa.binary()),
            ],
            names=["doc_id", "cls", "n_shingles", "sketch", "paths"],
        )


def word_hashes(texts: pa.Array) -> list[np.ndarray]:
    """The 64-bit hashes of the words of each text, all texts of a batch at once."""
    raw = texts.cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = raw.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    flat = _LOWER[flat[offsets[0] : offsets[-1]]]
    offsets = offsets - offsets[0]
    inside = ~_SPACE_BYTES[flat]
    starts_here = inside.copy()
    starts_here[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(flat)]
    starts_here[edges] |= inside[edges]
    starts = np.flatnonzero(starts_here)
    if not len(starts):
        return [np.empty(0, np.uint64)] * len(texts)
    # A word's hash is a polynomial in its bytes; white space between words adds nothing.
    place = np.arange(len(flat)) - np.repeat(
        np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [len(flat)]]))
    )
    terms = np.where(inside, _BYTE_VALUE[flat] * _powers(int(place.max()) + 1)[place], np.uint64(0))
    hashes = _mixed(np.add.reduceat(terms, starts))
    cuts = np.searchsorted(starts, offsets)
    return [hashes[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """The distinct shingle hashes of a row of word hashes, sorted."""
    if not len(words):
        return words
    width = min(k, len(words))
    n = len(words) - width + 1
    out = np.full(n, width, np.uint64)
    for j in range(width):
        out = _mixed(out * _MIX + words[j : j + n])
    return np.unique(out)


def _sequence_name(words: np.ndarray) -> bytes | None:
    """128 bits that name a sequence of words."""
    if not len(words):
        return None
    at = np.arange(1, len(words) + 1, dtype=np.uint64)
    parts = [_mixed(words ^ _mixed(at * m)).sum(dtype=np.uint64) for m in (_MIX, _POWER)]
    return np.array(parts, "<u8").tobytes()


def _lowest(shingles: np.ndarray, mult: np.ndarray, add: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a set."""
    best = np.full(len(mult), np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(shingles), 256):
        part = shingles[at : at + 256]
        values = part[None, :] * mult[:, None] + add[:, None]
        best = np.minimum(best, values.min(axis=1))
    return best


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = _mixed(np.arange(1, 257, dtype=np.uint64) * _MIX) | np.uint64(1)


def _powers(n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = _POWER
    return np.multiply.accumulate(out)


# ---- trees ----------------------------------------------------------------------------


def _candidate_edges(classes: DataFrame, trees: int, similarity: float) -> DataFrame:
    """A forest of pairs (a, b) whose components hold all pairs that may be similar.

    A row carries the radius of its set: how far at most, over all hops, are those it stands for.
    """
    token = lambda i: F.substr("paths", 8 * i + 1, F.lit(8))
    roots = F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))
    rows = classes.select("cls", "paths", roots.alias("tree")).select(
        "cls", F.concat(F.col("tree").cast("string").cast("binary"), token(F.col("tree"))).alias("node"),
        F.lit(0).alias("radius"),
    )
    edges, level = [], 0
    while True:
        last = level == LEVELS - 1
        shared = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
        shared = shared.select(F.col("node").alias("of"), "n")
        members = rows.join(shared, F.col("node") == key_copy("of")).join(
            classes.select("cls", "sketch"), "cls"
        )
        found = written(_compared(members, last, similarity), f"near-level-{level}")
        edges.append(found.where(F.col("b").isNotNull()).select("a", "b"))
        distinct = found.where(F.col("b").isNull()).select(F.col("a").alias("cls"), "node", "radius")
        if last or distinct.isEmpty():
            break
        first = trees + BRANCHES * level
        further = F.explode(F.sequence(F.lit(first), F.lit(first + BRANCHES - 1)))
        rows = (
            distinct.join(classes.select("cls", "paths"), "cls")
            .select("cls", "node", "radius", "paths", further.alias("tree"))
            .select("cls", F.md5(F.concat("node", F.col("tree").cast("string").cast("binary"),
                                          token(F.col("tree")))).cast("binary").alias("node"),
                    "radius")
        )
        level += 1
    out = edges[0]
    for more in edges[1:]:
        out = out.unionByName(more)
    return out.distinct()


def _compared(members: DataFrame, last: bool, similarity: float) -> DataFrame:
    """Edges (a, b) of each node, and (a, node, radius) of what has to go further down.

    A node of at most ``NODE_SETS`` sets is finished by this. A larger one is dealt into
    parts; on the last level each part is compared with each other part, which is exact
    for whatever branching could not separate.
    """
    parts = F.ceil(F.col("n") / NODE_SETS).cast("int")
    part = F.pmod(F.xxhash64("cls"), parts).cast("int")
    dealt = members.select("cls", "sketch", "radius", "node", parts.alias("parts"), part.alias("part"))
    if last:
        other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        dealt = dealt.withColumn("other", other)
    else:
        dealt = dealt.withColumn("other", F.col("part"))
    keyed = dealt.select(
        "cls", "sketch", "radius", "node", "parts",
        F.least("part", "other").alias("p1"), F.greatest("part", "other").alias("p2"),
    )
    keys = ["node", "p1", "p2"]
    ordered = keyed.repartition(*keys).sortWithinPartitions(*keys, "cls")
    schema = "a binary, b binary, node binary, radius int"
    compare = partial(_compare_nodes, last=last, similarity=similarity)
    return ordered.mapInPandas(compare, schema)


def _node_groups(frames, keys):
    """The rows of each key as columns, from frames that are sorted by key."""
    held: dict[str, np.ndarray] = {}
    for frame in frames:
        columns = {c: frame[c].to_numpy() for c in frame.columns}
        if held:
            columns = {c: np.concatenate([held[c], v]) for c, v in columns.items()}
        change = np.zeros(len(columns[keys[0]]), bool)
        for k in keys:
            change[1:] |= columns[k][1:] != columns[k][:-1]
        cuts = [0, *np.flatnonzero(change).tolist()]
        for start, stop in zip(cuts[:-1], cuts[1:]):
            yield {c: v[start:stop] for c, v in columns.items()}
        held = {c: v[cuts[-1] :] for c, v in columns.items()}
    if held and len(held[keys[0]]):
        yield held


def _compare_nodes(frames, last, similarity=SIMILARITY):
    columns = ["a", "b", "node", "radius"]
    out: list[tuple] = []
    for group in _node_groups(frames, ["node", "p1", "p2"]):
        names = group["cls"]
        sketches = np.frombuffer(b"".join(group["sketch"]), np.uint8).reshape(len(names), SKETCH)
        radius = group["radius"].astype(np.int64)
        pairs, distinct = sketch_forest(sketches, radius, similarity)
        out += [(names[a], names[b], None, None) for a, b in pairs]
        if not last and group["parts"][0] > 1:
            out += [(names[a], None, group["node"][0], int(radius[a])) for a in distinct]
        if len(out) > 10_000:
            yield pd.DataFrame(out, columns=columns).astype({"radius": "Int32"})
            out = []
    if out:
        yield pd.DataFrame(out, columns=columns).astype({"radius": "Int32"})


def sketch_forest(
    sketches: np.ndarray, radius: np.ndarray | None = None, similarity: float = SIMILARITY
) -> tuple[list[tuple[int, int]], list[int]]:
    """(spanning forest of the candidate pairs, sets that no other set can stand for).

    Sets are taken in order and compared with all distinct ones so far. One that is the
    same as a distinct set but for a few shingles gets an edge to it and is left out from
    then on. ``radius`` has the distance in bytes to the farthest set that each stands for
    already, and is brought up to date. A set is left out only if its radius and the hop stay
    within ``SAME`` together, and two sets are candidates if any two that they stand for may
    be similar, so a pair is not lost with one end or both stood for, over any number of hops.
    """
    reach = SKETCH - math.ceil(round((similarity - ROOM) * SKETCH, 6))
    same = SKETCH - math.ceil(SAME * SKETCH)
    if radius is None:
        radius = np.zeros(len(sketches), np.int64)
    root = list(range(len(sketches)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    edges, distinct = [], [0]
    pivots = np.empty_like(sketches)
    pivots[0] = sketches[0]
    # The radius of each distinct set, beside its sketch.
    around = np.empty(len(sketches), np.int64)
    around[0] = radius[0]
    for i in range(1, len(sketches)):
        n = len(distinct)
        gap = np.count_nonzero(pivots[:n] != sketches[i], axis=1)
        for p in np.flatnonzero(gap <= reach + around[:n] + radius[i]).tolist():
            a, b = find(distinct[p]), find(i)
            if a != b:
                root[b] = a
                edges.append((distinct[p], i))
        p = int(gap.argmin())
        if gap[p] + radius[i] <= same:
            around[p] = max(around[p], gap[p] + radius[i])
        else:
            pivots[n], around[n] = sketches[i], radius[i]
            distinct.append(i)
    radius[distinct] = around[: len(distinct)]
    return edges, distinct


# ---- exact links ----------------------------------------------------------------------


def _exact_links(docs, classes, groups, k, percent) -> DataFrame:
    """A forest (a, b) of the exact links inside the candidate groups.

    A group of at most ``GROUP_SETS`` sets is linked in one task. A larger one is dealt into
    parts, and the same few pivots are added to each: whatever is linked to a pivot inside
    its part is settled. The others are compared with every set of the group whose distances
    to the pivots do not rule a link out (distances of sets obey the triangle inequality),
    block by block, which is exact.
    """
    groups = written(
        groups.join(classes.select("cls", "rep_id"), F.col("node") == F.col("cls"))
        .select("cls", "rep_id", F.col("root").alias("group")),
        "near-groups",
    )
    sizes = groups.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / GROUP_SETS).alias("parts"))
    named = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _named_rows, "doc_id long, cls binary, text string"
    )
    wanted = groups.join(sizes, "group").select(
        F.col("cls").alias("of"), "rep_id", "group", F.col("parts").cast("int").alias("parts")
    )
    same = (F.col("cls") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("rep_id"))
    members = written(
        named.join(wanted.hint("merge"), same).select(
            "cls", "group", "text", "parts",
            F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int").alias("p1"),
        ),
        "near-members",
    )
    link = partial(_link_groups, k=k, percent=percent)
    first = _dealt_members(members)
    found = written(first.mapInPandas(link, LINKS), "near-links")
    links = found.where("b is not null").select("a", "b")
    rest = found.where("b is null and not settled")
    if rest.isEmpty():
        return links
    blocks = _open_blocks(members, found, rest, percent)
    more = blocks.mapInPandas(link, LINKS).where("b is not null").select("a", "b")
    return links.unionByName(written(more, "near-links"))


LINKS = "a binary, b binary, group binary, settled boolean, far array<float>"
_KEYS = ["group", "p1", "p2"]


def _dealt_members(members: DataFrame) -> DataFrame:
    """Members by (group, part), and in each part of a group of several its pivots first."""
    large = members.where(F.col("parts") > 1)
    chosen = large.groupBy("group", F.pmod(F.xxhash64("cls", F.lit(3)), F.lit(PIVOTS))).agg(
        F.min(F.struct("cls", "text", "parts")).alias("m")
    )
    pivots = chosen.select(
        F.col("m.cls").alias("cls"), "group", F.col("m.text").alias("text"),
        F.explode(F.sequence(F.lit(0), F.col("m.parts") - 1)).alias("p1"), F.lit(True).alias("pivot"),
    )
    rows = members.select("cls", "group", "text", "p1", F.lit(False).alias("pivot")).unionByName(pivots)
    rows = rows.withColumn("p2", F.lit(0))
    return rows.repartition(*_KEYS).sortWithinPartitions(*_KEYS, F.desc("pivot"), "cls")


def _open_blocks(members: DataFrame, found: DataFrame, rest: DataFrame, percent: int) -> DataFrame:
    """Blocks that bring each unsettled set together with all sets it may be linked to."""
    slack = 1 - percent / 100 + 1e-6
    at = lambda f: F.array(*[f(F.get("far", F.lit(i))) for i in range(PIVOTS)])
    bounds = rest.groupBy("group").agg(
        at(F.min).alias("low"), at(F.max).alias("high"), F.count(F.lit(1)).alias("n_rest")
    )
    near = F.forall(
        F.arrays_zip("far", "low", "high"),
        lambda z: z["far"].isNull()
        | z["far"].between(z["low"] - F.lit(slack), z["high"] + F.lit(slack)),
    )
    state = found.where("b is null").join(bounds, "group")
    kept = state.where(near | ~F.col("settled")).select(
        F.col("a").alias("cls"), "group", "settled", "n_rest"
    )
    sizes = kept.groupBy("group").agg(F.count(F.lit(1)).alias("n_all"))
    half = GROUP_SETS // 2
    sized = kept.join(sizes, "group").select(
        "cls", "group", "settled",
        F.ceil(F.col("n_rest") / half).cast("int").alias("rest_blocks"),
        F.ceil(F.col("n_all") / half).cast("int").alias("all_blocks"),
    )
    place = lambda n: F.pmod(F.xxhash64("cls", F.lit(5)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    as_rest = sized.where(~F.col("settled")).select(
        "cls", "group", place("rest_blocks").alias("p1"), every("all_blocks").alias("p2")
    )
    as_any = sized.select("cls", "group", every("rest_blocks").alias("p1"), place("all_blocks").alias("p2"))
    keyed = as_rest.unionByName(as_any).distinct().withColumn("pivot", F.lit(False))
    rows = keyed.join(members.select("cls", "text"), "cls")
    return rows.repartition(*_KEYS).sortWithinPartitions(*_KEYS, "cls")


def _named_rows(batches):
    for batch in by_bytes(batches, "text"):
        names = [_sequence_name(w) for w in word_hashes(texts_of(batch))]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(names, pa.binary()), batch["text"]],
            names=["doc_id", "cls", "text"],
        )


def _link_groups(frames, k, percent):
    columns = ["a", "b", "group", "settled", "far"]
    for group in _node_groups(frames, _KEYS):
        _, first = np.unique(group["cls"], return_index=True)
        order = np.sort(first)
        names, of = group["cls"][order], group["group"][0]
        texts = pa.array(group["text"][order], pa.large_string())
        sets = [shingle_set(w, k) for w in word_hashes(texts)]
        n_pivots = int(np.count_nonzero(group["pivot"][order]))
        links, settled, far = link_sets(sets, percent, n_pivots)
        out = [(names[i], names[j], of, None, None) for i, j in links]
        if n_pivots:
            out += [
                (names[i], None, of, bool(settled[i]), far[i].tolist()) for i in range(len(names))
            ]
        if out:
            yield pd.DataFrame(out, columns=columns)


def link_sets(sets, percent, n_pivots=0):
    """(forest of the exact links, which sets are settled, distances to the pivots).

    The first ``n_pivots`` sets are pivots. The largest component that links among them
    make is the main one, and what is linked to it here is settled.

    A set is compared with a component through the component's first set: a link joins
    them, and where the two distances differ by more than a link's, there is none. Only
    the members in between are compared one by one.
    """
    slack = 1 - percent / 100 + 1e-9
    parts: list[dict] = []
    links: list[tuple[int, int]] = []
    far = np.full((len(sets), PIVOTS), np.nan)
    for i, s in enumerate(sets):
        for p in range(min(n_pivots, PIVOTS)):
            far[i, p] = 1 - _jaccard(s, sets[p])[0]
        joined = None
        for part in list(parts):
            head = part["members"][0]
            similarity, linked = _jaccard(s, sets[head], percent)
            near, other = 1 - similarity, head
            if not linked and near - part["radius"] <= slack:
                for j, away in zip(part["members"][1:], part["away"][1:]):
                    if abs(near - away) <= slack and _jaccard(s, sets[j], percent)[1]:
                        linked, other = True, j
                        break
            if not linked:
                continue
            links.append((other, i))
            if joined is None:
                joined = part
                part["members"].append(i)
                part["away"].append(near)
                part["radius"] = max(part["radius"], near)
            else:
                _absorb(joined, part, sets)
                parts.remove(part)
        if joined is None:
            parts.append({"members": [i], "away": [0.0], "radius": 0.0})
    settled = np.zeros(len(sets), bool)
    main = _main_pivots(sets[:n_pivots], percent)
    for part in parts:
        if main & set(part["members"]):
            settled[part["members"]] = True
    return links, settled, far


def _main_pivots(pivots, percent) -> set[int]:
    """The pivots of their largest component by the links among them alone."""
    label = list(range(len(pivots)))
    for i in range(len(pivots)):
        for j in range(i):
            if label[i] != label[j] and _jaccard(pivots[i], pivots[j], percent)[1]:
                label = [label[j] if x == label[i] else x for x in label]
    main = max(sorted(set(label)), key=label.count, default=None)
    return {i for i, x in enumerate(label) if x == main}


def _absorb(into, part, sets):
    head = sets[into["members"][0]]
    for j in part["members"]:
        away = 1 - _jaccard(sets[j], head)[0]
        into["members"].append(j)
        into["away"].append(away)
        into["radius"] = max(into["radius"], away)


def _jaccard(a, b, percent=101):
    """(similarity, whether it is a link) of two sorted sets."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    inter = int(np.count_nonzero(large[at] == small))
    union = len(a) + len(b) - inter
    return inter / union, 100 * inter >= percent * union


def _labelled(rows: DataFrame, linked: DataFrame) -> DataFrame:
    """Every row with the lowest id of its component; rows without shingles stand alone."""
    lowest = rows.where(F.col("cls").isNotNull()).groupBy("cls").agg(F.min("doc_id").alias("low"))
    rooted = lowest.join(linked, F.col("cls") == F.col("node"), "left").select(
        F.col("cls").alias("of"), "low", F.coalesce("root", "cls").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    ids = ids.withColumnRenamed("root", "to")
    named = rooted.join(ids, F.col("root") == key_copy("to")).select("of", "component_id")
    out = rows.select("doc_id", "cls", "n_shingles").join(
        named, F.col("cls") == F.col("of"), "left"
    )
    component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
