"""Prefix tries against tries of Python dicts."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from plain import DIR
from pyspark.sql import functions as F

from clickloom.llm.prefix_trie import prefix_trie, turn_ids
from clickloom.llm.queries import QUERIES, rebuilt_turns

TURNS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _brute(strings):
    """Node rows of {conv_id: [(role, text), ...]}, from the definition."""
    members = defaultdict(list)
    for conv, turns in strings.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    rows = {}
    for node in sorted(members, key=len, reverse=True):
        below = [rows[c] for c in children[node]]
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        ends = ",".join(str(c) for c in sorted(members[node]) if len(strings[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        rows[node] = (
            min(members[node]), len(node), parent, len(members[node]), len(below),
            sum(r[5] for r in below) or 1, own + sum(r[6] for r in below),
            hashlib.sha256(ends.encode()).hexdigest(),
        )
    return sorted(rows.values(), key=str)


def _got(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=str)


def _rows(strings):
    return [(c, i, role, text) for c, turns in strings.items() for i, (role, text) in enumerate(turns)]


def _random_strings(seed, n, longest):
    draw = random.Random(seed)
    strings = {}
    for c in range(n):
        turns = [(draw.choice("ua"), draw.choice(["x", "yé", ""])) for _ in range(draw.randint(0, longest))]
        if strings and draw.random() < 0.5:
            other = strings[draw.choice(list(strings))]
            turns = other[: draw.randint(0, len(other))] + (turns if draw.random() < 0.6 else [])
        strings[draw.randrange(10**6)] = turns
    return strings


@pytest.mark.parametrize(("seed", "burst", "piece"), [(1, 512, 1024), (2, 2, 1024), (3, 1, 3), (4, 4, 2), (5, 512, 4)])
def test_nodes_equal_brute_force(spark, seed, burst, piece):
    strings = _random_strings(seed, 60, 9)
    turns = spark.createDataFrame(_rows(strings), TURNS)
    ids = spark.createDataFrame([(c,) for c in strings], "conv_id long")
    assert _got(prefix_trie(turn_ids(turns), ids, burst, piece)) == _brute(strings)


def test_long_and_copied_conversations(spark):
    long = [("u", str(i)) for i in range(700)]
    strings = {1: long, 2: long[:650] + [("u", "!")], 3: long, 4: [("u", "z")] * 400, 5: long[:64], 6: []}
    strings |= {c: [("u", "0"), ("a", "same")] for c in range(10, 400)}
    turns = spark.createDataFrame(_rows(strings), TURNS)
    ids = spark.createDataFrame([(c,) for c in strings], "conv_id long")
    assert _got(prefix_trie(turn_ids(turns), ids, 2, 256)) == _brute(strings)


def test_turn_order_nulls_and_repeats(spark):
    rows = [
        (1, 2, "a", "late"), (1, None, None, None), (1, -5, "u", "early"), (1, 2, "a", "late"),
        (None, 0, "u", "nobody"), (2, 300, "u", "far"), (2, 1, "u", "near"),
    ]
    turns = spark.createDataFrame(rows, TURNS).withColumn("id", F.lit("clash"))
    got = turn_ids(turns).orderBy("conv_id", "place").collect()
    assert [(r["conv_id"], r["place"], r["n_bytes"]) for r in got] == [
        (1, 0, 0), (1, 1, 5), (1, 2, 4), (1, 3, 4), (2, 0, 4), (2, 1, 3),
    ]
    assert got[2]["id"] == got[3]["id"] != got[1]["id"]
    empty = spark.createDataFrame([], TURNS)
    assert prefix_trie(turn_ids(empty), empty.select("conv_id")).count() == 0
    only = prefix_trie(turn_ids(empty), spark.createDataFrame([(7,)], "conv_id long"))
    assert _got(only) == _brute({7: []})


def _rebuilt(rows):
    original = defaultdict(list)
    for c, turn, role, text in rows:
        original[c].append((turn is not None, turn or 0, role or "", text or ""))
    original = {c: [t[2:] for t in sorted(turns)] for c, turns in original.items()}
    strings = {}
    for c, turns in original.items():
        h = zlib.crc32(str(c).encode()) % 9
        strings[c] = original.get(c - c % 5, [])[:h] + turns[h:]
    return strings


def test_query_equals_brute_force(spark, table):
    rows = [tuple(r) for r in table("conversations").select("conv_id", "turn", "role", "text").collect()]
    assert _got(QUERIES["op11_prefix_trie"](spark, DIR)) == _brute(_rebuilt(rows))


def test_rebuilt_conversations_without_a_base_or_turns(spark):
    # The base of conversations 6 to 9 is absent; short ones may be left without turns.
    rows = [(c, t, "u", f"{c}-{t}") for c in (6, 7, 8, 9, 10, 11, 12) for t in range(c % 4 + 1)]
    places, ids = rebuilt_turns(spark.createDataFrame(rows, TURNS))
    strings = _rebuilt(rows)
    assert [] in strings.values()
    assert _got(prefix_trie(places, ids)) == _brute(strings)
