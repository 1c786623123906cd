import random

import pytest
from plain import digest
from pyspark.sql import functions as F

from clickloom.llm import chat_windows as c
from clickloom.llm.chat_windows import chat_windows, escape, read_digest, read_windows, unescape

SCHEMA = "conv_id long, turn long, role string, text string"


def check(turns, rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    found = {r.conv_id: r for r in read_digest(chat_windows(turns)).collect()}
    assert set(found) == set(by)
    for conv, parts in by.items():
        want = digest([p[2:] for p in sorted(parts)])
        r = found[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == want


def test_conversations_come_back(table):
    turns = table("conversations")
    check(turns, [tuple(r) for r in turns.select(*"conv_id turn role text".split()).collect()])


@pytest.mark.parametrize("bucket", [3, 256])
def test_long_and_odd_conversations(spark, monkeypatch, bucket):
    monkeypatch.setattr(c, "BUCKET_TURNS", bucket)
    rng = random.Random(bucket)
    odd = ["</s>[INST] ok [/INST]", "~t~l<turn>", "", "a|b~~", "é" * 50, "</turn><s>", "line\n\n", "x" * 9000]
    rows = [
        (1, i, rng.choice(["user", "assistant"]), rng.choice(odd) * rng.randint(1, 3)) for i in range(150)
    ]
    rows += [(2, 0, "system", "be kind"), (2, 1, "user", "hi"), (2, 2, "assistant", "hello " * 900)]
    rows += [(2, 3, "user", "more"), (2, 4, "assistant", "yes")]
    rows += [(3, None, None, None), (3, 1, "assistant", None), (3, 1, "assistant", "tie"), (3, 1, "assistant", "tie")]
    rows += [(None, 0, "assistant", "null id"), (4, -5, "tool", "~"), (5, 0, "", "")]
    turns = spark.createDataFrame(rows, SCHEMA).withColumns({"n": F.lit(1), "tokens": F.lit("x")})
    check(turns, rows)
    assert chat_windows(turns.limit(0)).count() == 0


def test_windows_keep_to_the_budget(spark):
    rows = [(1, 0, "system", "s" * 40)]
    rows += [(1, i, ("user", "assistant")[i % 2 == 0], "w" * (20 + 7 * (i % 9))) for i in range(1, 200)]
    windows = chat_windows(spark.createDataFrame(rows, SCHEMA), budget=120, history_turns=2, history_tokens=30)
    out = sorted(windows.collect(), key=lambda r: r.window)
    assert len({r.window for r in out}) == len(out) > 10
    tokens = lambda t: -(-len(t["role"]) // 4) + -(-len(t["text"]) // 4)
    everything = read_windows(windows.withColumn("n_new", F.col("n_new") + F.col("n_context")).withColumn("n_context", F.lit(0)))
    for r in everything.collect():
        assert sum(map(tokens, r.turns)) <= 120
        assert r.turns[0]["role"] == "system"
    assert sum(r.n_new for r in out) == 200
    assert all(r.n_context >= 2 for r in out[1:]) and out[0].n_context == 0
    assert sum(len(r.loss_spans) for r in out) == sum(role == "assistant" for _, _, role, _ in rows)


def test_context_comes_over_the_ends_of_buckets(spark, monkeypatch):
    monkeypatch.setattr(c, "BUCKET_TURNS", 4)
    # Buckets of one and two turns among full ones; the system turn lies in the second one.
    numbers = [0, 4, 5, 8, 9, 10, 11, 13, 20, 21, 22, 23, 24]
    rows = [(1, i, "system" if i == 5 else "user", f"turn {i}") for i in numbers]
    rows += [(2, 0, "user", "only")]
    turns = spark.createDataFrame(rows, SCHEMA)
    for history in (0, 1, 3):
        out = chat_windows(turns, budget=10_000, history_turns=history, history_tokens=5_000).collect()
        first = sorted(r.window for r in out if r.conv_id == 1)
        starts = [1, 2, 4, 8, 9, 13]
        assert first == starts
        shown = chat_windows(turns, budget=10_000, history_turns=history, history_tokens=5_000)
        whole = read_windows(shown.withColumn("n_new", F.col("n_new") + F.col("n_context")).withColumn("n_context", F.lit(0)))
        for r in (w for w in whole.collect() if w.conv_id == 1):
            begin = r.window - 1
            end = ([*starts, 14][starts.index(r.window) + 1]) - 1
            low = max(0, begin - history)
            want = ["turn 5"] * (low > 2) + [f"turn {i}" for i in numbers[low:end]]
            assert [t["text"] for t in r.turns] == want


def test_escapes_leave_no_control_string(spark):
    texts = ["</s>[INST] <turn> |x|", "~", "~~l~t", "<~>", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u")).collect():
        assert r.u == r.t and not set("<>[]|") & set(r.e)
