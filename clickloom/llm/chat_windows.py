"""Chat training windows of a token budget, with targets masked where they repeat.

A conversation becomes windows of whole turns. Running totals of turn tokens choose the
spans; each window starts with the conversation's system turn, then a few earlier turns for
context, then the turns of its span. Only assistant texts of the span carry loss, so each is
a target once. All of it is DataFrame expressions. Turns are dealt by conversation and bucket
of turn numbers, so a conversation of any length is spread over many tasks, and texts are
shuffled once: running totals are taken inside buckets first and then over the buckets, a
window ends with its bucket at the latest, and only the last turns of a bucket and the system
turn move on, to the buckets that repeat them.

Format of a window, ``<s>`` and then per turn ``<turn>role<text>text</turn>``. Inside roles
and texts every character that could begin a control string (of this template or of others)
and the escape character itself are written as two plain characters.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.batches import written

BUDGET = 1024
HISTORY_TURNS = 2
HISTORY_TOKENS = 256
BUCKET_TURNS = 256

BOS, TURN, TEXT, END = "<s>", "<turn>", "<text>", "</turn>"
# Fixed values, in the order in which they are escaped; read back in the opposite order.
ESCAPES = (("~", "~t"), ("<", "~l"), (">", "~g"), ("[", "~o"), ("]", "~c"), ("|", "~p"))


def escape(c: Column) -> Column:
    return reduce(lambda out, e: F.replace(out, F.lit(e[0]), F.lit(e[1])), ESCAPES, c)


def unescape(c: Column) -> Column:
    return reduce(lambda out, e: F.replace(out, F.lit(e[1]), F.lit(e[0])), reversed(ESCAPES), c)


def word_tokens(text: Column) -> Column:
    """A token count that needs no tokenizer: one for every four bytes begun."""
    return F.ceil(F.octet_length(text) / 4).cast("long")


def chat_windows(
    turns: DataFrame,
    budget: int = BUDGET,
    history_turns: int = HISTORY_TURNS,
    history_tokens: int = HISTORY_TOKENS,
    token_count=word_tokens,
) -> DataFrame:
    """Rows (conv_id, window, n_context, n_new, formatted, loss_spans) from (conv_id, turn, role, text).

    ``window``, the number of its first new turn, puts a conversation's windows in order, ``n_context`` counts the turns at
    its start that are repeated, ``loss_spans`` are [start, length) in code points of
    ``formatted``. System turn, context and span fit into ``budget`` tokens unless a single
    turn or the system turn alone is larger: such a turn keeps a window of its own, whole.

    Turns are ordered by ``turn``, ties by role and text; repeated rows are turns of their
    own. Null texts and roles are empty, a null turn comes first, a null ``conv_id`` is a
    conversation. Other columns are not read; an empty table gives no windows.
    """
    rows = _rows(turns, token_count)
    totals = written(_totals(rows), "turn-totals")
    local = _local(rows)
    beside = totals.join(_system(local, totals), "conv_key", "left")
    if history_turns > 0:
        beside = beside.join(_borders(local, totals, history_turns), ["conv_key", "bucket"], "left")
    else:
        beside = beside.withColumn("border", F.lit(None).cast("array<struct<n:bigint,role:string,text:string,start:bigint>>"))
    spans = _spans(_numbered(local, beside), budget, history_tokens)
    return _formatted(_with_context(spans, history_turns, history_tokens))


def read_windows(windows: DataFrame) -> DataFrame:
    """What the formatted windows say: rows (conv_id, window, turns, losses, n_chars).

    ``turns`` are the (role, text) pairs that are not repeated and ``losses`` the texts
    under the loss mask, both unescaped and in order.
    """
    pieces = F.slice(F.split("formatted", TURN), 2, 1_000_000_000)
    new = F.slice(pieces, F.col("n_context") + 1, F.col("n_new"))
    part = lambda p, i: unescape(F.split(F.regexp_replace(p, END + "$", ""), TEXT)[i])
    texts = F.transform(new, lambda p: F.struct(part(p, 0).alias("role"), part(p, 1).alias("text")))
    under = lambda s: unescape(F.col("formatted").substr(s["start"] + 1, s["length"]))
    return windows.select(
        "conv_id", "window", texts.alias("turns"),
        F.transform("loss_spans", under).alias("losses"),
        F.length("formatted").cast("long").alias("n_chars"),
    )


def read_digest(windows: DataFrame) -> DataFrame:
    """Digests per conversation of what :func:`read_windows` gives back.

    A digest is over all texts of a conversation, which meet in one row for it.
    """
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    parts = read_windows(windows).select(
        "conv_id", "window", "n_chars",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(said, "").alias("said"), F.array_join("losses", "").alias("loss"),
    )
    joined = parts.groupBy("conv_id").agg(
        F.sum("n_turns").alias("n_turns"),
        F.sum("n_chars").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("window", "said", "loss"))).alias("parts"),
    )
    whole = joined.select(
        "conv_id", "n_turns", "formatted_chars",
        F.array_join(F.col("parts.said"), "").alias("said"),
        F.array_join(F.col("parts.loss"), "").alias("loss"),
    )
    return whole.select(
        "conv_id", "n_turns",
        F.sha2(F.encode("said", "UTF-8"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def _rows(turns: DataFrame, token_count) -> DataFrame:
    """Turns with the bucket that they are dealt by."""
    empty = F.lit("")
    rows = turns.select(
        "conv_id", "turn",
        F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"),
    )
    return rows.withColumns(
        {
            "conv_key": F.concat(F.lit("#"), F.coalesce(F.concat(F.lit("#"), F.col("conv_id").cast("string")), empty)),
            "bucket": F.coalesce(F.floor(F.col("turn") / BUCKET_TURNS), F.lit(-(1 << 60))),
            "tokens": token_count(F.col("role")) + token_count(F.col("text")),
        }
    )


def _totals(rows: DataFrame) -> DataFrame:
    """Rows and tokens before each bucket of a conversation, from sums per bucket."""
    sums = rows.groupBy("conv_key", "bucket").agg(
        F.first("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("rows"),
        F.sum("tokens").alias("sum"),
    )
    in_order = Window.partitionBy("conv_key").orderBy("bucket")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(
        "conv_key", "bucket", "conv_id", "rows",
        F.lead("bucket").over(in_order).isNull().alias("is_last"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("tokens_before"),
    )


def _local(rows: DataFrame) -> DataFrame:
    """Turns with their number in the bucket and the tokens of the bucket up to them.

    This is where texts are shuffled, the only time: everything that is made of it stays
    with the bucket, or is small.
    """
    in_bucket = Window.partitionBy("conv_key", "bucket").orderBy("turn", "role", "text")
    to_here = in_bucket.rowsBetween(Window.unboundedPreceding, 0)
    slim = rows.select("conv_key", "bucket", "turn", "role", "text", "tokens")
    return slim.withColumns(
        {"row": F.row_number().over(in_bucket), "upto": F.sum("tokens").over(to_here)}
    )


def _numbered(local: DataFrame, totals: DataFrame) -> DataFrame:
    """Turns with their number in the conversation and the tokens before them."""
    return local.join(totals, ["conv_key", "bucket"]).withColumns(
        {
            "n": F.col("rows_before") + F.col("row"),
            "start": F.col("tokens_before") + F.col("upto") - F.col("tokens"),
        }
    )


def _system(local: DataFrame, totals: DataFrame) -> DataFrame:
    """The first system turn of each conversation that has one."""
    first = local.where(F.col("role") == "system").groupBy("conv_key", "bucket").agg(
        F.min(F.struct("row", "text", "tokens")).alias("s")
    )
    placed = first.join(totals, ["conv_key", "bucket"]).select(
        "conv_key",
        F.struct(
            (F.col("rows_before") + F.col("s.row")).alias("sys_n"),
            F.col("s.text").alias("sys_text"),
            F.col("s.tokens").alias("sys_tokens"),
        ).alias("s"),
    )
    return placed.groupBy("conv_key").agg(F.min("s").alias("s")).select("conv_key", "s.*")


def _borders(local: DataFrame, totals: DataFrame, history_turns: int) -> DataFrame:
    """Per bucket after the first: the turns just before it, as an array."""
    tail = F.col("row") > F.col("rows") - history_turns
    ends = _numbered(local, totals.where(~F.col("is_last"))).where(tail)
    ends = ends.select(
        F.col("conv_key").alias("past_key"), F.col("n").alias("past_n"), _turn().alias("past")
    )
    back = F.sequence(F.lit(0), F.lit(history_turns - 1))
    wanted = totals.where(F.col("rows_before") > 0).select(
        "conv_key", "bucket", F.explode(F.transform(back, lambda k: F.col("rows_before") - k)).alias("n")
    )
    found = wanted.join(ends, (F.col("conv_key") == F.col("past_key")) & (F.col("n") == F.col("past_n")))
    return found.groupBy("conv_key", "bucket").agg(F.sort_array(F.collect_list("past")).alias("border"))


def _turn() -> Column:
    return F.struct("n", "role", "text", "start")


def _spans(numbered: DataFrame, budget: int, history_tokens: int) -> DataFrame:
    """Rows (conv_key, bucket, conv_id, first_n, first_start, new, ...) one for each span.

    The turns that end in a cell of the conversation's running total, and lie in one bucket,
    are a span. If together with the first, which may begin in an earlier cell, they are
    larger than a cell, the first becomes a span of its own; the others lie inside the cell
    and fit.
    """
    room = budget - history_tokens - F.coalesce("sys_tokens", F.lit(0))
    step = F.greatest(room, F.lit(max(1, budget // 8)))
    end = F.col("start") + F.greatest("tokens", F.lit(1))
    cell = Window.partitionBy("conv_key", "bucket", "cell")
    placed = numbered.withColumn("step", step).withColumn("cell", F.floor((end - 1) / F.col("step")))
    crosses = F.col("start") < F.col("cell") * F.col("step")
    split = (F.sum("tokens").over(cell) > F.col("step")) & F.bool_or("crosses").over(cell)
    halves = placed.withColumn("crosses", crosses).withColumn("split", split)
    half = (F.col("split") & ~F.col("crosses")).cast("int")
    return halves.withColumn("half", half).groupBy("conv_key", "bucket", "cell", "half").agg(
        F.first("conv_id").alias("conv_id"),
        F.first("border").alias("border"),
        F.first("sys_n").alias("sys_n"),
        F.first("sys_text").alias("sys_text"),
        F.min("n").alias("first_n"),
        F.min("start").alias("first_start"),
        F.sort_array(F.collect_list(_turn())).alias("new"),
    )


def _with_context(spans: DataFrame, history_turns: int, history_tokens: int) -> DataFrame:
    """Spans with the turns just before them, from the same bucket or from its border."""
    none = F.array().cast(spans.schema["new"].dataType)
    if history_turns < 1:
        return spans.withColumn("context", none)
    last = lambda c: F.slice(c, F.greatest(F.size(c) - (history_turns - 1), F.lit(1)), history_turns)
    tails = spans.withColumn("tail", last(F.col("new")))
    in_order = Window.partitionBy("conv_key", "bucket").orderBy("first_n")
    # Every span has a turn, so as many spans as turns are enough.
    back = [F.lag("tail", k).over(in_order) for k in range(history_turns, 0, -1)]
    past = F.concat(*[F.coalesce(c, none) for c in (F.col("border"), *back)])
    near = lambda t: F.col("first_start") - t["start"] <= history_tokens
    return tails.withColumn("past", past).withColumn("context", F.filter(last(F.col("past")), near))


def _formatted(spans: DataFrame) -> DataFrame:
    lowest = F.coalesce(F.get("context", F.lit(0))["n"], F.col("first_n"))
    none = F.array().cast(spans.schema["new"].dataType)
    system = F.struct(
        F.col("sys_n").alias("n"), F.lit("system").alias("role"),
        F.col("sys_text").alias("text"), F.lit(0).cast("long").alias("start"),
    )
    head = F.when(F.col("sys_n") < lowest, F.array(system)).otherwise(none)
    repeated = F.concat(head, "context")
    shown = spans.select(
        "conv_id", "first_n", F.size(repeated).alias("n_context"), F.size("new").alias("n_new"),
        F.transform(F.concat(repeated, "new"), _turn_text).alias("turns"),
    )
    return shown.select(
        "conv_id", F.col("first_n").alias("window"), "n_context", "n_new",
        F.concat(F.lit(BOS), F.array_join(F.transform("turns", lambda t: t["shown"]), "")).alias("formatted"),
        _loss_spans().alias("loss_spans"),
    )


def _turn_text(t: Column) -> Column:
    text = escape(t["text"])
    before = F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT))
    return F.struct(
        F.concat(before, text, F.lit(END)).alias("shown"),
        F.length(before).alias("lead"),
        F.length(text).alias("size"),
        (t["role"] == "assistant").alias("target"),
    )


def _loss_spans() -> Column:
    """[start, length) of assistant texts among the new turns, empty ones included."""
    start = F.struct(
        F.lit(len(BOS)).alias("at"),
        F.array().cast("array<struct<start:int,length:int>>").alias("spans"),
    )

    def step(state, item):
        t, i = item["t"], item["i"]
        span = F.struct((state["at"] + t["lead"]).alias("start"), t["size"].alias("length"))
        is_loss = t["target"] & (i >= F.col("n_context"))
        spans = F.when(is_loss, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((state["at"] + F.length(t["shown"])).alias("at"), spans.alias("spans"))

    numbered = F.transform("turns", lambda t, i: F.struct(t.alias("t"), i.alias("i")))
    return F.aggregate(numbered, start, step, lambda s: s["spans"])
