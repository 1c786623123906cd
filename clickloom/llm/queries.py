"""One query per operator over its whole table, with production parameters.

The digests that a query returns are derived from what its operator really gives out.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.llm.batches import work_folder, written
from clickloom.llm.chat_windows import chat_windows, read_digest
from clickloom.llm.decontaminate import hit_report, with_hits
from clickloom.llm.html_extract import extract_pages
from clickloom.llm.id_planes import read_token_planes, write_token_planes
from clickloom.llm.languages import fit_languages, predicted_languages
from clickloom.llm.languages import is_held_out as is_held_out_language
from clickloom.llm.line_dedup import with_line_spread
from clickloom.llm.near_dedup import near_duplicates
from clickloom.llm.oracles import ORACLES as ORACLES
from clickloom.llm.packing import packed_documents
from clickloom.llm.periodic_runs import longest_run, with_runs
from clickloom.llm.prefix_trie import prefix_trie, turn_ids
from clickloom.llm.quality_model import fit_quality, is_held_out, quality_scores
from clickloom.llm.quality_rules import SPACES, with_quality
from clickloom.llm.token_counts import token_counts
from clickloom.operators.skew import key_copy

BYTE_BPE = "byte_bpe_50k.json"
TOKEN_LIMIT = 512
NEAR_WORDS = 4
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def _table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _token_id_planes(spark, sf):
    path = work_folder(spark, "token-planes")
    write_token_planes(_table(spark, sf, "documents"), path, BYTE_BPE, end_id=0)
    ids = read_token_planes(spark, path)
    return ids.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def _token_counts(spark, sf):
    counts = token_counts(_table(spark, sf, "documents"), BYTE_BPE)
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def _quality_model(spark, sf):
    docs = _table(spark, sf, "documents")
    model = fit_quality(docs, _table(spark, sf, "labels"))
    scores = quality_scores(docs, model)
    return scores.select("doc_id", is_held_out("doc_id").alias("held_out"), "score", "predicted")


def _packing(spark, sf):
    return packed_documents(_table(spark, sf, "documents"), BYTE_BPE, end_id=0)


def _page_text(spark, sf):
    return extract_pages(_table(spark, sf, "pages"))


def _line_dedup(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text", "source")
    return with_line_spread(docs).select("doc_id", "_lines.*", "text")


def _benchmark_hits(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return hit_report(with_hits(docs, _table(spark, sf, "benchmark"), keep=["doc_id"]))


def _quality_rules(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text", "lang")
    return with_quality(docs, keep=["doc_id"]).select("doc_id", "_quality.*")


def _near_duplicates(spark, sf):
    return near_duplicates(_table(spark, sf, "documents"), NEAR_WORDS)


def _chat_windows(spark, sf):
    turns = _table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    return read_digest(chat_windows(turns.unionByName(added)))


def _planted_periods(docs):
    """Rows (doc_id, text), a tenth of the texts with a stretch of their words made periodic."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", SPACES), lambda w: w != "")
    chosen = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    n = F.size("words")
    start = F.col("g") % n
    period = 1 + F.floor((n - start) / (3 + F.col("g") % 8))
    place = lambda i: F.when(i < start, i).otherwise(start + (i - start) % period).cast("int")
    planted = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("words", place(i)))
    text = F.when(n > 0, F.array_join(planted, " ")).otherwise(F.col("text"))
    return chosen.select("doc_id", text.alias("text"))


def _periodic_runs(spark, sf):
    found = with_runs(_planted_periods(_table(spark, sf, "documents")))
    runs = F.col("_runs.runs")
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    digest = lambda text: F.sha2(F.encode(text, "UTF-8"), 256)
    shown = found.select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        longest_run(runs).alias("best"),
        digest(F.array_join(lines, "")).alias("runs_sha256"),
        digest(F.col("_runs.collapsed")).alias("collapsed_sha256"),
    )
    return shown.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256",
    )


def _languages(spark, sf):
    docs = _table(spark, sf, "documents")
    found = predicted_languages(docs, fit_languages(docs))
    return found.select(
        "doc_id", is_held_out_language("doc_id").alias("held_out"), "lang_pred", "score",
        F.size("spans").cast("long").alias("n_spans"),
    )


def rebuilt_turns(turns):
    """(places, conversations): some first turns of a conversation replaced by another's."""
    numbered = written(turn_ids(turns), "turn-ids")
    turn = F.struct("place", "id", "n_bytes")
    # At most eight turns are taken from the head of a conversation.
    heads = numbered.where(F.col("place") < 8).groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(turn)).alias("head")
    )
    convs = numbered.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    convs = convs.select(
        "conv_id", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int").alias("h"),
        (F.col("conv_id") - F.col("conv_id") % 5).alias("from"),
    )
    joined = convs.join(heads, F.col("from") == F.col("base"), "left")
    none = F.array().cast("array<struct<place:bigint,id:string,n_bytes:int>>")
    taken = F.slice(F.coalesce("head", none), F.lit(1), F.col("h"))
    convs = written(joined.select("conv_id", "h", taken.alias("taken")), "rebuilt")
    first = convs.select("conv_id", F.inline("taken"))
    shift = convs.select(key_copy("conv_id").alias("conv"), "h", (F.size("taken") - F.col("h")).alias("shift"))
    own = numbered.join(shift, F.col("conv_id") == F.col("conv")).where(F.col("place") >= F.col("h"))
    own = own.select("conv_id", (F.col("place") + F.col("shift")).alias("place"), "id", "n_bytes")
    return first.unionByName(own), convs.select("conv_id")


def _prefix_trie(spark, sf):
    return prefix_trie(*rebuilt_turns(_table(spark, sf, "conversations")))


QUERIES = {
    "op1_token_id_planes": _token_id_planes,
    "op2_token_counts": _token_counts,
    "op3_quality_model": _quality_model,
    "op4_packing": _packing,
    "op5_page_text": _page_text,
    "op6_line_dedup": _line_dedup,
    "op7_benchmark_hits": _benchmark_hits,
    "op8_quality_rules": _quality_rules,
    "op9_near_duplicates": _near_duplicates,
    "op10_chat_windows": _chat_windows,
    "op11_prefix_trie": _prefix_trie,
    "op12_periodic_runs": _periodic_runs,
    "op13_languages": _languages,
}


