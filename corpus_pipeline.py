"""The corpus pipeline: from raw documents to packed training sequences.

Each stage works on all that the one before kept. All but the last return the columns of
``documents``; texts that a stage has changed come with their new ``n_chars``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.decontaminate import without_passages
from clickloom.llm.line_dedup import without_spread_lines
from clickloom.llm.near_dedup import without_near_duplicates
from clickloom.llm.packing import packed_documents
from clickloom.llm.quality_rules import quality_filter
from clickloom.sources.workspace import drop_folder, work_folder

TOKENIZER = "byte_bpe_50k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_filter(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines spread over many sources stay in their first document only."""
    return _recounted(without_spread_lines(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _recounted(without_passages(docs, benchmark))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces with their sequences and places."""
    return packed_documents(docs, TOKENIZER, end_id=0)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Tokens cannot be expressed in SQL; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written before the next one reads it.

    A stage's table goes once the next one is written; the last of them stays, as the result
    still reads it.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        path = work_folder(spark, name)
        kept = stage(spark, docs, sf_dir)
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if before is not None:
            drop_folder(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)


def _recounted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    n_chars = F.length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return docs.select(*[n_chars if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])
