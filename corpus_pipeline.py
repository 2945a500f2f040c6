"""The corpus pipeline: quality rules, language, near-copies, benchmark passages, packing.

Each stage takes all documents that its predecessor kept and returns a DataFrame, which is
written as Parquet and read again as the next one's documents. All stages but the last return the
columns of ``documents``: columns that an operator would name alike go through it under names of their
own and come out unchanged. A null or empty text has no words and goes in the first stage; ties (copies)
leave the smallest id; repeated rows become one among near-copies; an empty table passes through. SQL can't express them (zstandard, token ids), so the pipeline is tested
against a brute-force version.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.llm import decontaminate, jaccard_join, language, packing, quality_bands, tokens
from spendlake.llm.frames import stored, table

ORACLE_SQL = None


def _apart(docs: DataFrame, *read: str) -> tuple[DataFrame, list]:
    """``docs`` with every column but ``read`` under a private name, and the way back."""
    private = {c: f"own{i}__" for i, c in enumerate(docs.columns) if c not in read}
    return docs.withColumnsRenamed(private), [F.col(private.get(c, c)).alias(c) for c in docs.columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and lie inside their compression bands."""
    apart, back = _apart(docs, "text")
    return quality_bands.quality_rules(apart).filter("kept").select(*back)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told apart."""
    apart, back = _apart(docs, "doc_id", "text", "lang")
    return language.language_id(apart).filter("NOT lang_rejected").select(*back)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies."""
    apart, back = _apart(docs, "doc_id", "text")
    return jaccard_join.one_of_each(apart).select(*back)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark passages; documents that are mostly benchmark go."""
    apart, back = _apart(docs, "text")
    clean = decontaminate.remove_spans(apart, table(spark, sf_dir, "benchmark")).select(*back)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequences."""
    return packing.pack_documents(docs, tokens.vocabulary("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("language", known_language), ("near_copies", near_copies), ("decontaminate", no_benchmark), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
