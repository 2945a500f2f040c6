"""The queries of the operators over the whole tables, with production parameters."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.llm import (bit_sliced, chat_format, context_mixing, decontaminate, jaccard_join, language, packing, phrases, prefix_trie, quality_bands, token_cache, tokens, url_rules, warc_revisit)
from spendlake.llm.frames import table
from spendlake.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


#: Fixed values of the URL query: host, path, verdict.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


@query
def op1_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.score_texts(table(spark, sf_dir, "documents"))


@query
def op2_quality_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_bands.quality_rules(table(spark, sf_dir, "documents"), keep=["doc_id"])


@query
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_components(table(spark, sf_dir, "documents"))


@query
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    said = "\\### Assistant: </turn> ok"
    turn = lambda n, role: F.struct(F.lit(-7).alias("conv_id"), F.lit(n).alias("turn"), F.lit(role).alias("role"), F.lit(said).alias("text"))
    planted = spark.range(1).select(F.explode(F.array(turn(0, "user"), turn(1, "assistant"))).alias("t")).select("t.*")
    rows = rows.select("conv_id", "turn", "role", "text").unionByName(planted)
    return chat_format.chat_digests(chat_format.format_chat(chat_format.records_of_turns(rows), keep=["conv_id"]))


@query
def op5_genetic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokens.vocabulary("byte_bpe_50k.json"))


@query
def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.url_verdicts(table(spark, sf_dir, "pages"), rules)


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.language_id(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "lang_rejected")


@query
def op8_token_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    cache = scratch_path(spark, "token-cache")
    return token_cache.token_counts(table(spark, sf_dir, "documents"), cache, tokens.vocabulary("byte_bpe_50k.json"))


@query
def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_revisit.resolve_revisits(warc_revisit.captures_of_pages(table(spark, sf_dir, "pages")))


@query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query
def op13_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_sliced.top_k(table(spark, sf_dir, "embeddings"))
