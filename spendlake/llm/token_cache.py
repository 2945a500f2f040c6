"""Token counts with a digest cache.

Counts are stored by (digest of the normalised content, digest of the tokenizer's version).
Contents whose digest the cache holds are never encoded again; of the others each distinct one
is encoded once and appended to the cache. Copies are reduced within each map task before the
misses are dealt out by digest, so a text that a third of the rows share costs one encoding and
one shuffled row a task.

Normalised content: a null text is the empty one; nothing else is changed, so counts are those
of the library for the whole text. A missing cache folder is an empty cache. An append that is
lost half-way leaves no rows behind (the write commits as a whole), and a digest that two runs
appended has one count. Repeated rows give repeated results; other columns are left out.
"""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm import tokens
from spendlake.llm.frames import ready, stored
from spendlake.session import path_exists

CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens long"


def _first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose digest this task has not met before."""
    met: set[bytes] = set()
    for batch in batches:
        fresh = []
        for d in batch.column(0).to_pylist():
            fresh.append(d not in met)
            met.add(d)
        yield batch.filter(pa.array(fresh))


def _encoded(path: str, version: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokens.encoder(path)
        for batch in _first_of_each(batches):
            counts = [len(x) for x in own.slices(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([version] * len(counts), pa.string()), pa.array(counts, pa.int64())],
                names=["digest", "tokenizer", "n_tokens"])
    return run


def read_cache(spark, cache: str, version: str) -> DataFrame | None:
    if not path_exists(spark, cache):
        return None
    rows = spark.read.schema(CACHE_SCHEMA).parquet(cache).filter(F.col("tokenizer") == version)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def add_misses(contents: DataFrame, cache: str, path: str) -> None:
    """Encode the contents (digest, text) that the cache lacks and append their counts."""
    spark = contents.sparkSession
    version = tokens.version(path)
    known = read_cache(spark, cache, version)
    misses = contents.mapInArrow(_first_of_each, contents.schema)
    if known is not None:
        misses = misses.join(known, "digest", "left_anti")
    misses = misses.repartition("digest")
    misses.mapInArrow(_encoded(path, version), CACHE_SCHEMA).write.mode("append").parquet(cache)


def token_counts(docs: DataFrame, cache: str, path: str, doc_id: str = "doc_id", text: str = "text",
                 limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document; ``cache`` grows by the misses."""
    spark = ready(docs)
    whole = F.coalesce(F.col(text), F.lit(""))
    digest = F.unhex(F.sha2(whole, 256))
    add_misses(docs.select(digest.alias("digest"), whole.alias("text")), cache, path)
    keyed = docs.select(F.col(doc_id), digest.alias("digest"), F.octet_length(whole).cast("long").alias("n_bytes"))
    # one written row a digest: the join then has shuffles of its own, which are split where a digest is hot
    counts = stored(read_cache(spark, cache, tokens.version(path)), "token-counts")
    out = keyed.join(counts, "digest")
    return out.select(doc_id, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
