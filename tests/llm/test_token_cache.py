from spendlake.llm import token_cache as C
from spendlake.llm import tokens
from spendlake.session import scratch_path
from tests.llm.helpers import docs, prose, rows

PATH = tokens.vocabulary("byte_bpe_50k.json")


def brute(texts):
    own = tokens.Encoder(PATH)
    counts = [len(x) // 4 for x in own.plain([t or "" for t in texts])]
    return sorted(((i, len((t or "").encode()), n, n > 512) for i, (t, n) in enumerate(zip(texts, counts))), key=repr)


def test_counts_and_cache(spark):
    cache = scratch_path(spark, "test-cache")
    texts = [None, "", "a", "a", "<|endoftext|> and <|endoftext|>", prose(600, 1), prose(50_000, 2), " lead", "trail ", "é\u00a0ü"]
    df = docs(spark, texts).withColumnRenamed("lang", "digest").withColumnRenamed("source", "n_tokens")
    assert rows(C.token_counts(df, cache, PATH)) == brute(texts)
    held = spark.read.parquet(cache)
    assert held.count() == len({t or "" for t in texts}) == held.select("digest").distinct().count()
    # known contents are not encoded again, new ones are appended once
    more = [*texts, "new", "new", prose(30, 9)]
    assert rows(C.token_counts(docs(spark, more), cache, PATH)) == brute(more)
    assert spark.read.parquet(cache).count() == len({t or "" for t in more})


def test_stored_counts_are_used(spark):
    cache = scratch_path(spark, "test-cache")
    df = docs(spark, ["one", "two"])
    C.token_counts(df, cache, PATH).collect()
    wrong = spark.read.schema(C.CACHE_SCHEMA).parquet(cache).selectExpr("digest", "tokenizer", "n_tokens + 1000 AS n_tokens")
    other = scratch_path(spark, "test-cache")
    wrong.write.parquet(other)
    assert all(r["n_tokens"] > 1000 for r in C.token_counts(df, other, PATH).collect())
    # counts of another tokenizer's version are not
    third = scratch_path(spark, "test-cache")
    wrong.selectExpr("digest", "'other' AS tokenizer", "n_tokens").write.parquet(third)
    assert rows(C.token_counts(df, third, PATH)) == brute(["one", "two"])


def test_empty_table(spark):
    assert C.token_counts(docs(spark, []).limit(0), scratch_path(spark, "test-cache"), PATH).collect() == []
