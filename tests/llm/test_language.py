import random

from spendlake.llm import language as L
from spendlake.llm.queries import QUERIES
from tests.llm.helpers import DOCS, SF, docs, prose


def test_held_out_accuracy(spark):
    texts = {r["doc_id"]: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    found = QUERIES["op7_language_id"](spark, "/root/testdata/sf0.01").collect()
    assert len(found) == len(texts)
    out = [r for r in found if r["held_out"]]
    assert sum(r["lang_pred"] == texts[r["doc_id"]]["lang"] for r in out) >= 0.97 * len(out)
    long = [r for r in found if len(texts[r["doc_id"]]["text"].split()) >= 20]
    assert sum(r["lang_rejected"] for r in long) <= 0.01 * len(long) and all(0 <= r["score"] <= 1 for r in found)


def other(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice("der die und nicht ein für ist über zwischen größer häuser schön jahre wurde weil auch noch werden".split()) for _ in range(n))


def native(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice("the and that with which there people would about their through because between number against another".split()) for _ in range(n))


def test_edges(spark):
    df = docs(spark, [native(80, i) for i in range(20)] + [other(80, i) for i in range(20)])
    df = df.selectExpr("doc_id", "text", "CASE WHEN doc_id < 20 THEN 'aa' ELSE 'bb' END AS lang", "source", "n_chars")
    content = L.learn(df)
    assert set(content) == {"aa", "bb"} and all(0 < len(x) <= L.DICTIONARY for x in content.values())
    probe = docs(spark, [None, "", "12 34 !!", native(60, 999), other(60, 998), native(60, 999), native(20_000, 3)]).withColumnRenamed("source", "score")
    got = [(r["lang_pred"], r["lang_rejected"]) for r in L.identify(probe, content).orderBy("doc_id").collect()]
    assert got == [("und", True)] * 3 + [("aa", False), ("bb", False), ("aa", False), ("aa", False)]
    assert L.identify(probe.limit(0), content).collect() == []


def test_without_labels_everything_is_unknown(spark):
    df = spark.createDataFrame([(1, "some text", None, "s", 1), (2, None, "en", "s", 1)], DOCS)
    assert L.learn(df) == {}
    assert {r["lang_pred"] for r in L.language_id(df).collect()} == {"und"}


def test_one_language(spark):
    df = docs(spark, [prose(50, i) for i in range(30)])
    assert {r["lang_pred"] for r in L.language_id(df).collect()} == {"en"}


def test_no_prediction_reads_the_label(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    content = L.learn(df.filter(~L.held_out()))
    a = sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in L.identify(df, content, keep=["doc_id"]).collect())
    b = sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in L.identify(df.select("doc_id", "text"), content, keep=["doc_id"]).collect())
    assert a == b


def test_one_id_with_most_rows_does_not_enlarge_the_sample(spark, monkeypatch):
    """Unlike texts of one length and id share a hash, so they are drawn together."""
    from pyspark.sql import functions as F
    monkeypatch.setattr(L, "SAMPLE_TEXTS", 20)
    rows = spark.range(600).select(F.lit("aa").alias("lang"), F.format_string("text %05d", "id").alias("text"), F.lit(7).cast("long").alias("h"))
    rows = rows.unionByName(rows)
    found = L.sampled(rows, {"aa": 1200}).collect()
    assert len(found) == 20 == len({r["s"] for r in found})
    assert found and L.sampled(rows.repartition(7), {"aa": 1200}).exceptAll(L.sampled(rows, {"aa": 1200})).isEmpty()
