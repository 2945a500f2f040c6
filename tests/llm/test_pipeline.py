import corpus_pipeline as P
from spendlake.llm import language
from tests.llm import test_decontaminate, test_jaccard_join, test_quality_bands
from tests.llm.helpers import SF, docs
from tests.llm.test_packing import check


def test_stages_against_brute_force(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r for r in table.collect()}
    assert [name for name, _ in P.STAGES] == ["quality", "language", "near_copies", "decontaminate", "pack"]

    out = P.quality(spark, table, SF)
    assert out.columns == table.columns
    keep = {i for i, r in texts.items() if test_quality_bands.brute(r["text"])[-1]}
    assert {r["doc_id"] for r in out.collect()} == keep and len(keep) > 0.8 * len(texts)

    docs_ = out.checkpoint()
    out = P.known_language(spark, docs_, SF)
    judge = language.Classifier(language.learn(docs_.filter(~language.held_out()))).judge
    keep = {i for i in keep if (j := judge(texts[i]["text"]))[0] != "und" and j[1] >= language.MIN_MARGIN}
    assert out.columns == table.columns and {r["doc_id"] for r in out.collect()} == keep

    docs_ = out.checkpoint()
    out = P.near_copies(spark, docs_, SF)
    named = test_jaccard_join.brute([(i, texts[i]["text"]) for i in sorted(keep)])
    keep = {i for i, _, c in named if i == c}
    assert out.columns == table.columns and {r["doc_id"] for r in out.collect()} == keep

    docs_ = out.checkpoint()
    out = P.no_benchmark(spark, docs_, SF).checkpoint()
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = {r[0]: r for r in test_decontaminate.brute([(i, texts[i]["text"]) for i in keep], items)}
    after = {r["doc_id"]: r for r in out.collect()}
    assert out.columns == table.columns
    assert set(after) == {i for i, r in before.items() if 2 * r[2] <= r[1]}
    assert all((r["text"] == texts[i]["text"]) == (before[i][2] == 0) and r["n_chars"] == len(r["text"]) for i, r in after.items())
    assert not any(r[5] for r in test_decontaminate.brute([(i, r["text"]) for i, r in after.items()], items))

    used, least = check(P.pack(spark, out, SF).collect(), [(i, r["text"]) for i, r in after.items()])
    assert used <= least * 1.03 + 1


def test_run_is_its_stages(spark):
    found = P.run(spark, SF)
    assert {"doc_id", "piece", "sequence_id", "offset", "length"} <= set(found.columns) and found.count() > 100


def test_edges_go_through(spark):
    texts = [None, "", " ", "a", "x" * 300_000, "word " * 500]
    df = docs(spark, texts)
    for _, stage in P.STAGES:
        df = stage(spark, df, SF).checkpoint()
    assert df.count() == 0


def test_columns_that_operators_name_alike_pass_unchanged(spark):
    from pyspark.sql import functions as F

    from tests.llm.helpers import prose
    df = docs(spark, [prose(60, i) for i in range(30)] + [prose(60, 3)])
    more = {"n_words": F.lit(-1), "kept": F.lit("mine"), "band": F.lit("mine"), "score": F.lit(-5.0), "lang_pred": F.col("doc_id"), "component_id": F.lit("c"), "_n_words": F.lit(7), "_hit_from": F.lit(0)}
    df = df.withColumns(more).checkpoint()
    rows = {r["doc_id"]: r for r in df.collect()}
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, df, SF).checkpoint()
        assert out.schema == df.schema, name
        got = out.collect()
        assert got and all(r == rows[r["doc_id"]] for r in got), name
        df = out
    assert set(P.pack(spark, df, SF).columns) >= {"doc_id", "sequence_id"}
