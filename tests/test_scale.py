"""What a query leaves on disk and how often it does its dear steps, seen on small tables."""
import os

import pytest
from pyspark.sql import functions as F

from spendlake.operators import anomaly as IF
from spendlake.operators import joins
from spendlake.operators import quality as Q
from spendlake.operators.merge import number_keys
from spendlake.plans import domain, gold
from spendlake.plans.queries import build_report
from spendlake.session import ensure_checkpoint_dir, stored
from spendlake.sources.bucketed import BucketedTable, _colocated

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffle_files(spark) -> int:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum("shuffle_" in files.apply(i).getName() for i in range(files.size()))


def _unplanned(spark, **conf):
    """Sets the given configuration; returns what puts it back."""
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    return lambda: [spark.conf.set(k, v) for k, v in before.items()]


def test_stored_frames_leave_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    df = stored(spark.range(5000).groupBy((F.col("id") % 700).alias("k")).count(), "t")
    assert _shuffle_files(spark) <= before and df.count() == 700


def test_a_load_leaves_neither_its_batch_nor_shuffle_files(spark, tmpdir_path):
    rows = spark.range(300).selectExpr("id", "CAST(2000 + id % 3 AS INT) AS ano", "CAST(id AS STRING) AS v")
    table = BucketedTable(spark, f"{tmpdir_path}/fact", "id", buckets=4)
    folder, before = ensure_checkpoint_dir(spark).removeprefix("file://"), _shuffle_files(spark)
    seen = set(os.listdir(folder))
    for batch in (rows.filter("id < 200"), rows):
        table.upsert(batch, "sk")
        assert not [n for n in set(os.listdir(folder)) - seen if n.startswith("batch")] and _shuffle_files(spark) <= before
    assert sorted((r["id"], r["sk"]) for r in table.read().collect()) == [(i, i + 1) for i in range(300)]


def test_wide_rows_of_a_batch_are_shuffled_once(spark, tmpdir_path):
    rows = spark.range(40).selectExpr("id", "CAST(2000 + id % 3 AS INT) AS ano", "CAST(id AS STRING) AS v")
    table = BucketedTable(spark, f"{tmpdir_path}/fact", "id", buckets=4)
    table.upsert(rows.filter("id < 30"), "sk")
    back = _unplanned(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    try:
        merged = table.merged(rows, "sk")
        with _colocated(spark):
            plan = _physical(merged)
        assert plan.count("Exchange hashpartitioning") == 1
    finally:
        back()
    assert sorted((r["id"], r["sk"]) for r in merged.collect()) == [(i, i + 1) for i in range(40)]


def test_keys_are_counted_where_they_are_numbered(spark):
    keys = spark.createDataFrame([(3, "a"), (1, "b"), (None, "c"), (1, None)], "k int, y string")
    got = number_keys(keys, "sk", start=10, num_partitions=3)
    assert sorted((r["sk"], r["k"], r["y"]) for r in got.collect()) == [(11, None, "c"), (12, 1, None), (13, 1, "b"), (14, 3, "a")]
    with pytest.raises(ValueError, match="duplicate"):
        number_keys(keys.unionByName(keys.filter("k = 3")), "sk")


def test_a_large_dimension_is_cut_to_the_rows_a_fact_refers_to(spark):
    fact = spark.range(60).selectExpr("id", "IF(id % 4 = 3, NULL, id % 4 * 5) AS k")
    dim = spark.range(100).selectExpr("id AS d", "id * 2 AS v")
    join = lambda limit: joins.lookup_join(fact, joins.small_for(fact, "k", dim, "d", limit), [("k", "d")], {"v": "v"})
    assert "strategy=broadcast" in _plan(join(3)) and "strategy=broadcast" not in _plan(join(2))
    assert sorted(map(str, join(3).collect())) == sorted(map(str, join(2).collect())) == sorted(map(str, join(100).collect()))


def test_unit_facts_are_the_same_with_dimensions_beyond_the_limit(spark, monkeypatch):
    for fact in (gold.fato_empenho, gold.fato_ordem_bancaria):
        want = sorted(map(str, fact(spark, SF).collect()))
        with monkeypatch.context() as m:
            m.setattr(joins, "BROADCAST_ROWS", 12)
            assert sorted(map(str, fact(spark, SF).collect())) == want


def test_a_unit_fact_is_numbered_before_its_joins(spark):
    """Its rows come from one stored table and are not stored again: the joins are in the plan, no key is given after them."""
    plan = _plan(gold.fato_empenho(spark, SF))
    assert "LeftOuter" in plan and plan.index("__place") > plan.index("LeftOuter")


def test_rows_without_a_year_take_no_key(spark, monkeypatch):
    real = domain.commitments
    monkeypatch.setattr(domain, "commitments", lambda *a, **k: real(*a, **k).withColumn("ano", F.when(F.col("id") % 5 > 0, F.col("ano"))))
    rows = gold.fato_empenho(spark, SF).select("sk_empenho", "id_empenho_origem", "ano").collect()
    assert rows and sorted(r["sk_empenho"] for r in rows) == list(range(1, len(rows) + 1)) and all(r["id_empenho_origem"] % 5 for r in rows)
    by_key = sorted(rows, key=lambda r: (r["id_empenho_origem"], r["ano"]))
    assert [r["sk_empenho"] for r in by_key] == list(range(1, len(rows) + 1))


def test_unique_items_are_short(spark):
    df = spark.createDataFrame([(1, 2000, "x|y", None), (1, None, "x", "y"), (1, None, "x", "z"), (None, None, "x", "y")], "id long, ano int, a string, b string")
    check = Q.check_table(df, "t", not_null=["id"], unique=[["id", "ano"], ["a", "b"], ["id"], ["ano"]], unresolved=["ano", "b"], min_rows=4)
    assert "to_json" not in _plan(Q.check_table(df, "t", not_null=["id"], unique=[["id", "ano"]])) and "sum(t0" not in _plan(check)
    assert {(r["check"], r["n_bad"]) for r in check.collect()} == {("not_null:id", 1), ("unique:id,ano", 1), ("unique:a,b", 1), ("unique:id", 1), ("unique:ano", 1),
                                                                    ("unresolved:ano", 3), ("unresolved:b", 1), ("min_rows>=4", 0)}


def test_scored_rows_are_dealt_before_they_meet_the_trees(spark):
    df = spark.range(300).selectExpr("id", "CAST(id % 50 AS DOUBLE) AS v", "CASE WHEN id % 2 = 0 THEN 'A' ELSE 'B' END AS cat")
    nodes = IF.fit(df, "id", ["v"], ["cat"], trees=5, seed=3)
    back = _unplanned(spark, spark__sql__adaptive__enabled="false")
    try:
        lines = _physical(IF.score(df, nodes, "id", ["v"], ["cat"])).splitlines()
    finally:
        back()
    join = next(i for i, x in enumerate(lines) if "NestedLoopJoin" in x)
    assert not any("Exchange" in x for x in lines[:join]) and "hashpartitioning(id" in "".join(lines[join:])


def test_a_report_plans_its_sections_once(spark):
    fact = spark.createDataFrame([(1, "a", 5, 1, 1, 0.5, 1, 1, 1), (2, "b", 7, 9, 1, None, 1, 2, 1)],
                                 "sk_contrato long, num_contrato string, valor_contratado long, valor_pago long, valor_empenhado long, score_anomalia double, sk_modalidade long, sk_credor long, sk_orgao long")
    dims = {"dim_modalidade": spark.createDataFrame([(1, "m")], "sk_modalidade long, descricao_modalidade string"),
            "dim_credor": spark.createDataFrame([(1, "c", "1", 2, True), (2, "e", "2", 0, True)], "sk_credor long, nome string, cpf_cnpj string, historico_infringement int, versao_atual boolean"),
            "dim_orgao": spark.createDataFrame([(1, "o")], "sk_orgao long, nome string")}
    forecasts = spark.createDataFrame([("2026-Q4", 1, 1.0, 0.5, 2.0, "n", "2026-01-01")],
                                      "trimestre_referencia string, sk_orgao long, valor_previsto double, intervalo_inferior double, intervalo_superior double, modelo string, data_geracao string")
    report = build_report(dims, fact, forecasts, "2026-01-01")
    assert "Join" not in _plan(report)
    text = report.first()["conteudo_markdown"]
    assert "| 1 | a | 5 | 0.5 | m | c | o |" in text and "| c | 1 | 2 | 1 | 5.00 |" in text and "| 2026-Q4 | o |" in text
