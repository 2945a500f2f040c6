"""Keyed merges: surrogate keys, insert-if-absent, upsert, update-by-key, SCD2."""
import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from spendlake.operators.merge import (assign_keys, insert_absent, merge_upsert, scd2_merge,
                                       update_by_key)


def test_assign_keys_dense_and_ordered(spark):
    df = spark.range(10007).selectExpr("CAST(id * 7919 % 10007 AS BIGINT) AS k").repartition(13)
    out = assign_keys(df, "sk", ["k"], start=100, num_partitions=8)
    ref = df.withColumn("sk2", F.row_number().over(Window.orderBy("k")) + 100)
    rows = out.join(ref, "k").collect()
    assert len(rows) == 10007
    assert all(r["sk"] == r["sk2"] for r in rows)


def test_insert_absent_idempotent_and_null_safe(spark):
    t = spark.createDataFrame([("A", None, 1)], "m string, t string, sk long")
    s = spark.createDataFrame([("A", None), ("A", None), ("B", "x")], "m string, t string")
    once = insert_absent(t, s, ["m", "t"], sk="sk", null_safe=True)
    assert sorted((r["m"], r["t"], r["sk"]) for r in once.collect()) == [("A", None, 1), ("B", "x", 2)]
    twice = insert_absent(once, s, ["m", "t"], sk="sk", null_safe=True)
    assert sorted(twice.collect()) == sorted(once.collect())


def test_merge_upsert(spark):
    t = spark.createDataFrame([(1, 1, "keep-num", 10.0, 0.5), (2, 2, "n2", 20.0, None)],
                              "sk long, id int, num string, v double, score double")
    s = spark.createDataFrame([(1, "src-num", None), (3, "n3", 30.0)], "id int, num string, v double")
    out = {r["id"]: r for r in merge_upsert(t, s, ["id"], update_cols=["v"], sk="sk").collect()}
    assert out[1]["v"] is None and out[1]["num"] == "keep-num" and out[1]["score"] == 0.5 and out[1]["sk"] == 1
    assert out[2]["v"] == 20.0 and out[2]["sk"] == 2
    assert out[3]["v"] == 30.0 and out[3]["num"] == "n3" and out[3]["sk"] == 3
    again = merge_upsert(merge_upsert(t, s, ["id"], ["v"], sk="sk"), s, ["id"], ["v"], sk="sk")
    assert sorted(again.collect()) == sorted(merge_upsert(t, s, ["id"], ["v"], sk="sk").collect())


def test_merge_upsert_rejects_duplicate_source_keys(spark):
    t = spark.createDataFrame([(1, 1.0)], "id int, v double")
    s = spark.createDataFrame([(1, 2.0), (1, 3.0)], "id int, v double")
    with pytest.raises(ValueError):
        merge_upsert(t, s, ["id"], ["v"])


def test_update_by_key(spark):
    t = spark.createDataFrame([(1, 2026, None), (2, 2026, None)], "sk long, ano int, score double")
    s = spark.createDataFrame([(1, 2026, 0.9)], "sk long, ano int, score double")
    assert {r["sk"]: r["score"] for r in update_by_key(t, s, ["sk", "ano"], ["score"]).collect()} == {1: 0.9, 2: None}


HIST = "sk long, doc string, nome string, tipo string, hist int, data_inicio date, data_fim date, versao_atual boolean"


def _scd(spark, history, incoming, day):
    return scd2_merge(history, incoming, "doc", versioned=["nome"], inplace=["hist"], as_of=day, sk="sk")


def test_scd2_fixture_and_invariants(spark):
    d0, d1 = dt.date(2026, 1, 1), dt.date(2026, 7, 23)
    h = spark.createDataFrame([(1, "A", "Alpha", "PF", 0, d0, None, True), (2, "B", "Beta", "PF", 0, d0, None, True),
                               (3, "C", "Gamma", "PF", 1, d0, None, True)], HIST)
    inc = spark.createDataFrame([("A", "Alpha Ltda", "PF", 0), ("B", "Beta", "PF", 4), ("C", "Gamma", "PF", 1),
                                 ("D", "Delta", "PJ", 0)], "doc string, nome string, tipo string, hist int")
    out = _scd(spark, h, inc, d1).collect()
    by = {}
    for r in out:
        by.setdefault(r["doc"], []).append(r)
    a = sorted(by["A"], key=lambda r: r["sk"])
    assert [(r["nome"], r["versao_atual"], r["data_fim"]) for r in a] == [("Alpha", False, d1), ("Alpha Ltda", True, None)]
    assert a[1]["data_inicio"] == d1 and a[1]["sk"] > 3
    assert len(by["B"]) == 1 and by["B"][0]["hist"] == 4 and by["B"][0]["sk"] == 2
    assert len(by["C"]) == 1 and by["C"][0]["versao_atual"]
    assert len(by["D"]) == 1 and by["D"][0]["data_inicio"] == d1
    # one current version per key, unique keys
    assert all(sum(r["versao_atual"] for r in v) == 1 for v in by.values())
    assert len({r["sk"] for r in out}) == len(out)


def test_scd2_same_day_rerun_is_noop(spark):
    d0, d1 = dt.date(2026, 1, 1), dt.date(2026, 7, 23)
    h = spark.createDataFrame([(1, "A", "Alpha", "PF", 0, d0, None, True)], HIST)
    inc = spark.createDataFrame([("A", "Alpha Ltda", "PF", 0)], "doc string, nome string, tipo string, hist int")
    once = _scd(spark, h, inc, d1)
    twice = _scd(spark, once, inc, d1)
    assert sorted(twice.collect()) == sorted(once.collect())


def test_assign_keys_null_business_key_first(spark):
    df = spark.createDataFrame([("b", None), ("a", "x"), ("a", None)], "m string, t string")
    out = sorted((r["sk"], r["m"], r["t"]) for r in assign_keys(df, "sk", ["m", "t"]).collect())
    assert out == [(1, "a", None), (2, "a", "x"), (3, "b", None)]


def test_merges_refuse_repeated_source_keys(spark):
    t = spark.createDataFrame([(1, 1.0)], "k int, v double")
    twice = spark.createDataFrame([(1, 2.0), (1, 3.0)], "k int, v double")
    with pytest.raises(ValueError, match="duplicate"):
        update_by_key(t, twice, ["k"], ["v"])
    history = spark.createDataFrame([("A", "n", dt.date(2020, 1, 1), None, True, 1)],
                                    "cpf string, nome string, data_inicio date, data_fim date, versao_atual boolean, sk long")
    with pytest.raises(ValueError, match="duplicate"):
        scd2_merge(history, spark.createDataFrame([("A", "x"), ("A", "y")], "cpf string, nome string"), "cpf", ["nome"], [], dt.date(2021, 1, 1))


def test_insert_absent_takes_the_smallest_of_repeated_rows(spark):
    t = spark.createDataFrame([], "k int, v string, sk long")
    s = spark.createDataFrame([(1, "b"), (1, "a"), (2, "z"), (1, "c")], "k int, v string")
    for order in (1, 4):
        got = sorted(insert_absent(t, s.repartition(order), ["k"], sk="sk").collect())
        assert [tuple(r) for r in got] == [(1, "a", 1), (2, "z", 2)]


def test_second_gold_load_keeps_keys_and_history(spark, tmpdir_path):
    """Customers renamed, a fifth of the contracts absent: nothing is lost, keys stay, versions close."""
    from spendlake.plans import domain
    from spendlake.plans.load import load_gold
    sf = "/root/testdata/sf0.001"
    silver = {"contratos": domain.contracts(spark, sf), "empenhos": domain.commitments(spark, sf),
              "ordem_bancaria_orcamentaria": domain.payments(spark, sf), "unidade_gestora": domain.units(spark, sf)}
    silver = {n: df.checkpoint() for n, df in silver.items()}
    one = {n: df.checkpoint() for n, df in load_gold(spark, silver, tmpdir_path, "2026-01-01").items()}
    con = silver["contratos"].filter("id % 5 != 0").withColumn("descricao_nome_credor", F.concat("descricao_nome_credor", F.lit(" II")))
    two = load_gold(spark, silver | {"contratos": con}, tmpdir_path, "2026-07-23")
    for name, sk, *key in (("fato_contrato", "sk_contrato", "id_contrato_origem", "ano"), ("fato_empenho", "sk_empenho", "id_empenho_origem", "ano"),
                           ("dim_orgao", "sk_orgao", "codigo_orgao"), ("dim_tempo", "sk_tempo", "data")):
        assert sorted(two[name].select(*key, sk).collect()) == sorted(one[name].select(*key, sk).collect())
    old, cred = one["dim_credor"].count(), two["dim_credor"]
    renamed = con.select("cpf_cnpj_financiador").distinct().count()
    assert cred.filter("NOT versao_atual").count() == renamed == cred.filter("NOT versao_atual AND data_fim = '2026-07-23'").count()
    assert cred.count() == old + renamed and cred.filter("versao_atual").groupBy("cpf_cnpj").count().filter("count > 1").isEmpty()
    current = {r["sk_credor"] for r in cred.filter("versao_atual").collect()}
    assert {r["sk_credor"] for r in two["fato_contrato"].filter("id_contrato_origem % 5 != 0").collect()} <= current


def test_rows_without_a_key_never_come_in(spark):
    """Null keys: neither loads that repeat nor the creditor history take them up."""
    from spendlake.operators.merge import insert_absent, merge_upsert, scd2_merge
    target = spark.createDataFrame([(1, 1, "a")], "sk long, k long, v string")
    source = spark.createDataFrame([(1, "b"), (None, "x"), (2, "c")], "k long, v string")
    once = merge_upsert(target, source, ["k"], ["v"], sk="sk").checkpoint()
    twice = merge_upsert(once, source, ["k"], ["v"], sk="sk")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [(1, 1, "b"), (2, 2, "c")]
    assert sorted(r["k"] for r in insert_absent(target, source, ["k"], sk="sk").collect()) == [1, 2]
    history = spark.createDataFrame([(1, "d1", "A", "2025-01-01", None, True)], "sk long, doc string, nome string, data_inicio string, data_fim string, versao_atual boolean")
    history = history.selectExpr("sk", "doc", "nome", "CAST(data_inicio AS DATE) AS data_inicio", "CAST(data_fim AS DATE) AS data_fim", "versao_atual")
    out = scd2_merge(history, spark.createDataFrame([("d1", "A"), (None, "N")], "doc string, nome string"), "doc", ["nome"], [], "2026-01-01").collect()
    assert [(r["doc"], r["nome"], r["versao_atual"]) for r in out] == [("d1", "A", True)]
