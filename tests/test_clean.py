"""Bronze -> Silver operators: latest version, cleaning, unit enrichment."""
import datetime as dt

from spendlake.operators.clean import clean_events, enrich_with_units
from spendlake.operators.dedupe import dedupe_latest, first_per_key, latest_mapping


def test_dedupe_latest_keeps_newest(spark):
    df = spark.createDataFrame([(1, 2026, dt.datetime(2026, 1, 1), 100), (1, 2026, dt.datetime(2026, 6, 1), 999),
                                (2, 2026, dt.datetime(2026, 1, 1), 50)], "id int, ano int, updated_at timestamp_ntz, valor int")
    out = {r["id"]: r["valor"] for r in dedupe_latest(df, ["id", "ano"]).collect()}
    assert out == {1: 999, 2: 50}


def test_dedupe_latest_null_order_wins_and_total_tie(spark):
    df = spark.createDataFrame([(1, None, 5), (1, dt.datetime(2030, 1, 1), 7), (2, None, 1), (2, None, 3)],
                               "id int, updated_at timestamp_ntz, v int")
    out = {r["id"]: r["v"] for r in dedupe_latest(df, ["id"], tie=["v"]).collect()}
    assert out == {1: 5, 2: 3}


def test_dedupe_independent_of_partitioning(spark):
    df = spark.range(2000).selectExpr("id % 37 AS k", "id AS v", "CAST(NULL AS TIMESTAMP_NTZ) AS updated_at")
    a = sorted(dedupe_latest(df.repartition(1), ["k"]).collect())
    b = sorted(dedupe_latest(df.repartition(17), ["k"]).collect())
    assert a == b


def test_clean_commitments(spark):
    raw = spark.createDataFrame([
        (1, 2026, "123.456.789-00", "1000.50", "2026-01-10", None, "2026-01-10", "2026-01-10", "2026-01-10"),
        (1, 2026, "123.456.789-00", "1000.50", "2026-01-10", None, "2026-01-10", "2026-01-10", "2026-01-09"),
    ], "id int, ano int, codigocredor string, valor string, dataemissao string, datacancelamento string, "
       "datacontabilizacao string, created_at string, updated_at string")
    out = clean_events(raw, tie=["dataemissao", "valor"]).collect()
    assert len(out) == 1
    assert out[0]["codigocredor"] == "12345678900" and out[0]["valor"] == 1000.5


def test_enrich_fills_unit_and_keeps_own_code(spark):
    ev = spark.createDataFrame([("100606", 2026, 10.0, "2022NE007525")], "codigoug string, ano int, valor double, codigo string")
    ug = spark.createDataFrame([("100606", 2026, "UG X", "123")], "codigo string, ano int, titulo string, cnpj string")
    r = enrich_with_units(ev, ug).first()
    assert r["nome_ug"] == "UG X" and r["cnpj_ug"] == "123" and r["codigo"] == "2022NE007525"
    assert "codigo_ug" not in enrich_with_units(ev, ug).columns


def test_latest_mapping_newest_year(spark):
    ug = spark.createDataFrame([("100606", 2022, "10000000"), ("100606", 2026, "10200006")],
                               "codigo string, ano int, codigoorgao string")
    m = latest_mapping(ug, "codigo", "codigoorgao", "ano", key_alias="codigo_ug", value_alias="codigo_orgao")
    assert m.columns == ["codigo_ug", "codigo_orgao"]
    assert [tuple(r) for r in m.collect()] == [("100606", "10200006")]


def test_first_per_key(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "k string, o int, v string")
    assert {r["k"]: r["v"] for r in first_per_key(df, ["k"], ["o"]).collect()} == {"a": "y", "b": "z"}
