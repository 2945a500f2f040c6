"""Dimension builders."""
import datetime as dt

from spendlake.operators.dims import (agency_dim, calendar_dim, creditor_dim, mode_by_group,
                                      modality_dim)

UG = "codigo string, ano int, codigoorgao string, titulo string, cnpj string, tipoadministracao string, nomepoder string, updated_at timestamp_ntz"


def test_calendar_distinct_days(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 5),), (dt.datetime(2026, 1, 5, 13),), (dt.datetime(2026, 3, 20),)],
                               "d timestamp_ntz")
    rows = sorted(calendar_dim((df, "d")).collect())
    assert len(rows) == 2
    r = rows[0]
    assert (r["ano"], r["trimestre"], r["mes"], r["ano_mes"], r["dia_semana"]) == (2026, 1, 1, "2026-01", 0)


def test_agency_mode_fallback(spark):
    ug = spark.createDataFrame([
        ("01001", 2026, "01000000", "A", None, "DIRETA", "EXEC", None),
        ("01002", 2026, "01000000", "B", None, "DIRETA", "EXEC", None),
    ], UG)
    rows = agency_dim(ug).collect()
    assert len(rows) == 1
    assert rows[0]["nome"] == "A"              # tie -> smallest value
    assert rows[0]["cnpj"] is None            # all null -> null


def test_agency_head_office_patch_ignores_nulls(spark):
    ug = spark.createDataFrame([
        ("X1", 2026, "HQ", "Unit 1", "111", "DIRETA", "EXEC", dt.datetime(2026, 1, 1)),
        ("X2", 2026, "HQ", "Unit 1", "111", "DIRETA", "EXEC", dt.datetime(2026, 1, 1)),
        ("HQ", 2025, "HQ", "Head Office", None, "INDIRETA", None, dt.datetime(2025, 1, 1)),
        ("HQ", 2026, "HQ", "Head Office New", "999", "INDIRETA", None, dt.datetime(2026, 1, 1)),
    ], UG)
    r = agency_dim(ug).first()
    assert r["nome"] == "Head Office"          # earliest head-office row
    assert r["cnpj"] == "111"                  # its null cnpj does not overwrite the mode
    assert r["tipo_administracao"] == "INDIRETA"
    assert r["esfera"] == "EXEC"


def test_mode_by_group_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, None), (3, "z"), (3, "y")], "k int, v string")
    got = {r["k"]: r["m"] for r in mode_by_group(df, "k", {"v": "m"}).collect()}
    assert got == {1: "b", 2: None, 3: "y"}


def test_creditor_dim(spark):
    con = spark.createDataFrame([("12345678000190", "Empresa X", 1)],
                                "cpf_cnpj_financiador string, descricao_nome_credor string, infringement_status int")
    com = spark.createDataFrame([("12345678900", "Pessoa Y")], "codigocredor string, nomecredor string")
    rows = {r["cpf_cnpj"]: r for r in creditor_dim(con, com).collect()}
    assert len(rows) == 2
    assert rows["12345678000190"]["tipo_pessoa"] == "PJ" and rows["12345678000190"]["historico_infringement"] == 1
    assert rows["12345678900"]["tipo_pessoa"] == "PF" and rows["12345678900"]["historico_infringement"] == 0


def test_creditor_name_from_most_infractions_non_null(spark):
    con = spark.createDataFrame([("1", "Old", 0), ("1", "New", 2), ("1", None, 5), ("1", "Alpha", 2)],
                                "cpf_cnpj_financiador string, descricao_nome_credor string, infringement_status int")
    com = spark.createDataFrame([], "codigocredor string, nomecredor string")
    r = creditor_dim(con, com).first()
    assert r["nome"] == "New" and r["historico_infringement"] == 5


def test_modality_null_type_is_one_value(spark):
    df = spark.createDataFrame([("DISPENSA", None), ("DISPENSA", None), ("PREGAO", "X"), (None, "Y")],
                               "descricao_modalidade string, descricao_tipo string")
    assert modality_dim(df).count() == 2
