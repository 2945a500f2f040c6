"""Registered queries: one per operator (or operator group) of the inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole driver tables; the
matching DuckDB SQL lives in ``spendlake.plans.oracle`` under the same name.
"""
from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendlake.functions import api_date, only_digits, parse_num, parse_ts, to_money
from spendlake.operators import anomaly as IF
from spendlake.operators import quality as Q
from spendlake.operators.aggregates import (describe_exact, forecast_errors, histogram, minmax_scale,
                                            percentile_scalar, period_sum, value_counts)
from spendlake.operators.clean import clean_contracts, enrich_with_units
from spendlake.operators.dims import agency_dim, calendar_dim, creditor_dim, modality_dim, mode_by_group
from spendlake.operators.facts import (commitment_fact, contract_fact, link_commitments_to_contracts,
                                       payment_fact)
from spendlake.operators.forecast import backtest, forecast
from spendlake.operators.forecast_naive import clamp_interval, naive_forecast, next_quarter_rows
from spendlake.operators.insights import (financial_summary, infraction_creditors, render_report,
                                          top_by)
from spendlake.operators.joins import lookup_join, small
from spendlake.operators.merge import (assign_keys, insert_absent, merge_upsert, scd2_merge,
                                       update_by_key)
from spendlake.operators.timeseries import (forecast_features, holdout_last, quarterly_totals,
                                            running_total)
from spendlake.plans import domain, gold
from spendlake.session import scratch_path, shuffles_removed, stored
from spendlake.sources.files import extract_incremental, page_checks, read_pages, read_runs
from spendlake.sources.tables import read_partitioned, write_pages, write_partitioned
from spendlake.streaming.incremental import read_bucketed, run_incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def quarterly_history(spark: SparkSession, d: str, org: DataFrame | None = None) -> DataFrame:
    """Payments per agency and quarter with the agency's key and name (inner star join).

    Only the columns the series needs are carried through the latest-version dedupe."""
    pay = domain.payments(spark, d, cols=["codigoug", "dataemissao", "valor"])
    pay = lookup_join(pay, gold.unit_map(spark, d), on=[("codigoug", "codigo_ug")],
                      take={"codigo_orgao": "codigo_orgao"})
    pay = pay.select("codigo_orgao", F.col("dataemissao").cast("date").alias("data_emissao"),
                     to_money("valor").alias("valor")).filter(F.col("data_emissao").isNotNull())
    hist = quarterly_totals(pay, "codigo_orgao", "data_emissao")
    org = org if org is not None else gold.dim_orgao(spark, d)
    org = org.select("codigo_orgao", "sk_orgao", F.col("nome").alias("nome_orgao"))
    return hist.join(org, "codigo_orgao")


def contracted_running(spark: SparkSession, d: str) -> DataFrame:
    """Contracted value per agency and quarter (signing year) with its running total."""
    con = domain.contracts(spark, d, cols=["cod_orgao", "data_assinatura", "valor_contrato"])
    con = con.select(F.col("cod_orgao").alias("codigo_orgao"),
                     F.col("data_assinatura").cast("date").alias("data_assinatura"),
                     F.year("data_assinatura").alias("ano"),
                     to_money("valor_contrato").alias("valor_contratado")).filter(F.col("ano").isNotNull())
    cq = quarterly_totals(con, "codigo_orgao", "data_assinatura", "valor_contratado",
                          "valor_contratado_trimestre", year_col="ano")
    return running_total(cq, "codigo_orgao", ["ano", "trimestre"], "valor_contratado_trimestre",
                         "valor_contratado_acumulado")


def stored_forecast_features(payments: DataFrame, contracts: DataFrame, agencies: DataFrame) -> DataFrame:
    """The forecast's features from the stored facts and the agency dimension they refer to."""
    hist = quarterly_totals(payments.select("codigo_orgao", "data_emissao", "valor").dropna(subset=["data_emissao"]), "codigo_orgao", "data_emissao")
    hist = hist.join(agencies.select("codigo_orgao", "sk_orgao", F.col("nome").alias("nome_orgao")), "codigo_orgao")
    cq = quarterly_totals(contracts.select("codigo_orgao", "data_assinatura", "ano", "valor_contratado"), "codigo_orgao", "data_assinatura",
                          "valor_contratado", "valor_contratado_trimestre", year_col="ano")
    return forecast_features(hist, running_total(cq, "codigo_orgao", ["ano", "trimestre"], "valor_contratado_trimestre", "valor_contratado_acumulado"), "codigo_orgao")


@query
def m6_forecast_features(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: agency x quarter payments, cumulative contracted value, lags."""
    return forecast_features(quarterly_history(spark, d), contracted_running(spark, d), "codigo_orgao")


# --------------------------------------------------------------------------- #
# Scans and scalar functions
# --------------------------------------------------------------------------- #


@query
def s1_extract_incremental(spark, d):
    """Events in an inclusive [start, end-midnight] window (pushed to the scan)."""
    return extract_incremental(domain.read(spark, d, "events"), "ts", "2024-01-03", "2024-01-10")


@query
def s5_api_date(spark, d):
    o = domain.read(spark, d, "orders")
    return o.select("o_orderkey", api_date(F.col("o_orderdate")).alias("data_api"))


@query
def x1_only_digits(spark, d):
    c = domain.read(spark, d, "customer")
    return c.select("c_custkey", only_digits("c_name").alias("doc"),
                    only_digits("c_mktsegment").alias("seg_digits"),
                    only_digits(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))).alias("null_digits"),
                    only_digits(F.col("c_acctbal").cast("string")).alias("bal_digits"))


@query
def x2_parse_ts(spark, d):
    """Offsets dropped (wall clock kept), month-first US dates, junk to null."""
    e = domain.read(spark, d, "events")
    raw = (F.when(F.col("event_type") == "click",
                  F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("-03:00")))
           .when(F.col("event_type") == "view", F.date_format("ts", "MM/dd/yyyy"))
           .when(F.col("event_type") == "error", F.lit("junk"))
           .otherwise(F.col("ts").cast("string")))
    return e.select("event_id", parse_ts(raw).alias("parsed"))


@query
def x3_parse_num(spark, d):
    o = domain.read(spark, d, "orders")
    raw = (F.when(F.col("o_orderstatus") == "P", F.lit("n/a"))
           .when(F.col("o_orderpriority") == "5-LOW", F.lit("NaN"))
           .otherwise(F.col("o_totalprice").cast("string")))
    return o.select("o_orderkey", parse_num(raw).alias("valor"))


# --------------------------------------------------------------------------- #
# Silver entities, dimensions, facts
# --------------------------------------------------------------------------- #


@query
def w1_dedupe_latest(spark, d):
    """Commitments, latest version per (id, year): null updated_at wins, total tie-break."""
    return domain.commitments(spark, d)


@query
def i4_silver_contracts(spark, d):
    return domain.contracts(spark, d)


@query
def i4_silver_payments(spark, d):
    return domain.payments(spark, d)


@query
def i4_silver_units(spark, d):
    return domain.units(spark, d)


@query
def j1_enrich_units(spark, d):
    return enrich_with_units(domain.commitments(spark, d), domain.units(spark, d))


@query
def w2_unit_agency_map(spark, d):
    return gold.unit_map(spark, d)


@query
def a1_mode_by_group(spark, d):
    c = domain.read(spark, d, "customer").withColumn(
        "seg", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")))
    c = c.withColumn("seg2", F.when(F.col("c_nationkey") != 3, F.col("seg")))
    return mode_by_group(c, "c_nationkey", {"seg": "mode_seg", "seg2": "mode_seg2"})


@query
def a2_agency_dim(spark, d):
    return gold.dim_orgao(spark, d)


@query
def a3_creditor_dim(spark, d):
    return creditor_dim(domain.contracts(spark, d, cols=gold.CREDITOR_CONTRACT_COLS),
                        domain.commitments(spark, d, cols=gold.CREDITOR_EVENT_COLS))


@query
def g3_modality_dim(spark, d):
    return gold.dim_modalidade(spark, d)


@query
def g3_modality_insert(spark, d):
    """Modalities of the previous load, then today's inserted if absent (a null type is one value)."""
    con = domain.contracts(spark, d, cols=["descricao_modalidade", "descricao_tipo"])
    keys = ["descricao_modalidade", "descricao_tipo"]
    old = modality_dim(con.filter(F.col("data_assinatura") < F.lit(FIRST_MODALITIES).cast("timestamp_ntz")))
    return insert_absent(assign_keys(old, "sk_modalidade", keys), modality_dim(con), keys, sk="sk_modalidade", null_safe=True)


@query
def x5_calendar_dim(spark, d):
    return gold.dim_tempo(spark, d)


@query
def p2_contract_fact(spark, d):
    return contract_fact(domain.contracts(spark, d))


@query
def j2_commitment_fact(spark, d):
    return commitment_fact(domain.commitments(spark, d), gold.unit_map(spark, d))


@query
def j3_payment_fact(spark, d):
    return payment_fact(domain.payments(spark, d), gold.unit_map(spark, d))


@query
def j18_commitment_contract_link(spark, d):
    f = commitment_fact(domain.commitments(spark, d, keep=gold.COMMITMENT_COLS), gold.unit_lookup(spark, d))
    c = gold.contract_dates(domain.contracts(spark, d, cols=["num_contrato"]))
    return link_commitments_to_contracts(f, c, key="id_contrato_origem")


@query
def j4_contract_star(spark, d):
    return gold.fato_contrato(spark, d)


@query
def j5_commitment_star(spark, d):
    return gold.fato_empenho(spark, d)


@query
def j6_payment_star(spark, d):
    return gold.fato_ordem_bancaria(spark, d)


@query
def j15_analysis_star(spark, d):
    """Every contract with the attributes of its four dimensions (left star join)."""
    silver = gold.contract_silver(spark, d)
    dims = gold.dimensions(spark, d, silver=silver)
    fc = gold.fato_contrato(spark, d, dims, silver).drop("cpf_cnpj", "descricao_modalidade", "descricao_tipo")
    fc = lookup_join(fc, dims["dim_tempo"], [("sk_tempo_assinatura", "sk_tempo")], {"data": "data", "trimestre": "trimestre", "ano_mes": "ano_mes"}, hint=gold.calendar_hint(dims["dim_tempo"]))
    fc = lookup_join(fc, small(dims["dim_orgao"]), [("sk_orgao", "sk_orgao")], {"nome": "nome_orgao"})
    fc = lookup_join(fc, small(dims["dim_modalidade"]), [("sk_modalidade", "sk_modalidade")], {"descricao_modalidade": "descricao_modalidade", "descricao_tipo": "descricao_tipo"})
    fc = lookup_join(fc, small(dims["dim_credor"]), [("sk_credor", "sk_credor")], {"nome": "nome_credor", "cpf_cnpj": "cpf_cnpj", "tipo_pessoa": "tipo_pessoa"})
    return fc.select("sk_contrato", "ano", "data", "trimestre", "ano_mes", "nome_orgao", "descricao_modalidade", "descricao_tipo", "nome_credor",
                     "cpf_cnpj", "tipo_pessoa", "valor_contratado", "valor_empenhado", "valor_pago", "dias_vigencia")


# --------------------------------------------------------------------------- #
# Aggregations, windows, top-k
# --------------------------------------------------------------------------- #


@query
def a5_quarterly_payments(spark, d):
    return quarterly_history(spark, d)


@query
def a6_contracted_running(spark, d):
    return contracted_running(spark, d)


@query
def a7_financial_summary(spark, d):
    return financial_summary(contract_fact(domain.contracts(spark, d)))


@query
def a8_infraction_creditors(spark, d):
    """Top 10 current creditors with infractions by contracted value. Only the creditor
    dimension is needed: contracts resolve their creditor key by document, as in the star."""
    cred = gold.dim_credor(spark, d)
    con = domain.contracts(spark, d, cols=["cpf_cnpj_financiador", "valor_contrato"])
    fc = con.filter(F.col("data_assinatura").isNotNull()).select(
        F.col("id").alias("id_contrato_origem"), F.col("cpf_cnpj_financiador").alias("cpf_cnpj"),
        to_money("valor_contrato").alias("valor_contratado"))
    fc = lookup_join(fc, cred.filter("versao_atual"), [("cpf_cnpj", "cpf_cnpj")], {"sk_credor": "sk_credor"})
    return infraction_creditors(cred, fc, 10, contract_key="id_contrato_origem")


@query
def a11_heuristic_p95(spark, d):
    """Waiver-like modality AND value >= exact p95: value described per heuristic group."""
    fc = contract_fact(domain.contracts(spark, d))
    p95 = percentile_scalar(fc, "valor_contratado", 0.95)
    flag = (F.col("descricao_modalidade").isin("1-URGENT", "2-HIGH")
            & (F.col("valor_contratado").cast("double") >= p95))
    return describe_exact(fc.withColumn("heuristica", flag), ["valor_contratado", "dias_vigencia"],
                          by=["heuristica"])


@query
def a12_describe(spark, d):
    fc = contract_fact(domain.contracts(spark, d))
    return describe_exact(fc, ["valor_contratado", "valor_empenhado", "valor_pago", "dias_vigencia"])


@query
def a13_describe_by_group(spark, d):
    fc = contract_fact(domain.contracts(spark, d))
    return describe_exact(fc, ["valor_contratado"], by=["descricao_modalidade"])


@query
def a14_value_counts(spark, d):
    return value_counts(contract_fact(domain.contracts(spark, d)), "descricao_modalidade")


@query
def a15_monthly_sum(spark, d):
    """Contracted value by signing month."""
    con = contract_fact(domain.contracts(spark, d))
    return period_sum(con, "data_assinatura", "valor_contratado", "month", "total_contratado")


@query
def a20_histogram(spark, d):
    return histogram(contract_fact(domain.contracts(spark, d)), "valor_contratado", 30)


@query
def w9_minmax_scale(spark, d):
    fc = contract_fact(domain.contracts(spark, d)).select("id_contrato_origem", "ano", "valor_contratado")
    return minmax_scale(fc, "valor_contratado", "valor_norm")


@query
def w8_holdout_split(spark, d):
    f = m6_forecast_features(spark, d)
    return holdout_last(f, "codigo_orgao", min_rows=4, required=["valor_lag1", "valor_mesmo_trimestre_ano_anterior"])


@query
def a17_backtest_naive(spark, d):
    """Hold out each agency's last quarter; naive forecast from the training part; errors."""
    f = w8_holdout_split(spark, d)
    train = f.filter(F.col("fold") == "train")
    test = f.filter(F.col("fold") == "test").select("codigo_orgao", F.col("valor_total").alias("y"))
    fc = naive_forecast(train, "codigo_orgao")
    return forecast_errors(test.join(fc, "codigo_orgao"), "y", "p50", "p10", "p90")


@query
def m7_naive_forecast(spark, d):
    """Next-quarter persistence forecast per agency with clamped interval."""
    f = stored(m6_forecast_features(spark, d), "features")
    fc = clamp_interval(naive_forecast(f, "codigo_orgao"))
    nxt = next_quarter_rows(f, "codigo_orgao", gold.LOAD_DATE).select("codigo_orgao", "trimestre_referencia")
    return fc.join(nxt, "codigo_orgao").select(
        "codigo_orgao", "sk_orgao", "trimestre_referencia", "valor_previsto", "intervalo_inferior",
        "intervalo_superior", F.lit("naive_persistence").alias("modelo"))


@query
def m10_next_quarter_features(spark, d):
    return next_quarter_rows(m6_forecast_features(spark, d), "codigo_orgao", gold.LOAD_DATE)


@query
def o5_top_forecasts(spark, d):
    """Top 15 forecasts of the latest batch, with agency names."""
    batch = m7_naive_forecast(spark, d).withColumn(
        "data_geracao", F.lit("2026-07-23 10:00:00").cast("timestamp_ntz"))
    latest = batch.filter(F.col("data_geracao") == batch.select(F.max("data_geracao")).scalar())
    org = gold.dim_orgao(spark, d).select("sk_orgao", F.col("nome").alias("nome_orgao"))
    j = latest.join(org, "sk_orgao")
    return top_by(j.select("trimestre_referencia", "nome_orgao", "valor_previsto", "intervalo_inferior",
                           "intervalo_superior", "modelo", "sk_orgao"),
                  15, F.desc("valor_previsto"), F.col("sk_orgao"))


@query
def o6_overpaid_head(spark, d):
    """First contracts paid above their value, with the creditor's name."""
    fc = contract_fact(domain.contracts(spark, d))
    over = lookup_join(fc.filter(F.col("valor_pago") > F.col("valor_contratado")), gold.dim_credor(spark, d), [("cpf_cnpj", "cpf_cnpj")], {"nome": "nome_credor"})
    return top_by(over.select("id_contrato_origem", "nome_credor", "valor_contratado", "valor_pago"), 10,
                  F.col("id_contrato_origem"))


# --------------------------------------------------------------------------- #
# Keyed merges (dataflow into Gold)
# --------------------------------------------------------------------------- #


PREVIOUS_CUTOFF = "1999-01-01"      # the "previous load" saw data signed/emitted before this day
PREVIOUS_LOAD = "2026-01-01"
FIRST_MODALITIES = "1995-01-03"     # the modality query's previous load: a few days, so that some are absent


@query
def g1_insert_absent(spark, d):
    """Calendar of contract days, then the days of commitments/payments inserted if absent."""
    con = domain.contracts(spark, d, cols=["data_assinatura"])
    target = assign_keys(calendar_dim((con, "data_assinatura")), "sk_tempo", ["data"])
    source = calendar_dim((con, "data_assinatura"),
                          (domain.commitments(spark, d, cols=["dataemissao"]), "dataemissao"),
                          (domain.payments(spark, d, cols=["dataemissao"]), "dataemissao"))
    return insert_absent(target, source, ["data"], sk="sk_tempo")


@query
def g2_upsert_agency(spark, d):
    """Agency dim of the previous snapshot upserted with the current one (source wins, nulls too)."""
    u = domain.units(spark, d)
    target = assign_keys(agency_dim(u.filter(F.col("ano") < 1998)), "sk_orgao", ["codigo_orgao"])
    source = agency_dim(u)
    return merge_upsert(target, source, ["codigo_orgao"],
                        update_cols=["nome", "cnpj", "tipo_administracao", "esfera"], sk="sk_orgao")


def _creditors_before(con, com, cutoff):
    cutoff = F.lit(cutoff).cast("timestamp_ntz")
    return creditor_dim(con.filter(F.col("data_assinatura") < cutoff), com.filter(F.col("dataemissao") < cutoff))


@query
def g4_scd2_merge(spark, d):
    """SCD2 creditor dimension: previous load, then today's creditors merged in."""
    con = stored(domain.contracts(spark, d, cols=gold.CREDITOR_CONTRACT_COLS).select("data_assinatura", *gold.CREDITOR_CONTRACT_COLS), "contracts")
    cols = ["dataemissao", *gold.CREDITOR_EVENT_COLS]
    com = stored(domain.commitments(spark, d, cols=gold.CREDITOR_EVENT_COLS, keep=cols).select(*cols), "commitments")
    prev = _creditors_before(con, com, PREVIOUS_CUTOFF).select(
        "*", F.lit(PREVIOUS_LOAD).cast("date").alias("data_inicio"), F.lit(None).cast("date").alias("data_fim"),
        F.lit(True).alias("versao_atual"))
    history = assign_keys(prev, "sk_credor", ["cpf_cnpj"])
    return scd2_merge(history, creditor_dim(con, com), "cpf_cnpj", versioned=["nome"], inplace=["historico_infringement"],
                      as_of=gold.LOAD_DATE, sk="sk_credor")


CONTRACT_UPDATE_COLS = ["data_assinatura", "cpf_cnpj", "codigo_orgao", "descricao_modalidade", "descricao_tipo",
                        "valor_contratado", "valor_empenhado", "valor_pago", "status", "tipo_objeto",
                        "flag_emergency", "dias_vigencia", "historico_credor_infringement"]


@query
def g5_merge_upsert(spark, d):
    """Contract fact upsert on (id, year): number and score kept from the target."""
    src = stored(contract_fact(domain.contracts(spark, d)), "source")
    old = src.filter(F.col("data_assinatura") < F.lit(PREVIOUS_CUTOFF).cast("date")) \
        .withColumn("num_contrato", F.concat(F.lit("OLD-"), F.col("num_contrato"))) \
        .withColumn("valor_pago", F.lit(0).cast("decimal(18,2)")) \
        .withColumn("score_anomalia", F.lit(Decimal("0.5")).cast("decimal(5,4)"))
    target = assign_keys(old, "sk_contrato", ["id_contrato_origem", "ano"])
    return merge_upsert(target, src, ["id_contrato_origem", "ano"], update_cols=CONTRACT_UPDATE_COLS,
                        sk="sk_contrato")


def _upsert_lines(spark, d, fact, entity, cols, key, code, sk):
    """Unit fact upsert on (id, year): the source code is kept from the target."""
    src = stored(fact(entity(spark, d, keep=cols), gold.unit_lookup(spark, d)), "source")
    old = src.filter(F.col("data_emissao") < F.lit(PREVIOUS_CUTOFF).cast("date"))
    old = old.withColumns({code: F.concat(F.lit("OLD-"), F.col(code)), "valor": F.lit(0).cast("decimal(18,2)")})
    target = assign_keys(old, sk, [key, "ano"])
    return merge_upsert(target, src, [key, "ano"], update_cols=[c for c in src.columns if c not in (key, "ano", code)], sk=sk)


@query
def g6_upsert_commitments(spark, d):
    return _upsert_lines(spark, d, commitment_fact, domain.commitments, gold.COMMITMENT_COLS, "id_empenho_origem", "codigo_empenho", "sk_empenho")


@query
def g7_upsert_payments(spark, d):
    return _upsert_lines(spark, d, payment_fact, domain.payments, gold.PAYMENT_COLS, "id_ob_origem", "codigo", "sk_ordem_bancaria")


@query
def g12_null_key_loads(spark, d):
    """Two loads of contracts of which those of status P have lost their id: they never come in."""
    fact = stored(contract_fact(domain.contracts(spark, d)).select("id_contrato_origem", "ano", "valor_contratado", "status", "data_assinatura"), "source")
    source = fact.withColumn("id_contrato_origem", F.when(F.col("status") != "P", F.col("id_contrato_origem"))).drop("data_assinatura")
    old = fact.filter(F.col("data_assinatura") < F.lit(PREVIOUS_CUTOFF).cast("date")).drop("data_assinatura").withColumn("valor_contratado", F.lit(0).cast("decimal(18,2)"))
    table = assign_keys(old, "sk_contrato", ["id_contrato_origem", "ano"])
    for _ in range(2):
        table = merge_upsert(table, source, ["id_contrato_origem", "ano"], update_cols=["valor_contratado", "status"], sk="sk_contrato")
    return table


@query
def g8_update_by_key(spark, d):
    """Write anomaly-style scores back onto the contract fact by (key, year)."""
    fc = assign_keys(contract_fact(domain.contracts(spark, d)), "sk_contrato", ["id_contrato_origem", "ano"]) \
        .withColumn("score_anomalia", F.lit(None).cast("decimal(5,4)"))
    scored = minmax_scale(fc.filter(F.col("status") == "F"), "valor_contratado", "s") \
        .select("sk_contrato", "ano", F.col("s").cast("decimal(5,4)").alias("score_anomalia"))
    return update_by_key(fc, scored, ["sk_contrato", "ano"], ["score_anomalia"])


@query
def g9_assign_keys(spark, d):
    c = domain.read(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    return assign_keys(c, "sk_cliente", ["c_name"], start=1000)


# --------------------------------------------------------------------------- #
# Data quality
# --------------------------------------------------------------------------- #


#: The warehouse's constraints. Keys are unique and not null; (table, key) are parents.
CONSTRAINTS = {
    "dim_tempo": {"not_null": ["sk_tempo", "data", "ano", "trimestre", "mes", "dia", "dia_semana", "nome_dia_semana", "nome_mes", "ano_mes"], "unique": [["sk_tempo"], ["data"]]},
    "dim_credor": {"not_null": ["sk_credor", "cpf_cnpj", "nome", "tipo_pessoa", "historico_infringement", "data_inicio", "versao_atual"],
                   "in_set": {"tipo_pessoa": ["PF", "PJ"]}, "unique": [["sk_credor"], (["cpf_cnpj"], "versao_atual")]},
    "dim_orgao": {"not_null": ["sk_orgao", "codigo_orgao", "nome"], "unique": [["sk_orgao"], ["codigo_orgao"]]},
    "dim_modalidade": {"not_null": ["sk_modalidade", "descricao_modalidade"], "unique": [["sk_modalidade"], ["descricao_modalidade", "descricao_tipo"]]},
    "fato_contrato": {"not_null": ["sk_contrato", "id_contrato_origem", "valor_contratado", "valor_empenhado", "valor_pago", "flag_emergency", "historico_credor_infringement", "ano",
                                   "sk_tempo_assinatura", "sk_modalidade"],
                      "unique": [["sk_contrato", "ano"], ["id_contrato_origem", "ano"], ["id_contrato_origem"]], "unresolved": ["sk_credor"], "min_rows": 1,
                      "foreign": {"sk_tempo_assinatura": ("dim_tempo", "sk_tempo"), "sk_credor": ("dim_credor", "sk_credor"), "sk_orgao": ("dim_orgao", "sk_orgao"),
                                  "sk_modalidade": ("dim_modalidade", "sk_modalidade")}},
    "fato_empenho": {"not_null": ["sk_empenho", "id_empenho_origem", "valor", "ano"], "unique": [["sk_empenho"], ["id_empenho_origem", "ano"]],
                     "foreign": {"sk_tempo": ("dim_tempo", "sk_tempo"), "sk_orgao": ("dim_orgao", "sk_orgao"), "sk_credor": ("dim_credor", "sk_credor")}},
    "fato_ordem_bancaria": {"not_null": ["sk_ordem_bancaria", "id_ob_origem", "valor", "ano"], "unique": [["sk_ordem_bancaria"], ["id_ob_origem", "ano"]], "unresolved": ["sk_orgao"],
                            "foreign": {"sk_tempo": ("dim_tempo", "sk_tempo"), "sk_orgao": ("dim_orgao", "sk_orgao"), "sk_credor": ("dim_credor", "sk_credor")}},
    "previsao_pagamento_trimestral": {"not_null": ["sk_previsao", "trimestre_referencia", "valor_previsto", "modelo", "data_geracao"], "unique": [["sk_previsao"]],
                                      "foreign": {"sk_orgao": ("dim_orgao", "sk_orgao")}},
    "relatorio_insights": {"not_null": ["sk_relatorio", "titulo", "conteudo_markdown", "data_geracao"], "unique": [["sk_relatorio"]]},
}


def constraint_report(tables: dict[str, DataFrame], instead: dict[str, DataFrame] | None = None) -> DataFrame:
    """A row per constraint of the warehouse, one scan a table; ``instead``: tables checked in the place
    of those that the others refer to."""
    out = []
    for name, spec in CONSTRAINTS.items():
        spec = dict(spec)
        spec["unique"] = [(u[0], F.expr(u[1])) if isinstance(u, tuple) else u for u in spec["unique"]]
        spec["foreign"] = {c: (tables[parent], pk) for c, (parent, pk) in spec.get("foreign", {}).items()}
        out.append(Q.check_table((instead or {}).get(name, tables[name]), name, **spec))
    return Q.quality_report(out)


ENTITIES = {"contratos": (domain.contracts, "data_assinatura"), "empenhos": (domain.commitments, "dataemissao"),
            "ordem_bancaria_orcamentaria": (domain.payments, "dataemissao"), "unidade_gestora": (domain.units, None)}


def stored_silver(spark, d, base: str) -> dict[str, DataFrame]:
    """The Silver entities, built once and written under ``base``."""
    silver = {}
    for name, (entity, _) in ENTITIES.items():
        df = entity(spark, d)
        with shuffles_removed(spark):
            df.write.option("compression", "zstd").parquet(f"{base}/silver/{name}")
        silver[name] = spark.read.schema(df.schema).parquet(f"{base}/silver/{name}")
    return silver


@query
def q5_quality_report(spark, d):
    """Every constraint of the warehouse over a Gold load as (check, table, n_bad, ok) rows; creditors
    are those of two loads, with closed and current versions."""
    from spendlake.plans.load import load_gold
    base = scratch_path(spark, "quality")
    silver = stored_silver(spark, d, base)
    tables = load_gold(spark, silver, f"{base}/gold", gold.LOAD_DATE)
    con, emp = silver["contratos"], silver["empenhos"]
    before = F.lit(PREVIOUS_CUTOFF).cast("timestamp_ntz")
    past = creditor_dim(con.filter(F.col("data_assinatura") < before), emp.filter(F.col("dataemissao") < before)).select(
        "*", F.lit(PREVIOUS_LOAD).cast("date").alias("data_inicio"), F.lit(None).cast("date").alias("data_fim"), F.lit(True).alias("versao_atual"))
    history = scd2_merge(assign_keys(past, "sk_credor", ["cpf_cnpj"]), creditor_dim(con, emp), "cpf_cnpj", versioned=["nome"], inplace=["historico_infringement"],
                         as_of=gold.LOAD_DATE, sk="sk_credor")
    stamp = F.lit(str(gold.LOAD_DATE)).cast("timestamp_ntz").alias("data_geracao")
    features = stored_forecast_features(tables["fato_ordem_bancaria"], tables["fato_contrato"], tables["dim_orgao"]).checkpoint(eager=True)
    naive = clamp_interval(naive_forecast(features, "codigo_orgao")).join(
        next_quarter_rows(features, "codigo_orgao", gold.LOAD_DATE).select("codigo_orgao", "trimestre_referencia"), "codigo_orgao")
    naive = naive.select("codigo_orgao", "sk_orgao", "trimestre_referencia", "valor_previsto", "intervalo_inferior", "intervalo_superior", F.lit("naive_persistence").alias("modelo"), stamp)
    report = build_report(tables, tables["fato_contrato"], naive, str(gold.LOAD_DATE)).select("*", stamp)
    made = {"previsao_pagamento_trimestral": assign_keys(naive, "sk_previsao", ["codigo_orgao"]), "relatorio_insights": assign_keys(report, "sk_relatorio", ["titulo"])}
    return constraint_report(tables | made, {"dim_credor": history})


# --------------------------------------------------------------------------- #
# Anomaly detection (Isolation Forest)
# --------------------------------------------------------------------------- #

# The anomaly model's inputs.
IF_NUMERIC = ["valor_contratado", "dias_vigencia", "historico_credor_infringement"]
IF_CATEGORICAL = ["descricao_modalidade", "tipo_objeto"]
IF_BOOLEAN = ["flag_emergency"]


def contract_features(fc: DataFrame, modal: DataFrame) -> DataFrame:
    """Model inputs per contract: fact LEFT JOIN modality (for its description)."""
    base = fc.select("sk_contrato", "ano", "valor_contratado", "dias_vigencia", "historico_credor_infringement",
                     "flag_emergency", "tipo_objeto", "sk_modalidade")
    j = lookup_join(base, small(modal), [("sk_modalidade", "sk_modalidade")],
                    {"descricao_modalidade": "descricao_modalidade"})
    return IF.features(j.drop("sk_modalidade"), IF_NUMERIC, IF_CATEGORICAL, IF_BOOLEAN)


def anomaly_run(spark, d, trees: int = 200):
    silver = gold.contract_silver(spark, d)
    dims = gold.dimensions(spark, d, silver=silver)
    fc = gold.fato_contrato(spark, d, dims, silver)
    feats = contract_features(fc, dims["dim_modalidade"])
    nodes = IF.fit(feats, "sk_contrato", IF_NUMERIC + IF_BOOLEAN, IF_CATEGORICAL, trees=trees, seed=42)
    scores = IF.score_normalised(feats, nodes, "sk_contrato", IF_NUMERIC + IF_BOOLEAN, IF_CATEGORICAL)
    scores = scores.join(feats.select("sk_contrato", "ano"), "sk_contrato") \
        .select("sk_contrato", "ano", F.col("score_anomalia").cast("decimal(5,4)").alias("score_anomalia"))
    fc_scored = update_by_key(fc, scores, ["sk_contrato", "ano"], ["score_anomalia"])
    return dims, fc_scored, feats


@query
def m5_anomaly_scores(spark, d):
    """Isolation Forest (200 trees, psi 256) scores written back onto the contract fact."""
    _, fc, _ = anomaly_run(spark, d)
    return fc.select("sk_contrato", "ano", "id_contrato_origem", "score_anomalia")


@query
def o2_top_anomalies(spark, d):
    """Top 10 contracts by anomaly score (ties: lower key first)."""
    _, fc, _ = anomaly_run(spark, d)
    return top_by(fc.select("sk_contrato", "valor_contratado", "descricao_modalidade", "score_anomalia"),
                  10, F.desc("score_anomalia"), F.col("sk_contrato"))


@query
def o3_top_anomalies_named(spark, d):
    """Top 10 scored contracts with modality, creditor and agency names (left star join)."""
    dims, fc, _ = anomaly_run(spark, d)
    return named_top(dims, fc)


def named_top(dims: dict, fc: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` contracts with the highest scores and their names. The names come by left joins on the keys of
    dimensions, which neither drop nor double a contract: they are looked up for the ``n`` rows alone."""
    order = [F.desc("score_anomalia"), F.col("sk_contrato")]
    cols = ["sk_contrato", "num_contrato", "valor_contratado", "score_anomalia"]
    j = top_by(fc.filter(F.col("score_anomalia").isNotNull()).select(*cols, "sk_modalidade", "sk_credor", "sk_orgao"), n, *order)
    j = lookup_join(stored(j, "top"), dims["dim_modalidade"], [("sk_modalidade", "sk_modalidade")], {"descricao_modalidade": "descricao_modalidade"})
    j = lookup_join(j, dims["dim_credor"], [("sk_credor", "sk_credor")], {"nome": "nome_credor"})
    j = lookup_join(j, dims["dim_orgao"], [("sk_orgao", "sk_orgao")], {"nome": "nome_orgao"})
    return top_by(j.select(*cols, "descricao_modalidade", "nome_credor", "nome_orgao"), n, *order)


@query
def m14_heuristic_scores(spark, d):
    """Score described inside / outside the heuristic (waiver-like modality AND value >= p95)."""
    _, fc, feats = anomaly_run(spark, d)
    fc = stored(fc.select("descricao_modalidade", "valor_contratado", "score_anomalia"), "scored")
    p95 = percentile_scalar(fc, "valor_contratado", 0.95)
    flag = (F.col("descricao_modalidade").isin("1-URGENT", "2-HIGH")
            & (F.col("valor_contratado").cast("double") >= p95))
    return describe_exact(fc.withColumn("heuristica", flag), ["score_anomalia"], by=["heuristica"])


@query
def a20_score_histogram(spark, d):
    _, fc, _ = anomaly_run(spark, d)
    return histogram(fc, "score_anomalia", 30)


# --------------------------------------------------------------------------- #
# Payment forecast (quantile boosting) and backtest
# --------------------------------------------------------------------------- #


@query
def m12_forecast(spark, d):
    """Next-quarter payment forecast per agency: quantile boosting (p10/p50/p90) where the
    agency has >= 5 quarters, naive persistence elsewhere; clamped interval."""
    return forecast(m6_forecast_features(spark, d), "codigo_orgao", gold.LOAD_DATE)


@query
def m13_backtest(spark, d):
    """Hold-out of each agency's last quarter: MAE, MAPE and p10-p90 coverage."""
    return backtest(m6_forecast_features(spark, d), "codigo_orgao")


# --------------------------------------------------------------------------- #
# Sources, sinks, incremental stream (round trips through the shared checkpoint folder)
# --------------------------------------------------------------------------- #

PAGE_SIZE = 500


@query
def s7_page_roundtrip(spark, d):
    """Raw contracts -> JSON page sink -> page reader (explode ``data``) -> Silver cleaning."""
    raw = domain.raw_contracts(spark, d)
    base = scratch_path(spark, "pages")
    write_pages(raw, base, "r1", ["id"], page_size=PAGE_SIZE)
    recs = read_pages(spark, base, raw.schema, multiline=False)
    return clean_contracts(recs.drop("run_id", "page_file", "page"))


@query
def q3_page_checks(spark, d):
    raw = domain.raw_contracts(spark, d)
    base = scratch_path(spark, "pages")
    write_pages(raw, base, "r1", ["id"], page_size=PAGE_SIZE)
    return page_checks(spark, base, multiline=False)


@query
def k4_partitioned_roundtrip(spark, d):
    """Silver payments written by year/month of emission (null dates dropped) and read back. An earlier
    write had them two years later: none of its months stays."""
    path = scratch_path(spark, "silver_payments")
    pay = domain.payments(spark, d)
    write_partitioned(pay.withColumn("dataemissao", F.col("dataemissao") + F.expr("INTERVAL 2 YEARS")), path, "dataemissao")
    write_partitioned(pay, path, "dataemissao", whole=True)
    return read_partitioned(spark, path)


def _event_runs(spark, d, base):
    ev = domain.read(spark, d, "events").withColumn("run_id", F.date_format("ts", "yyyy-MM-dd"))
    (ev.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("run_id").parquet(base))
    return ev


@query
def s6_run_history(spark, d):
    """Every Bronze run folder of a table, read back together with its run id."""
    base = scratch_path(spark, "bronze_events")
    ev = _event_runs(spark, d, base)
    schema = ev.drop("run_id").schema.add("run_id", "string")
    return read_runs(spark, base, schema)


@query
def i1_incremental_stream(spark, d):
    """Bronze runs consumed by an availableNow stream (10 run files per batch), each batch
    merged into bucketed Silver keeping the latest event per (user, type)."""
    base = scratch_path(spark, "bronze_events")
    ev = _event_runs(spark, d, base)
    schema = ev.drop("run_id").schema.add("run_id", "string")
    silver = scratch_path(spark, "silver_events")
    run_incremental(spark, base, schema, silver, scratch_path(spark, "stream_ckpt"),
                    keys=["user_id", "event_type"], order="ts", tie=["event_id"],
                    max_files_per_trigger=10, buckets=16)
    return read_bucketed(spark, silver)


# --------------------------------------------------------------------------- #
# Report and end-to-end run
# --------------------------------------------------------------------------- #


# Section headings and "nothing to show" lines of the deterministic report.
REPORT_SECTIONS = [
    ("Contratos com Padrões Anômalos", "Nenhum contrato pontuado."),
    ("Credores com Histórico de Infrações", "Nenhum credor com histórico de infração encontrado."),
    ("Previsão de Pagamentos do Próximo Trimestre", "Sem previsões disponíveis."),
]


def _ranked(df: DataFrame, *order) -> DataFrame:
    """Rank rows of an already-limited top-k frame (k <= 15 rows, one partition is enough)."""
    return df.withColumn("__rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))


def build_report(dims: dict, fc: DataFrame, forecasts: DataFrame, as_of: str) -> DataFrame:
    """The report over scored contracts, the dimensions they refer to, and forecasts (stored frames: the sections read
    them several times; a section reads its few rows twice, so that these are stored too)."""
    summary = stored(financial_summary(fc), "summary")
    anom = stored(named_top(dims, fc), "anomalies")
    infr = stored(infraction_creditors(dims["dim_credor"], fc, 10), "infractions")
    latest = forecasts.filter(F.col("data_geracao") == forecasts.select(F.max("data_geracao")).scalar())
    org = dims["dim_orgao"].select("sk_orgao", F.col("nome").alias("nome_orgao"))
    fcs = stored(top_by(latest.join(org, "sk_orgao").select(
        "trimestre_referencia", "nome_orgao", "valor_previsto", "intervalo_inferior", "intervalo_superior",
        "modelo", "sk_orgao"), 15, F.desc("valor_previsto"), F.col("sk_orgao")), "forecasts")
    sections = [
        (REPORT_SECTIONS[0][0], _ranked(anom, F.desc("score_anomalia"), "sk_contrato"),
         ["sk_contrato", "num_contrato", "valor_contratado", "score_anomalia", "descricao_modalidade",
          "nome_credor", "nome_orgao"], REPORT_SECTIONS[0][1]),
        (REPORT_SECTIONS[1][0], _ranked(infr, F.desc("valor_total"), "cpf_cnpj"),
         ["nome", "cpf_cnpj", "historico_infringement", "qtd_contratos", "valor_total"], REPORT_SECTIONS[1][1]),
        (REPORT_SECTIONS[2][0], _ranked(fcs, F.desc("valor_previsto"), "sk_orgao"),
         ["trimestre_referencia", "nome_orgao", "valor_previsto", "intervalo_inferior", "intervalo_superior",
          "modelo"], REPORT_SECTIONS[2][1]),
    ]
    return render_report(summary, sections, title=f"Relatório de Insights ({as_of})")


@query
def r2_report(spark, d):
    """Deterministic Markdown report over scored contracts, creditors and forecasts (one row)."""
    dims, fc, _ = anomaly_run(spark, d)
    fc = stored(fc.select("sk_contrato", "num_contrato", "valor_contratado", "valor_empenhado", "valor_pago", "score_anomalia", "sk_modalidade", "sk_credor", "sk_orgao"), "scored")
    forecasts = stored(m7_naive_forecast(spark, d).withColumn("data_geracao", F.lit(str(gold.LOAD_DATE)).cast("timestamp_ntz")), "batch")
    return build_report(dims, fc, forecasts, str(gold.LOAD_DATE))


@query
def i3_pipeline_silver_gold(spark, d):
    """Silver and Gold stages written as tables; the run log (rows per table) is the result."""
    from spendlake.plans.pipeline import run_pipeline
    return run_pipeline(spark, d, scratch_path(spark, "pipeline"), stages=("silver", "gold"))


@query
def i3_two_loads(spark, d):
    """What Gold holds after two loads: data before the cutoff, then all of it. Keys given out by
    the first load stay, renamed creditors have a closed and a current version."""
    from spendlake.plans.load import load_gold
    base = scratch_path(spark, "two-loads")
    silver = stored_silver(spark, d, base)
    before = {n: df.filter(F.col(ENTITIES[n][1]) < F.lit(PREVIOUS_CUTOFF).cast("timestamp_ntz")) if ENTITIES[n][1] else df.filter("ano < 1998")
              for n, df in silver.items()}
    load_gold(spark, before, f"{base}/gold", PREVIOUS_LOAD)
    tables = load_gold(spark, silver, f"{base}/gold", gold.LOAD_DATE)
    out = None
    for name, (sk, cols) in GOLD_CONTENT.items():
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in cols])
        part = tables[name].select(F.lit(name).alias("table_name"), F.col(sk).alias("sk"), text.alias("content"))
        out = part if out is None else out.unionByName(part)
    return out


#: What the two-load query shows of each table: its key and the columns that make up its content.
GOLD_CONTENT = {
    "dim_tempo": ("sk_tempo", ["data", "ano_mes"]),
    "dim_orgao": ("sk_orgao", ["codigo_orgao", "nome", "cnpj", "tipo_administracao", "esfera"]),
    "dim_modalidade": ("sk_modalidade", ["descricao_modalidade", "descricao_tipo"]),
    "dim_credor": ("sk_credor", ["cpf_cnpj", "nome", "historico_infringement", "data_inicio", "data_fim", "versao_atual"]),
    "fato_contrato": ("sk_contrato", ["id_contrato_origem", "ano", "num_contrato", "sk_tempo_assinatura", "sk_orgao", "sk_modalidade", "sk_credor", "valor_contratado", "valor_pago"]),
    "fato_empenho": ("sk_empenho", ["id_empenho_origem", "ano", "codigo_empenho", "sk_tempo", "sk_orgao", "sk_credor", "sk_contrato", "valor"]),
    "fato_ordem_bancaria": ("sk_ordem_bancaria", ["id_ob_origem", "ano", "codigo", "sk_tempo", "sk_orgao", "sk_credor", "valor"]),
}


@query
def s2_extract_snapshot(spark, d):
    """Full snapshot read of a reference table with an explicit schema."""
    from spendlake.sources.files import extract_snapshot
    return extract_snapshot(spark, f"{d}/supplier.parquet",
                            schema="s_suppkey long, s_name string, s_nationkey int, s_acctbal double")


@query
def x16_json_text(spark, d):
    """JSON held as text parsed into columns (``from_json``)."""
    ev = domain.read(spark, d, "events")
    parsed = ev.select("event_id", "event_type", F.from_json("props", "k long").alias("p"))
    return parsed.select("event_id", "event_type", F.col("p.k").alias("k"))


@query
def s3_extraction_runs(spark, d):
    """Two incremental runs (orders by order date, line items by ship date) plus snapshots,
    landed as Bronze run folders; the mark advances after each validated run, so the second
    window starts where the first ended (boundary-day rows are read by both)."""
    from spendlake.sources.extract import TableSpec, incremental_run
    specs = [
        TableSpec("orders", lambda: domain.read(spark, d, "orders"), "o_orderdate", ["o_orderkey", "o_orderdate"]),
        TableSpec("lineitem", lambda: domain.read(spark, d, "lineitem"), "l_shipdate", ["l_orderkey", "l_linenumber"]),
        TableSpec("supplier", lambda: domain.read(spark, d, "supplier"), None, ["s_suppkey"], 1),
        TableSpec("nation", lambda: domain.read(spark, d, "nation"), None, ["n_nationkey"], 1),
    ]
    base = scratch_path(spark, "extraction")
    r1 = incremental_run(spark, specs, "1997-12-31", "run1", f"{base}/bronze", f"{base}/mark", "1995-01-01")
    r2 = incremental_run(spark, specs, "2001-12-31", "run2", f"{base}/bronze", f"{base}/mark", "1995-01-01")
    return r1.unionByName(r2)
