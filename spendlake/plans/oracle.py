"""DuckDB oracle SQL for the registered queries (independent formulation of each result).

Builders are written with plain SQL windows and aggregates, never by calling the library.
"""
from __future__ import annotations

from spendlake.plans.domain import (SQL_COMMITMENTS, SQL_CONTRACTS, SQL_PAYMENTS, SQL_UNITS,
                                    with_ctes)

SQL_UNIT_MAP = """
unit_map AS (
  SELECT codigo AS codigo_ug, codigoorgao AS codigo_orgao FROM (
    SELECT *, row_number() OVER (PARTITION BY codigo ORDER BY ano DESC, codigoorgao DESC) AS rn
    FROM units) WHERE rn = 1)"""


def _mode_cte(attr: str, alias: str, src: str, prefix: str) -> str:
    return f"""
{prefix}mode_{alias} AS (
  SELECT codigoorgao, {attr} AS {alias} FROM (
    SELECT codigoorgao, {attr}, row_number() OVER (PARTITION BY codigoorgao ORDER BY count(*) DESC, {attr}) AS rn
    FROM {src} WHERE codigoorgao IS NOT NULL AND {attr} IS NOT NULL GROUP BY codigoorgao, {attr}) WHERE rn = 1)"""


AGENCY_ATTRS = [("titulo", "nome"), ("cnpj", "cnpj"), ("tipoadministracao", "tipo_administracao"),
                ("nomepoder", "esfera")]


def agency_sql(src: str = "units", name: str = "agency", prefix: str = "") -> str:
    """Agency dimension CTEs over the unit table ``src`` (mode per attribute, head-office patch)."""
    modes = ",".join(_mode_cte(a, al, src, prefix).strip("\n") for a, al in AGENCY_ATTRS)
    return modes + f""",
{prefix}head_office AS (
  SELECT * FROM (
    SELECT codigoorgao, titulo, cnpj, tipoadministracao, nomepoder,
           row_number() OVER (PARTITION BY codigoorgao ORDER BY updated_at NULLS FIRST, ano NULLS FIRST) AS rn
    FROM {src} WHERE codigoorgao IS NOT NULL AND codigo = codigoorgao) WHERE rn = 1),
{name} AS (
  SELECT g.codigoorgao AS codigo_orgao,
         coalesce(h.titulo, m1.nome) AS nome,
         coalesce(h.cnpj, m2.cnpj) AS cnpj,
         coalesce(h.tipoadministracao, m3.tipo_administracao) AS tipo_administracao,
         coalesce(h.nomepoder, m4.esfera) AS esfera,
         row_number() OVER (ORDER BY g.codigoorgao) AS sk_orgao
  FROM (SELECT DISTINCT codigoorgao FROM {src} WHERE codigoorgao IS NOT NULL) g
  LEFT JOIN {prefix}mode_nome m1 USING (codigoorgao)
  LEFT JOIN {prefix}mode_cnpj m2 USING (codigoorgao)
  LEFT JOIN {prefix}mode_tipo_administracao m3 USING (codigoorgao)
  LEFT JOIN {prefix}mode_esfera m4 USING (codigoorgao)
  LEFT JOIN {prefix}head_office h USING (codigoorgao))"""


SQL_AGENCY = agency_sql()

SQL_PAY_FACT = """
pay_fact AS (
  SELECT p.id AS id_ob_origem, p.codigo, CAST(p.dataemissao AS DATE) AS data_emissao, m.codigo_orgao,
         p.codigocredor AS cpf_cnpj, p.tipoob AS tipo_ob, CAST(p.valor AS DECIMAL(18,2)) AS valor, p.ano
  FROM payments p LEFT JOIN unit_map m ON p.codigoug = m.codigo_ug)"""

SQL_COMMIT_FACT = """
commit_fact AS (
  SELECT e.id AS id_empenho_origem, e.codigo AS codigo_empenho, CAST(e.dataemissao AS DATE) AS data_emissao,
         m.codigo_orgao, e.codigocredor AS cpf_cnpj, e.codcontrato, e.modalidade,
         CAST(e.valor AS DECIMAL(18,2)) AS valor, e.ano
  FROM commitments e LEFT JOIN unit_map m ON e.codigoug = m.codigo_ug)"""

SQL_CONTRACT_FACT = """
contract_fact AS (
  SELECT id AS id_contrato_origem, num_contrato, CAST(data_assinatura AS DATE) AS data_assinatura,
         cpf_cnpj_financiador AS cpf_cnpj, cod_orgao AS codigo_orgao, descricao_modalidade, descricao_tipo,
         CAST(valor_contrato AS DECIMAL(18,2)) AS valor_contratado,
         CAST(calculated_valor_empenhado AS DECIMAL(18,2)) AS valor_empenhado,
         CAST(calculated_valor_pago AS DECIMAL(18,2)) AS valor_pago,
         descricao_situacao AS status, tipo_objeto, coalesce(emergency, false) AS flag_emergency,
         CAST(floor(date_diff('microsecond', data_inicio, data_termino) / 86400000000.0) AS INTEGER) AS dias_vigencia,
         coalesce(infringement_status, 0) AS historico_credor_infringement,
         CAST(year(data_assinatura) AS INTEGER) AS ano
  FROM contracts)"""

SQL_HISTORY = """
hist AS (
  SELECT codigo_orgao, CAST(year(data_emissao) AS INTEGER) AS ano, CAST(quarter(data_emissao) AS INTEGER) AS trimestre,
         CAST(SUM(valor) AS DECIMAL(18,2)) AS valor_total
  FROM pay_fact GROUP BY ALL),
hist_named AS (
  SELECT h.*, a.sk_orgao, a.nome AS nome_orgao FROM hist h JOIN agency a USING (codigo_orgao)),
cq AS (
  SELECT codigo_orgao, ano, CAST(quarter(data_assinatura) AS INTEGER) AS trimestre,
         CAST(SUM(valor_contratado) AS DECIMAL(18,2)) AS valor_contratado_trimestre
  FROM contract_fact GROUP BY ALL),
cq_run AS (
  SELECT *, CAST(SUM(valor_contratado_trimestre) OVER (PARTITION BY codigo_orgao ORDER BY ano, trimestre
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(18,2)) AS valor_contratado_acumulado
  FROM cq),
features AS (
  SELECT h.codigo_orgao, h.ano, h.trimestre, h.valor_total, h.sk_orgao, h.nome_orgao,
         coalesce(c.valor_contratado_acumulado, CAST(0 AS DECIMAL(18,2))) AS valor_contratado_acumulado,
         h.ano * 4 + h.trimestre AS sequencial_trimestre,
         CAST(h.ano % 2 = 0 AS INTEGER) AS ano_eleitoral,
         lag(h.valor_total, 1) OVER (PARTITION BY h.codigo_orgao ORDER BY h.ano, h.trimestre) AS valor_lag1,
         lag(h.valor_total, 1) OVER (PARTITION BY h.codigo_orgao, h.trimestre ORDER BY h.ano) AS valor_mesmo_trimestre_ano_anterior
  FROM hist_named h LEFT JOIN cq_run c USING (codigo_orgao, ano, trimestre))"""

BASE_FEATURES = [SQL_CONTRACTS, SQL_PAYMENTS, SQL_UNITS, SQL_UNIT_MAP, SQL_AGENCY, SQL_PAY_FACT,
                 SQL_CONTRACT_FACT, SQL_HISTORY]


def sql(*ctes: str, body: str) -> str:
    return with_ctes(*ctes) + body


ORACLE: dict[str, str] = {}


def register(name: str, text: str) -> None:
    ORACLE[name] = text


register("m6_forecast_features", sql(*BASE_FEATURES, body="SELECT * FROM features"))

DAY_LIST = "['segunda', 'terça', 'quarta', 'quinta', 'sexta', 'sábado', 'domingo']"
MONTH_LIST = ("['janeiro', 'fevereiro', 'março', 'abril', 'maio', 'junho', 'julho', 'agosto', "
              "'setembro', 'outubro', 'novembro', 'dezembro']")

SQL_CALENDAR = f"""
days AS (
  SELECT DISTINCT CAST(d AS DATE) AS data FROM (
    SELECT data_assinatura AS d FROM contracts UNION ALL SELECT dataemissao FROM commitments
    UNION ALL SELECT dataemissao FROM payments) WHERE d IS NOT NULL),
cal AS (
  SELECT data, CAST(year(data) AS INTEGER) AS ano, CAST(quarter(data) AS INTEGER) AS trimestre,
         CAST(month(data) AS INTEGER) AS mes, CAST(day(data) AS INTEGER) AS dia,
         CAST(isodow(data) - 1 AS INTEGER) AS dia_semana,
         ({DAY_LIST})[isodow(data)] AS nome_dia_semana,
         ({MONTH_LIST})[month(data)] AS nome_mes,
         strftime(data, '%Y-%m') AS ano_mes,
         row_number() OVER (ORDER BY data) AS sk_tempo
  FROM days)"""

SQL_MODALITY = """
modal AS (
  SELECT descricao_modalidade, descricao_tipo,
         row_number() OVER (ORDER BY descricao_modalidade NULLS FIRST, descricao_tipo NULLS FIRST) AS sk_modalidade
  FROM (SELECT DISTINCT descricao_modalidade, descricao_tipo FROM contracts WHERE descricao_modalidade IS NOT NULL))"""

SQL_CREDITOR = """
cred_u AS (
  SELECT cpf_cnpj_financiador AS cpf_cnpj, descricao_nome_credor AS nome, coalesce(infringement_status, 0) AS h FROM contracts
  UNION ALL SELECT codigocredor, nomecredor, 0 FROM commitments),
creditor AS (
  SELECT cpf_cnpj, arg_max(nome, row(h, nome)) FILTER (WHERE nome IS NOT NULL) AS nome,
         CASE WHEN length(cpf_cnpj) > 11 THEN 'PJ' ELSE 'PF' END AS tipo_pessoa,
         CAST(max(h) AS INTEGER) AS historico_infringement
  FROM cred_u WHERE cpf_cnpj IS NOT NULL GROUP BY cpf_cnpj),
creditor_cur AS (
  SELECT *, DATE '2026-07-23' AS data_inicio, CAST(NULL AS DATE) AS data_fim, true AS versao_atual,
         row_number() OVER (ORDER BY cpf_cnpj) AS sk_credor FROM creditor)"""

SQL_CONTRACT_STAR = """
contract_star AS (
  SELECT f.*, t.sk_tempo AS sk_tempo_assinatura, a.sk_orgao, m.sk_modalidade, c.sk_credor,
         CAST(NULL AS DECIMAL(5,4)) AS score_anomalia,
         row_number() OVER (ORDER BY f.id_contrato_origem, f.ano) AS sk_contrato
  FROM contract_fact f
  LEFT JOIN cal t ON t.data = f.data_assinatura
  LEFT JOIN agency a ON a.codigo_orgao = f.codigo_orgao
  LEFT JOIN modal m ON m.descricao_modalidade = f.descricao_modalidade
                   AND m.descricao_tipo IS NOT DISTINCT FROM f.descricao_tipo
  LEFT JOIN creditor_cur c ON c.cpf_cnpj = f.cpf_cnpj)"""

GOLD = [SQL_CONTRACTS, SQL_COMMITMENTS, SQL_PAYMENTS, SQL_UNITS, SQL_UNIT_MAP, SQL_AGENCY,
        SQL_CALENDAR, SQL_MODALITY, SQL_CREDITOR, SQL_CONTRACT_FACT, SQL_COMMIT_FACT, SQL_PAY_FACT]


def _describe(src: str, cols: list[str], by: str | None = None) -> str:
    parts = []
    for c in cols:
        g = f"{by}, " if by else ""
        parts.append(f"""SELECT {g}count(x) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std,
       min(x) AS min, round(quantile_cont(x, 0.25), 6) AS p25, round(quantile_cont(x, 0.5), 6) AS p50,
       round(quantile_cont(x, 0.75), 6) AS p75, max(x) AS max, '{c}' AS "column"
FROM (SELECT {g}CAST({c} AS DOUBLE) AS x FROM {src}) {"GROUP BY " + by if by else ""}""")
    return "\nUNION ALL\n".join(parts)


register("s1_extract_incremental",
         "SELECT * FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-10'")
register("s5_api_date", "SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS data_api FROM orders")
register("x1_only_digits", """
SELECT c_custkey,
       nullif(regexp_replace(c_name, '[^0-9]', '', 'g'), '') AS doc,
       nullif(regexp_replace(c_mktsegment, '[^0-9]', '', 'g'), '') AS seg_digits,
       nullif(regexp_replace(nullif(c_mktsegment, 'BUILDING'), '[^0-9]', '', 'g'), '') AS null_digits,
       nullif(regexp_replace(CAST(c_acctbal AS VARCHAR), '[^0-9]', '', 'g'), '') AS bal_digits
FROM customer""")
register("x2_parse_ts", """
SELECT event_id, CASE event_type WHEN 'click' THEN date_trunc('millisecond', ts)
                                 WHEN 'view' THEN date_trunc('day', ts)
                                 WHEN 'error' THEN NULL ELSE ts END AS parsed
FROM events""")
register("x3_parse_num", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 0.0 WHEN o_orderpriority = '5-LOW' THEN 0.0
                        ELSE o_totalprice END AS valor
FROM orders""")
register("w1_dedupe_latest", sql(SQL_COMMITMENTS, body="SELECT * FROM commitments"))
register("i4_silver_contracts", sql(SQL_CONTRACTS, body="SELECT * FROM contracts"))
register("i4_silver_payments", sql(SQL_PAYMENTS, body="SELECT * FROM payments"))
register("i4_silver_units", sql(SQL_UNITS, body="SELECT * FROM units"))
register("j1_enrich_units", sql(SQL_COMMITMENTS, SQL_UNITS, body="""
SELECT c.*, u.titulo AS nome_ug, u.cnpj AS cnpj_ug
FROM commitments c LEFT JOIN units u ON c.codigoug = u.codigo AND c.ano = u.ano"""))
register("w2_unit_agency_map", sql(SQL_UNITS, SQL_UNIT_MAP, body="SELECT * FROM unit_map"))
register("a1_mode_by_group", """
WITH c AS (SELECT c_nationkey, nullif(c_mktsegment, 'BUILDING') AS seg,
                  CASE WHEN c_nationkey <> 3 THEN nullif(c_mktsegment, 'BUILDING') END AS seg2 FROM customer),
m1 AS (SELECT c_nationkey, seg AS mode_seg FROM (
         SELECT c_nationkey, seg, row_number() OVER (PARTITION BY c_nationkey ORDER BY count(*) DESC, seg) AS rn
         FROM c WHERE seg IS NOT NULL GROUP BY c_nationkey, seg) WHERE rn = 1),
m2 AS (SELECT c_nationkey, seg2 AS mode_seg2 FROM (
         SELECT c_nationkey, seg2, row_number() OVER (PARTITION BY c_nationkey ORDER BY count(*) DESC, seg2) AS rn
         FROM c WHERE seg2 IS NOT NULL GROUP BY c_nationkey, seg2) WHERE rn = 1)
SELECT g.c_nationkey, m1.mode_seg, m2.mode_seg2
FROM (SELECT DISTINCT c_nationkey FROM c) g LEFT JOIN m1 USING (c_nationkey) LEFT JOIN m2 USING (c_nationkey)""")
register("a2_agency_dim", sql(SQL_UNITS, SQL_AGENCY, body="SELECT * FROM agency"))
register("a3_creditor_dim", sql(SQL_CONTRACTS, SQL_COMMITMENTS, SQL_CREDITOR,
                                body="SELECT * FROM creditor"))
register("g3_modality_dim", sql(SQL_CONTRACTS, SQL_MODALITY, body="SELECT * FROM modal"))
register("x5_calendar_dim", sql(SQL_CONTRACTS, SQL_COMMITMENTS, SQL_PAYMENTS, SQL_CALENDAR,
                                body="SELECT * FROM cal"))
register("p2_contract_fact", sql(SQL_CONTRACTS, SQL_CONTRACT_FACT, body="SELECT * FROM contract_fact"))
register("j2_commitment_fact", sql(SQL_COMMITMENTS, SQL_UNITS, SQL_UNIT_MAP, SQL_COMMIT_FACT,
                                   body="SELECT * FROM commit_fact"))
register("j3_payment_fact", sql(SQL_PAYMENTS, SQL_UNITS, SQL_UNIT_MAP, SQL_PAY_FACT,
                                body="SELECT * FROM pay_fact"))
register("j18_commitment_contract_link", sql(
    SQL_CONTRACTS, SQL_COMMITMENTS, SQL_UNITS, SQL_UNIT_MAP, SQL_COMMIT_FACT, SQL_CONTRACT_FACT, body="""
, nums AS (SELECT num_contrato, id_contrato_origem FROM (
    SELECT num_contrato, id_contrato_origem,
           row_number() OVER (PARTITION BY num_contrato ORDER BY data_assinatura DESC, id_contrato_origem DESC) AS rn
    FROM contract_fact WHERE num_contrato IS NOT NULL) WHERE rn = 1)
SELECT f.*, n.id_contrato_origem FROM commit_fact f
LEFT JOIN nums n ON (CASE WHEN regexp_full_match(f.codcontrato, '0+') THEN NULL ELSE f.codcontrato END) = n.num_contrato"""))
register("j4_contract_star", sql(*GOLD, SQL_CONTRACT_STAR, body="SELECT * FROM contract_star"))
SQL_CONTRACT_NUMBERS = """
ck AS (SELECT num_contrato, sk_contrato FROM (
    SELECT num_contrato, sk_contrato, row_number() OVER (PARTITION BY num_contrato ORDER BY data_assinatura DESC, sk_contrato DESC) AS rn
    FROM contract_star WHERE num_contrato IS NOT NULL) WHERE rn = 1)"""
register("j5_commitment_star", sql(*GOLD, SQL_CONTRACT_STAR, SQL_CONTRACT_NUMBERS, body="""
SELECT f.*, t.sk_tempo, a.sk_orgao, c.sk_credor, ck.sk_contrato, row_number() OVER (ORDER BY f.id_empenho_origem, f.ano) AS sk_empenho
FROM commit_fact f
LEFT JOIN cal t ON t.data = f.data_emissao LEFT JOIN agency a ON a.codigo_orgao = f.codigo_orgao
LEFT JOIN creditor_cur c ON c.cpf_cnpj = f.cpf_cnpj
LEFT JOIN ck ON (CASE WHEN regexp_full_match(f.codcontrato, '0+') THEN NULL ELSE f.codcontrato END) = ck.num_contrato"""))
register("j6_payment_star", sql(*GOLD, body="""
SELECT f.*, t.sk_tempo, a.sk_orgao, c.sk_credor, row_number() OVER (ORDER BY f.id_ob_origem, f.ano) AS sk_ordem_bancaria FROM pay_fact f
LEFT JOIN cal t ON t.data = f.data_emissao LEFT JOIN agency a ON a.codigo_orgao = f.codigo_orgao
LEFT JOIN creditor_cur c ON c.cpf_cnpj = f.cpf_cnpj"""))
register("j15_analysis_star", sql(*GOLD, SQL_CONTRACT_STAR, body="""
SELECT f.sk_contrato, f.ano, t.data, t.trimestre, t.ano_mes, a.nome AS nome_orgao, m.descricao_modalidade, m.descricao_tipo, c.nome AS nome_credor,
       c.cpf_cnpj, c.tipo_pessoa, f.valor_contratado, f.valor_empenhado, f.valor_pago, f.dias_vigencia
FROM contract_star f LEFT JOIN cal t ON t.sk_tempo = f.sk_tempo_assinatura LEFT JOIN agency a ON a.sk_orgao = f.sk_orgao
LEFT JOIN modal m ON m.sk_modalidade = f.sk_modalidade LEFT JOIN creditor_cur c ON c.sk_credor = f.sk_credor"""))

register("a5_quarterly_payments", sql(*BASE_FEATURES, body="SELECT * FROM hist_named"))
register("a6_contracted_running", sql(*BASE_FEATURES, body="SELECT * FROM cq_run"))
register("a7_financial_summary", sql(SQL_CONTRACTS, SQL_CONTRACT_FACT, body="""
SELECT CAST(coalesce(sum(valor_contratado), 0) AS DECIMAL(18,2)) AS total_contratado,
       CAST(coalesce(sum(valor_pago), 0) AS DECIMAL(18,2)) AS total_pago,
       CAST(coalesce(sum(valor_empenhado), 0) AS DECIMAL(18,2)) AS total_empenhado,
       count(*) FILTER (WHERE valor_pago > valor_contratado) AS contratos_pagamento_acima_do_valor,
       round(coalesce(CAST(sum(valor_pago) AS DOUBLE) * 100.0 / nullif(CAST(sum(valor_contratado) AS DOUBLE), 0), 0), 4) AS pct_pago
FROM contract_fact"""))
register("a8_infraction_creditors", sql(*GOLD, SQL_CONTRACT_STAR, body="""
SELECT dc.nome, dc.cpf_cnpj, dc.historico_infringement, count(fc.sk_contrato) AS qtd_contratos,
       CAST(sum(fc.valor_contratado) AS DECIMAL(18,2)) AS valor_total
FROM creditor_cur dc JOIN contract_star fc ON fc.sk_credor = dc.sk_credor
WHERE dc.historico_infringement > 0 AND dc.versao_atual
GROUP BY dc.nome, dc.cpf_cnpj, dc.historico_infringement
ORDER BY valor_total DESC, dc.cpf_cnpj LIMIT 10"""))
register("a11_heuristic_p95", sql(SQL_CONTRACTS, SQL_CONTRACT_FACT, body="""
, h AS (SELECT *, descricao_modalidade IN ('1-URGENT', '2-HIGH')
                  AND CAST(valor_contratado AS DOUBLE) >= (SELECT quantile_cont(CAST(valor_contratado AS DOUBLE), 0.95) FROM contract_fact) AS heuristica
        FROM contract_fact)
""" + _describe("h", ["valor_contratado", "dias_vigencia"], by="heuristica")))
register("a12_describe", sql(SQL_CONTRACTS, SQL_CONTRACT_FACT, body=_describe(
    "contract_fact", ["valor_contratado", "valor_empenhado", "valor_pago", "dias_vigencia"])))
register("a13_describe_by_group", sql(SQL_CONTRACTS, SQL_CONTRACT_FACT, body=_describe(
    "contract_fact", ["valor_contratado"], by="descricao_modalidade")))
register("a14_value_counts", sql(SQL_CONTRACTS, SQL_CONTRACT_FACT, body="""
SELECT descricao_modalidade, count(*) AS n FROM contract_fact WHERE descricao_modalidade IS NOT NULL GROUP BY descricao_modalidade"""))
register("a15_monthly_sum", sql(SQL_CONTRACTS, SQL_CONTRACT_FACT, body="""
SELECT CAST(date_trunc('month', data_assinatura) AS DATE) AS periodo, CAST(sum(valor_contratado) AS DECIMAL(18,2)) AS total_contratado
FROM contract_fact GROUP BY 1"""))
register("a20_histogram", sql(SQL_CONTRACTS, SQL_CONTRACT_FACT, body="""
, b AS (SELECT min(CAST(valor_contratado AS DOUBLE)) AS mn, max(CAST(valor_contratado AS DOUBLE)) AS mx FROM contract_fact)
, h AS (SELECT least(CASE WHEN x >= mx THEN 31 ELSE CAST(floor(30 * (x - mn) / (mx - mn)) AS BIGINT) + 1 END, 30) AS bin,
       count(*) AS n
FROM (SELECT CAST(valor_contratado AS DOUBLE) AS x FROM contract_fact WHERE valor_contratado IS NOT NULL), b
GROUP BY 1)
SELECT r.bin, coalesce(h.n, 0) AS n FROM range(1, 31) r(bin) LEFT JOIN h ON h.bin = r.bin"""))
register("w9_minmax_scale", sql(SQL_CONTRACTS, SQL_CONTRACT_FACT, body="""
, b AS (SELECT min(CAST(valor_contratado AS DOUBLE)) AS mn, max(CAST(valor_contratado AS DOUBLE)) AS mx FROM contract_fact)
SELECT id_contrato_origem, ano, valor_contratado,
       CASE WHEN mx = mn THEN 0.0 ELSE (CAST(valor_contratado AS DOUBLE) - mn) / (mx - mn) END AS valor_norm
FROM contract_fact, b"""))

SQL_HOLDOUT = """
, holdout AS (
  SELECT * EXCLUDE (rn, n), CASE WHEN rn = 1 THEN 'test' ELSE 'train' END AS fold FROM (
    SELECT *, row_number() OVER (PARTITION BY codigo_orgao ORDER BY ano DESC, trimestre DESC) AS rn,
           count(*) OVER (PARTITION BY codigo_orgao) AS n
    FROM features WHERE valor_lag1 IS NOT NULL AND valor_mesmo_trimestre_ano_anterior IS NOT NULL) WHERE n >= 4)"""
register("w8_holdout_split", sql(*BASE_FEATURES, body=SQL_HOLDOUT + " SELECT * FROM holdout"))
register("a17_backtest_naive", sql(*BASE_FEATURES, body=SQL_HOLDOUT + """
, last_train AS (
  SELECT codigo_orgao, valor_total AS v FROM (
    SELECT *, row_number() OVER (PARTITION BY codigo_orgao ORDER BY ano DESC, trimestre DESC) AS rn
    FROM holdout WHERE fold = 'train') WHERE rn = 1),
pred AS (
  SELECT t.codigo_orgao, CAST(t.valor_total AS DOUBLE) AS y, CAST(l.v AS DOUBLE) AS p50,
         CAST(CAST(l.v * 0.7 AS DECIMAL(18,2)) AS DOUBLE) AS p10, CAST(CAST(l.v * 1.3 AS DECIMAL(18,2)) AS DOUBLE) AS p90
  FROM holdout t JOIN last_train l USING (codigo_orgao) WHERE t.fold = 'test')
SELECT count(*) AS n, round(avg(abs(y - p50)), 6) AS mae, round(avg(abs(y - p50) / nullif(y, 0.0)), 6) AS mape,
       round(avg(CAST(y BETWEEN p10 AND p90 AS DOUBLE)), 6) AS coverage
FROM pred"""))

SQL_NAIVE = """
, last_row AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY codigo_orgao ORDER BY ano DESC, trimestre DESC) AS rn
                 FROM features) WHERE rn = 1),
naive AS (
  SELECT codigo_orgao, sk_orgao, '2026-Q4' AS trimestre_referencia,
         CAST(greatest(valor_total, 0) AS DECIMAL(18,2)) AS valor_previsto,
         CAST(greatest(least(CAST(valor_total * 0.7 AS DECIMAL(18,2)), valor_total), 0) AS DECIMAL(18,2)) AS intervalo_inferior,
         CAST(greatest(CAST(valor_total * 1.3 AS DECIMAL(18,2)), valor_total, greatest(valor_total, 0)) AS DECIMAL(18,2)) AS intervalo_superior,
         'naive_persistence' AS modelo
  FROM last_row)"""
register("m7_naive_forecast", sql(*BASE_FEATURES, body=SQL_NAIVE + " SELECT * FROM naive"))
register("m10_next_quarter_features", sql(*BASE_FEATURES, body="""
, last_row AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY codigo_orgao ORDER BY ano DESC, trimestre DESC) AS rn
                 FROM features) WHERE rn = 1),
ya AS (SELECT codigo_orgao, valor_total FROM features WHERE ano = 2025 AND trimestre = 4)
SELECT l.codigo_orgao, 4 AS trimestre, 1 AS ano_eleitoral, l.valor_total AS valor_lag1,
       coalesce(ya.valor_total, l.valor_total) AS valor_mesmo_trimestre_ano_anterior,
       l.valor_contratado_acumulado, 2026 * 4 + 4 AS sequencial_trimestre, '2026-Q4' AS trimestre_referencia
FROM last_row l LEFT JOIN ya USING (codigo_orgao)"""))
register("o5_top_forecasts", sql(*BASE_FEATURES, body=SQL_NAIVE + """
, batch AS (SELECT *, TIMESTAMP '2026-07-23 10:00:00' AS data_geracao FROM naive)
SELECT p.trimestre_referencia, a.nome AS nome_orgao, p.valor_previsto, p.intervalo_inferior,
       p.intervalo_superior, p.modelo, p.sk_orgao
FROM batch p JOIN agency a ON a.sk_orgao = p.sk_orgao
WHERE p.data_geracao = (SELECT max(data_geracao) FROM batch)
ORDER BY p.valor_previsto DESC, p.sk_orgao LIMIT 15"""))
register("o6_overpaid_head", sql(SQL_CONTRACTS, SQL_COMMITMENTS, SQL_CREDITOR, SQL_CONTRACT_FACT, body="""
SELECT f.id_contrato_origem, c.nome AS nome_credor, f.valor_contratado, f.valor_pago FROM contract_fact f
LEFT JOIN creditor c ON c.cpf_cnpj = f.cpf_cnpj
WHERE f.valor_pago > f.valor_contratado ORDER BY f.id_contrato_origem LIMIT 10"""))


def creditor_sql(contracts: str, commitments: str, name: str) -> str:
    return f"""
{name}_u AS (
  SELECT cpf_cnpj_financiador AS cpf_cnpj, descricao_nome_credor AS nome, coalesce(infringement_status, 0) AS h FROM {contracts}
  UNION ALL SELECT codigocredor, nomecredor, 0 FROM {commitments}),
{name} AS (
  SELECT cpf_cnpj, arg_max(nome, row(h, nome)) FILTER (WHERE nome IS NOT NULL) AS nome,
         CASE WHEN length(cpf_cnpj) > 11 THEN 'PJ' ELSE 'PF' END AS tipo_pessoa,
         CAST(max(h) AS INTEGER) AS historico_infringement
  FROM {name}_u WHERE cpf_cnpj IS NOT NULL GROUP BY cpf_cnpj)"""


register("g1_insert_absent", sql(SQL_CONTRACTS, SQL_COMMITMENTS, SQL_PAYMENTS, SQL_CALENDAR, body="""
, tdays AS (SELECT DISTINCT CAST(data_assinatura AS DATE) AS data FROM contracts WHERE data_assinatura IS NOT NULL),
target AS (SELECT c.* EXCLUDE (sk_tempo), row_number() OVER (ORDER BY c.data) AS sk_tempo
           FROM cal c WHERE c.data IN (SELECT data FROM tdays))
SELECT * FROM target
UNION ALL
SELECT c.* EXCLUDE (sk_tempo), (SELECT max(sk_tempo) FROM target) + row_number() OVER (ORDER BY c.data) AS sk_tempo
FROM cal c WHERE c.data NOT IN (SELECT data FROM tdays)"""))

register("g2_upsert_agency", sql(
    SQL_UNITS, "units_old AS (SELECT * FROM units WHERE ano < 1998)", agency_sql("units_old", "agency_old", "o_"),
    agency_sql("units", "agency_new", "n_"), body="""
SELECT o.codigo_orgao, n.nome, n.cnpj, n.tipo_administracao, n.esfera, o.sk_orgao
FROM agency_old o JOIN agency_new n USING (codigo_orgao)
UNION ALL
SELECT o.codigo_orgao, o.nome, o.cnpj, o.tipo_administracao, o.esfera, o.sk_orgao
FROM agency_old o WHERE o.codigo_orgao NOT IN (SELECT codigo_orgao FROM agency_new)
UNION ALL
SELECT n.codigo_orgao, n.nome, n.cnpj, n.tipo_administracao, n.esfera,
       (SELECT max(sk_orgao) FROM agency_old) + row_number() OVER (ORDER BY n.codigo_orgao) AS sk_orgao
FROM agency_new n WHERE n.codigo_orgao NOT IN (SELECT codigo_orgao FROM agency_old)"""))

register("g4_scd2_merge", sql(
    SQL_CONTRACTS, SQL_COMMITMENTS,
    "contracts_old AS (SELECT * FROM contracts WHERE data_assinatura < TIMESTAMP '1999-01-01')",
    "commitments_old AS (SELECT * FROM commitments WHERE dataemissao < TIMESTAMP '1999-01-01')",
    creditor_sql("contracts_old", "commitments_old", "cred_old"),
    creditor_sql("contracts", "commitments", "cred_new"), body="""
, hist AS (SELECT *, DATE '2026-01-01' AS data_inicio, CAST(NULL AS DATE) AS data_fim, true AS versao_atual,
                  row_number() OVER (ORDER BY cpf_cnpj) AS sk_credor FROM cred_old),
j AS (SELECT h.*, i.cpf_cnpj AS i_cpf, i.nome AS i_nome, i.tipo_pessoa AS i_tp, i.historico_infringement AS i_h
      FROM hist h FULL OUTER JOIN cred_new i ON h.cpf_cnpj = i.cpf_cnpj),
newv AS (SELECT i_cpf AS cpf_cnpj, i_nome AS nome, i_tp AS tipo_pessoa, i_h AS historico_infringement
         FROM j WHERE i_cpf IS NOT NULL AND (cpf_cnpj IS NULL OR nome IS DISTINCT FROM i_nome))
SELECT cpf_cnpj, nome, tipo_pessoa, historico_infringement, data_inicio, data_fim, versao_atual, sk_credor
FROM j WHERE i_cpf IS NULL
UNION ALL
SELECT cpf_cnpj, nome, tipo_pessoa, i_h, data_inicio, data_fim, true, sk_credor
FROM j WHERE cpf_cnpj IS NOT NULL AND i_cpf IS NOT NULL AND nome IS NOT DISTINCT FROM i_nome
UNION ALL
SELECT cpf_cnpj, nome, tipo_pessoa, historico_infringement, data_inicio, DATE '2026-07-23', false, sk_credor
FROM j WHERE cpf_cnpj IS NOT NULL AND i_cpf IS NOT NULL AND nome IS DISTINCT FROM i_nome
UNION ALL
SELECT cpf_cnpj, nome, tipo_pessoa, historico_infringement, DATE '2026-07-23', CAST(NULL AS DATE), true,
       (SELECT max(sk_credor) FROM hist) + row_number() OVER (ORDER BY cpf_cnpj)
FROM newv"""))

_UPD = ["data_assinatura", "cpf_cnpj", "codigo_orgao", "descricao_modalidade", "descricao_tipo",
        "valor_contratado", "valor_empenhado", "valor_pago", "status", "tipo_objeto",
        "flag_emergency", "dias_vigencia", "historico_credor_infringement"]
register("g5_merge_upsert", sql(SQL_CONTRACTS, SQL_CONTRACT_FACT, body=f"""
, tgt AS (SELECT * REPLACE ('OLD-' || num_contrato AS num_contrato, CAST(0 AS DECIMAL(18,2)) AS valor_pago),
                 CAST(0.5 AS DECIMAL(5,4)) AS score_anomalia,
                 row_number() OVER (ORDER BY id_contrato_origem, ano) AS sk_contrato
          FROM contract_fact WHERE data_assinatura < DATE '1999-01-01')
SELECT t.id_contrato_origem, t.ano, t.num_contrato, {", ".join("s." + c for c in _UPD)}, t.score_anomalia, t.sk_contrato
FROM tgt t JOIN contract_fact s USING (id_contrato_origem, ano)
UNION ALL
SELECT t.id_contrato_origem, t.ano, t.num_contrato, {", ".join("t." + c for c in _UPD)}, t.score_anomalia, t.sk_contrato
FROM tgt t ANTI JOIN contract_fact s USING (id_contrato_origem, ano)
UNION ALL
SELECT s.id_contrato_origem, s.ano, s.num_contrato, {", ".join("s." + c for c in _UPD)}, CAST(NULL AS DECIMAL(5,4)),
       (SELECT max(sk_contrato) FROM tgt) + row_number() OVER (ORDER BY s.id_contrato_origem, s.ano)
FROM contract_fact s ANTI JOIN tgt t USING (id_contrato_origem, ano)"""))

register("g8_update_by_key", sql(SQL_CONTRACTS, SQL_CONTRACT_FACT, body="""
, fc AS (SELECT *, row_number() OVER (ORDER BY id_contrato_origem, ano) AS sk_contrato FROM contract_fact),
b AS (SELECT min(CAST(valor_contratado AS DOUBLE)) AS mn, max(CAST(valor_contratado AS DOUBLE)) AS mx FROM fc WHERE status = 'F'),
sc AS (SELECT sk_contrato, ano, CAST(CASE WHEN mx = mn THEN 0.0 ELSE (CAST(valor_contratado AS DOUBLE) - mn) / (mx - mn) END AS DECIMAL(5,4)) AS s
       FROM fc, b WHERE status = 'F')
SELECT fc.*, sc.s AS score_anomalia FROM fc LEFT JOIN sc USING (sk_contrato, ano)"""))

register("g9_assign_keys", """
SELECT c_custkey, c_name, c_nationkey, 1000 + row_number() OVER (ORDER BY c_name) AS sk_cliente FROM customer""")


def _chk(check: str, table: str, expr: str) -> str:
    return f"SELECT '{check}' AS \"check\", '{table}' AS table_name, CAST(({expr}) AS BIGINT) AS n_bad, ({expr}) = 0 AS ok"


#: Table, its CTE, NOT NULL columns, unique keys (with a condition), foreign keys (column, CTE, key).
_CONSTRAINTS = [
    ("dim_tempo", "cal", "sk_tempo data ano trimestre mes dia dia_semana nome_dia_semana nome_mes ano_mes", [("sk_tempo", ""), ("data", "")], []),
    ("dim_credor", "scd", "sk_credor cpf_cnpj nome tipo_pessoa historico_infringement data_inicio versao_atual", [("sk_credor", ""), ("cpf_cnpj", "WHERE versao_atual")], []),
    ("dim_orgao", "agency", "sk_orgao codigo_orgao nome", [("sk_orgao", ""), ("codigo_orgao", "")], []),
    ("dim_modalidade", "modal", "sk_modalidade descricao_modalidade", [("sk_modalidade", ""), ("descricao_modalidade,descricao_tipo", "")], []),
    ("fato_contrato", "contract_star",
     "sk_contrato id_contrato_origem valor_contratado valor_empenhado valor_pago flag_emergency historico_credor_infringement ano sk_tempo_assinatura sk_modalidade",
     [("sk_contrato,ano", ""), ("id_contrato_origem,ano", ""), ("id_contrato_origem", "")],
     [("sk_tempo_assinatura", "cal", "sk_tempo"), ("sk_credor", "creditor_cur", "sk_credor"), ("sk_orgao", "agency", "sk_orgao"), ("sk_modalidade", "modal", "sk_modalidade")]),
    ("fato_empenho", "emp_star", "sk_empenho id_empenho_origem valor ano", [("sk_empenho", ""), ("id_empenho_origem,ano", "")],
     [("sk_tempo", "cal", "sk_tempo"), ("sk_orgao", "agency", "sk_orgao"), ("sk_credor", "creditor_cur", "sk_credor")]),
    ("fato_ordem_bancaria", "pay_star", "sk_ordem_bancaria id_ob_origem valor ano", [("sk_ordem_bancaria", ""), ("id_ob_origem,ano", "")],
     [("sk_tempo", "cal", "sk_tempo"), ("sk_orgao", "agency", "sk_orgao"), ("sk_credor", "creditor_cur", "sk_credor")]),
    ("previsao_pagamento_trimestral", "forecasts", "sk_previsao trimestre_referencia valor_previsto modelo data_geracao", [("sk_previsao", "")], [("sk_orgao", "agency", "sk_orgao")]),
    ("relatorio_insights", "reports", "sk_relatorio titulo conteudo_markdown data_geracao", [("sk_relatorio", "")], []),
]


def _constraint_rows() -> list[str]:
    out = [_chk("min_rows>=1", "fato_contrato", "SELECT CASE WHEN count(*) >= 1 THEN 0 ELSE 1 END FROM contract_star"),
           _chk("in_set:tipo_pessoa", "dim_credor", "SELECT count(*) FILTER (WHERE tipo_pessoa IS NOT NULL AND tipo_pessoa NOT IN ('PF', 'PJ')) FROM scd"),
           _chk("unresolved:sk_orgao", "fato_ordem_bancaria", "SELECT count(*) FILTER (WHERE sk_orgao IS NULL) FROM pay_star"),
           _chk("unresolved:sk_credor", "fato_contrato", "SELECT count(*) FILTER (WHERE sk_credor IS NULL) FROM contract_star")]
    for table, cte, filled, unique, foreign in _CONSTRAINTS:
        out += [_chk(f"not_null:{c}", table, f"SELECT count(*) FILTER (WHERE {c} IS NULL) FROM {cte}") for c in filled.split()]
        out += [_chk(f"unique:{k}", table, f"SELECT count(*) FROM (SELECT 1 FROM {cte} {where} GROUP BY {k} HAVING count(*) > 1)") for k, where in unique]
        out += [_chk(f"fk:{c}", table, f"SELECT count(*) FROM {cte} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {pk} FROM {parent})") for c, parent, pk in foreign]
    return out


def _quality_sql() -> str:
    return sql(*GOLD, SQL_CONTRACT_STAR, SQL_HISTORY, """
emp_star AS (
  SELECT f.*, t.sk_tempo, a.sk_orgao, c.sk_credor, row_number() OVER (ORDER BY f.id_empenho_origem, f.ano) AS sk_empenho FROM commit_fact f
  LEFT JOIN cal t ON t.data = f.data_emissao LEFT JOIN agency a ON a.codigo_orgao = f.codigo_orgao LEFT JOIN creditor_cur c ON c.cpf_cnpj = f.cpf_cnpj),
pay_star AS (
  SELECT f.*, t.sk_tempo, a.sk_orgao, c.sk_credor, row_number() OVER (ORDER BY f.id_ob_origem, f.ano) AS sk_ordem_bancaria FROM pay_fact f
  LEFT JOIN cal t ON t.data = f.data_emissao LEFT JOIN agency a ON a.codigo_orgao = f.codigo_orgao LEFT JOIN creditor_cur c ON c.cpf_cnpj = f.cpf_cnpj)""",
    "contracts_old AS (SELECT * FROM contracts WHERE data_assinatura < TIMESTAMP '1999-01-01')",
    "commitments_old AS (SELECT * FROM commitments WHERE dataemissao < TIMESTAMP '1999-01-01')",
    creditor_sql("contracts_old", "commitments_old", "cred_old"), "scd AS (" + ORACLE["g4_scd2_merge"] + ")",
    SQL_NAIVE.strip().lstrip(","),
    "forecasts AS (SELECT *, row_number() OVER (ORDER BY codigo_orgao) AS sk_previsao, TIMESTAMP '2026-07-23' AS data_geracao FROM naive)",
    "reports AS (SELECT 1 AS sk_relatorio, 'Relatório de Insights (2026-07-23)' AS titulo, '' AS conteudo_markdown, TIMESTAMP '2026-07-23' AS data_geracao)",
    body="\nUNION ALL\n".join(_constraint_rows()))


register("q5_quality_report", _quality_sql())

register("s7_page_roundtrip", sql(SQL_CONTRACTS, body="SELECT * FROM contracts"))
register("q3_page_checks", """
SELECT 'r1' AS run_id, CAST(ceil(count(*) / 500.0) AS BIGINT) AS pages, CAST(ceil(count(*) / 500.0) AS INTEGER) AS expected_pages,
       CAST(0 AS BIGINT) AS bad_structure, true AS ok FROM orders""")
register("k4_partitioned_roundtrip", sql(SQL_PAYMENTS, body="""
SELECT *, CAST(year(dataemissao) AS INTEGER) AS p_ano, lpad(CAST(month(dataemissao) AS VARCHAR), 2, '0') AS p_mes
FROM payments WHERE dataemissao IS NOT NULL"""))
register("s6_run_history", "SELECT *, strftime(ts, '%Y-%m-%d') AS run_id FROM events")
register("i1_incremental_stream", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, strftime(ts, '%Y-%m-%d') AS run_id,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS FIRST, event_id DESC) AS rn
  FROM events) WHERE rn = 1""")

register("i3_pipeline_silver_gold", sql(*GOLD, SQL_CONTRACT_STAR, body="""
SELECT 'silver' AS stage, 'contratos' AS table_name, (SELECT count(*) FROM contracts WHERE data_assinatura IS NOT NULL) AS "rows"
UNION ALL SELECT 'silver', 'empenhos', (SELECT count(*) FROM commitments WHERE dataemissao IS NOT NULL)
UNION ALL SELECT 'silver', 'ordem_bancaria_orcamentaria', (SELECT count(*) FROM payments WHERE dataemissao IS NOT NULL)
UNION ALL SELECT 'silver', 'unidade_gestora', (SELECT count(*) FROM units)
UNION ALL SELECT 'gold', 'dim_tempo', (SELECT count(*) FROM cal)
UNION ALL SELECT 'gold', 'dim_orgao', (SELECT count(*) FROM agency)
UNION ALL SELECT 'gold', 'dim_modalidade', (SELECT count(*) FROM modal)
UNION ALL SELECT 'gold', 'dim_credor', (SELECT count(*) FROM creditor_cur)
UNION ALL SELECT 'gold', 'fato_contrato', (SELECT count(*) FROM contract_star)
UNION ALL SELECT 'gold', 'fato_empenho', (SELECT count(*) FROM commit_fact)
UNION ALL SELECT 'gold', 'fato_ordem_bancaria', (SELECT count(*) FROM pay_fact)"""))

register("s2_extract_snapshot", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
register("x16_json_text", """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")

register("s3_extraction_runs", """
SELECT 'run1' AS run_id, 'orders' AS table_name, 'incremental' AS kind,
       (SELECT count(*) FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1997-12-31') AS "rows",
       '1995-01-01' AS start, '1997-12-31' AS "end", true AS ok, '1997-12-31' AS mark_after
UNION ALL SELECT 'run1', 'lineitem', 'incremental',
       (SELECT count(*) FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1997-12-31'),
       '1995-01-01', '1997-12-31', true, '1997-12-31'
UNION ALL SELECT 'run1', 'supplier', 'snapshot', (SELECT count(*) FROM supplier), '1995-01-01', '1997-12-31', true, '1997-12-31'
UNION ALL SELECT 'run1', 'nation', 'snapshot', (SELECT count(*) FROM nation), '1995-01-01', '1997-12-31', true, '1997-12-31'
UNION ALL SELECT 'run2', 'orders', 'incremental',
       (SELECT count(*) FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1997-12-31' AND TIMESTAMP '2001-12-31'),
       '1997-12-31', '2001-12-31', true, '2001-12-31'
UNION ALL SELECT 'run2', 'lineitem', 'incremental',
       (SELECT count(*) FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '1997-12-31' AND TIMESTAMP '2001-12-31'),
       '1997-12-31', '2001-12-31', true, '2001-12-31'
UNION ALL SELECT 'run2', 'supplier', 'snapshot', (SELECT count(*) FROM supplier), '1997-12-31', '2001-12-31', true, '2001-12-31'
UNION ALL SELECT 'run2', 'nation', 'snapshot', (SELECT count(*) FROM nation), '1997-12-31', '2001-12-31', true, '2001-12-31'""")


def modality_insert_sql(old: str, name: str) -> str:
    """Modalities of ``old`` numbered, then the others of all contracts (as CTE ``name``)."""
    return f"""
{name}_old AS (
  SELECT *, row_number() OVER (ORDER BY descricao_modalidade NULLS FIRST, descricao_tipo NULLS FIRST) AS sk_modalidade
  FROM (SELECT DISTINCT descricao_modalidade, descricao_tipo FROM {old} WHERE descricao_modalidade IS NOT NULL)),
{name} AS (
  SELECT * FROM {name}_old
  UNION ALL
  SELECT descricao_modalidade, descricao_tipo, (SELECT coalesce(max(sk_modalidade), 0) FROM {name}_old)
         + row_number() OVER (ORDER BY descricao_modalidade NULLS FIRST, descricao_tipo NULLS FIRST)
  FROM (SELECT DISTINCT descricao_modalidade, descricao_tipo FROM contracts WHERE descricao_modalidade IS NOT NULL) c
  WHERE NOT EXISTS (SELECT 1 FROM {name}_old o WHERE o.descricao_modalidade = c.descricao_modalidade
                    AND o.descricao_tipo IS NOT DISTINCT FROM c.descricao_tipo))"""


register("g3_modality_insert", sql(
    SQL_CONTRACTS, "first_days AS (SELECT * FROM contracts WHERE data_assinatura < TIMESTAMP '1995-01-03')",
    modality_insert_sql("first_days", "m"), body="SELECT * FROM m"))


def _line_upsert(fact: str, key: str, code: str, sk: str, rest: list[str]) -> str:
    cols = ", ".join("s." + c for c in rest)
    return f"""
, tgt AS (SELECT {key}, ano, 'OLD-' || {code} AS {code}, row_number() OVER (ORDER BY {key}, ano) AS {sk}
          FROM {fact} WHERE data_emissao < DATE '1999-01-01')
SELECT s.{key}, s.ano, t.{code}, {cols}, t.{sk} FROM tgt t JOIN {fact} s USING ({key}, ano)
UNION ALL
SELECT s.{key}, s.ano, s.{code}, {cols}, (SELECT max({sk}) FROM tgt) + row_number() OVER (ORDER BY s.{key}, s.ano)
FROM {fact} s ANTI JOIN tgt t USING ({key}, ano)"""


register("g6_upsert_commitments", sql(SQL_COMMITMENTS, SQL_UNITS, SQL_UNIT_MAP, SQL_COMMIT_FACT, body=_line_upsert(
    "commit_fact", "id_empenho_origem", "codigo_empenho", "sk_empenho", ["data_emissao", "codigo_orgao", "cpf_cnpj", "codcontrato", "modalidade", "valor"])))
register("g7_upsert_payments", sql(SQL_PAYMENTS, SQL_UNITS, SQL_UNIT_MAP, SQL_PAY_FACT, body=_line_upsert(
    "pay_fact", "id_ob_origem", "codigo", "sk_ordem_bancaria", ["data_emissao", "codigo_orgao", "cpf_cnpj", "tipo_ob", "valor"])))


def _two_keys(src: str, order: str, old: str) -> str:
    """Keys of two loads: rows of the first numbered, then the others."""
    return (f"CASE WHEN {old} THEN row_number() OVER (PARTITION BY {old} ORDER BY {order}) "
            f"ELSE (SELECT count(*) FROM {src} WHERE {old}) + row_number() OVER (PARTITION BY {old} ORDER BY {order}) END")


def _content(table: str, sk: str, cols: list[str], src: str) -> str:
    text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in cols)
    return f"SELECT '{table}' AS table_name, {sk} AS sk, concat_ws('|', {text}) AS content FROM {src}"


_G4 = ORACLE["g4_scd2_merge"]
register("i3_two_loads", sql(
    *GOLD,
    "contracts_old AS (SELECT * FROM contracts WHERE data_assinatura < TIMESTAMP '1999-01-01')",
    "commitments_old AS (SELECT * FROM commitments WHERE dataemissao < TIMESTAMP '1999-01-01')",
    "payments_old AS (SELECT * FROM payments WHERE dataemissao < TIMESTAMP '1999-01-01')",
    "units_old AS (SELECT * FROM units WHERE ano < 1998)",
    """days_old AS (SELECT DISTINCT CAST(d AS DATE) AS data FROM (
  SELECT data_assinatura AS d FROM contracts_old UNION ALL SELECT dataemissao FROM commitments_old UNION ALL SELECT dataemissao FROM payments_old))""",
    "cal_flag AS (SELECT data, ano_mes, data IN (SELECT data FROM days_old) AS old FROM cal)",
    "cal2 AS (SELECT data, ano_mes, " + _two_keys("cal_flag", "data", "old") + " AS sk_tempo FROM cal_flag)",
    agency_sql("units_old", "agency_old", "o_"),
    "org_flag AS (SELECT * EXCLUDE (sk_orgao), codigo_orgao IN (SELECT codigo_orgao FROM agency_old) AS old FROM agency)",
    "org2 AS (SELECT *, " + _two_keys("org_flag", "codigo_orgao", "old") + " AS sk_orgao FROM org_flag)",
    modality_insert_sql("contracts_old", "modal2"),
    "cred2 AS (" + _G4 + ")",
    """con_flag AS (SELECT f.*, t.sk_tempo AS sk_tempo_assinatura, o.sk_orgao, m.sk_modalidade, c.sk_credor, f.data_assinatura < DATE '1999-01-01' AS old
  FROM contract_fact f LEFT JOIN cal2 t ON t.data = f.data_assinatura LEFT JOIN org2 o ON o.codigo_orgao = f.codigo_orgao
  LEFT JOIN modal2 m ON m.descricao_modalidade = f.descricao_modalidade AND m.descricao_tipo IS NOT DISTINCT FROM f.descricao_tipo
  LEFT JOIN cred2 c ON c.cpf_cnpj = f.cpf_cnpj AND c.versao_atual)""",
    "contract_star AS (SELECT *, " + _two_keys("con_flag", "id_contrato_origem, ano", "old") + " AS sk_contrato FROM con_flag)",
    SQL_CONTRACT_NUMBERS,
    """emp_flag AS (SELECT f.*, t.sk_tempo, o.sk_orgao, c.sk_credor, ck.sk_contrato, f.data_emissao < DATE '1999-01-01' AS old
  FROM commit_fact f LEFT JOIN cal2 t ON t.data = f.data_emissao LEFT JOIN org2 o ON o.codigo_orgao = f.codigo_orgao
  LEFT JOIN cred2 c ON c.cpf_cnpj = f.cpf_cnpj AND c.versao_atual
  LEFT JOIN ck ON (CASE WHEN regexp_full_match(f.codcontrato, '0+') THEN NULL ELSE f.codcontrato END) = ck.num_contrato)""",
    "emp2 AS (SELECT *, " + _two_keys("emp_flag", "id_empenho_origem, ano", "old") + " AS sk_empenho FROM emp_flag)",
    """pay_flag AS (SELECT f.*, t.sk_tempo, o.sk_orgao, c.sk_credor, f.data_emissao < DATE '1999-01-01' AS old
  FROM pay_fact f LEFT JOIN cal2 t ON t.data = f.data_emissao LEFT JOIN org2 o ON o.codigo_orgao = f.codigo_orgao
  LEFT JOIN cred2 c ON c.cpf_cnpj = f.cpf_cnpj AND c.versao_atual)""",
    "pay2 AS (SELECT *, " + _two_keys("pay_flag", "id_ob_origem, ano", "old") + " AS sk_ordem_bancaria FROM pay_flag)",
    body="\nUNION ALL\n".join([
        _content("dim_tempo", "sk_tempo", ["data", "ano_mes"], "cal2"),
        _content("dim_orgao", "sk_orgao", ["codigo_orgao", "nome", "cnpj", "tipo_administracao", "esfera"], "org2"),
        _content("dim_modalidade", "sk_modalidade", ["descricao_modalidade", "descricao_tipo"], "modal2"),
        _content("dim_credor", "sk_credor", ["cpf_cnpj", "nome", "historico_infringement", "data_inicio", "data_fim", "versao_atual"], "cred2"),
        _content("fato_contrato", "sk_contrato", ["id_contrato_origem", "ano", "num_contrato", "sk_tempo_assinatura", "sk_orgao", "sk_modalidade", "sk_credor", "valor_contratado", "valor_pago"], "contract_star"),
        _content("fato_empenho", "sk_empenho", ["id_empenho_origem", "ano", "codigo_empenho", "sk_tempo", "sk_orgao", "sk_credor", "sk_contrato", "valor"], "emp2"),
        _content("fato_ordem_bancaria", "sk_ordem_bancaria", ["id_ob_origem", "ano", "codigo", "sk_tempo", "sk_orgao", "sk_credor", "valor"], "pay2"),
    ])))


# --------------------------------------------------------------------------- #
# Isolation Forest: the fit and the walk, level by level
# --------------------------------------------------------------------------- #
#: Trees, rows a tree, levels, seed.
_TREES, _PSI, _LEVELS, _SEED = 200, 256, 8, 42
_NUM = ["n0", "n1", "n2", "n3"]
_CAT = ["c0", "c1"]


def _hex(text: str, start: int, n: int) -> str:
    return f"('0x' || substr(md5({text}), {start}, {n}))::BIGINT"


def _u(what: str) -> str:
    node_text = f"'{_SEED}|' || tree || '|' || node || '|{what}'"
    return f"({_hex(node_text, 1, 8)} / 4294967296.0::DOUBLE)"


def _left(p: str = "") -> str:
    value = " ".join(f"WHEN {j} THEN {c}" for j, c in enumerate(_NUM))
    label = " ".join(f"WHEN {j} THEN {c}" for j, c in enumerate(_CAT))
    return f"CASE WHEN {p}kind = 0 THEN (CASE {p}feature {value} END) <= {p}threshold ELSE (CASE {p}feature {label} END) <> {p}category END"


def _forest() -> list[str]:
    columns = ", ".join(_NUM + _CAT)
    row_text = f"sk_contrato || '|{_SEED}'"
    ctes = [f"""
feat AS MATERIALIZED (
  SELECT f.sk_contrato, f.ano, coalesce(CAST(valor_contratado AS DOUBLE), 0) AS n0, coalesce(CAST(dias_vigencia AS DOUBLE), 0) AS n1,
    coalesce(CAST(historico_credor_infringement AS DOUBLE), 0) AS n2, coalesce(CAST(CAST(flag_emergency AS INTEGER) AS DOUBLE), 0) AS n3,
    coalesce(m.descricao_modalidade, 'DESCONHECIDO') AS c0, coalesce(tipo_objeto, 'DESCONHECIDO') AS c1
  FROM contract_star f LEFT JOIN modal m USING (sk_modalidade))""", f"""
placed AS MATERIALIZED (SELECT *, {_hex(row_text, 1, 7)} + 1 AS a, {_hex(row_text, 8, 7)} AS b FROM feat)""", f"""
grow0 AS MATERIALIZED (
  SELECT tree, 0 AS node, {columns} FROM placed, range({_TREES}) t(tree)
  QUALIFY row_number() OVER (PARTITION BY tree ORDER BY (a * (tree + 1) + b) % 268435399, sk_contrato) <= {_PSI})"""]
    for d in range(_LEVELS + 1):
        ways = " || ".join([f"CASE WHEN min({c}) < max({c}) THEN [{{'kind': 0, 'feature': {j}, 'category': NULL::VARCHAR, 'lo': min({c}), 'hi': max({c})}}] ELSE [] END" for j, c in enumerate(_NUM)]
                           + [f"CASE WHEN count(DISTINCT {c}) > 1 THEN list_transform(list_sort(list(DISTINCT {c})), lambda x: {{'kind': 1, 'feature': {j}, 'category': x, 'lo': NULL::DOUBLE, 'hi': NULL::DOUBLE}}) ELSE [] END"
                              for j, c in enumerate(_CAT)])
        ctes.append(f"""
met{d} AS (SELECT tree, node, count(*) AS size, {ways if d < _LEVELS else "[]"} AS ways FROM grow{d} GROUP BY tree, node)""")
        chosen = f"ways[CAST(floor({_u('feature')} * len(ways)) AS BIGINT) + 1]" if d < _LEVELS else "NULL::STRUCT(kind INTEGER, feature INTEGER, category VARCHAR, lo DOUBLE, hi DOUBLE)"
        ctes.append(f"""
way{d} AS (SELECT tree, node, size, {chosen} AS way FROM met{d})""")
        ctes.append(f"""
node{d} AS MATERIALIZED (
  SELECT tree, node, size, {d} AS depth, coalesce(way.kind, -1) AS kind, way.feature AS feature, way.category AS category,
    CASE WHEN way.lo + {_u('threshold')} * (way.hi - way.lo) >= way.hi THEN way.lo ELSE way.lo + {_u('threshold')} * (way.hi - way.lo) END AS threshold FROM way{d})""")
        if d < _LEVELS:
            ctes.append(f"""
grow{d + 1} AS MATERIALIZED (
  SELECT tree, CASE WHEN {_left('s.')} THEN 2 * node + 1 ELSE 2 * node + 2 END AS node, {columns}
  FROM grow{d} JOIN node{d} s USING (tree, node) WHERE s.kind >= 0)""")
    ctes.append("""
forest AS MATERIALIZED (
  SELECT *, CAST(depth + CAST(round(CASE WHEN size <= 1 THEN 0 WHEN size = 2 THEN 1
      ELSE 2 * (ln(size - 1.0::DOUBLE) + 0.5772156649015329::DOUBLE) - 2 * (size - 1.0::DOUBLE) / size END, 10) AS DECIMAL(20,10)) AS DECIMAL(20,10)) AS length
  FROM (""" + " UNION ALL ".join(f"SELECT * FROM node{d}" for d in range(_LEVELS + 1)) + "))")
    ctes.append(f"""
walk0 AS (SELECT sk_contrato, {columns}, tree, 0 AS node FROM feat, range({_TREES}) t(tree))""")
    for d in range(_LEVELS):
        ctes.append(f"""
walk{d + 1} AS (
  SELECT sk_contrato, {columns}, tree, CASE WHEN s.kind < 0 THEN node WHEN {_left('s.')} THEN 2 * node + 1 ELSE 2 * node + 2 END AS node
  FROM walk{d} JOIN forest s USING (tree, node))""")
    ctes.append(f"""
raw AS MATERIALIZED (
  SELECT sk_contrato, pow(2.0::DOUBLE, -(CAST(sum(length) AS DOUBLE) / {_TREES}.0::DOUBLE) / (2 * (ln(psi - 1.0::DOUBLE) + 0.5772156649015329::DOUBLE) - 2 * (psi - 1.0::DOUBLE) / psi)) AS s
  FROM walk{_LEVELS} JOIN forest USING (tree, node), (SELECT least({_PSI}, count(*)) AS psi FROM feat) GROUP BY sk_contrato, psi)""")
    ctes.append("""
scored AS MATERIALIZED (
  SELECT f.* EXCLUDE (score_anomalia), CAST(CASE WHEN hi = lo THEN 0 ELSE (s - lo) / (hi - lo) END AS DECIMAL(5,4)) AS score_anomalia
  FROM contract_star f LEFT JOIN raw USING (sk_contrato), (SELECT min(s) AS lo, max(s) AS hi FROM raw))""")
    return ctes


FOREST = [*GOLD, SQL_CONTRACT_STAR, *_forest()]
register("m5_anomaly_scores", sql(*FOREST, body="SELECT sk_contrato, ano, id_contrato_origem, score_anomalia FROM scored"))
register("o2_top_anomalies", sql(*FOREST, body="""
SELECT sk_contrato, valor_contratado, descricao_modalidade, score_anomalia FROM scored ORDER BY score_anomalia DESC, sk_contrato LIMIT 10"""))
SQL_TOP_ANOMALIES = """
SELECT f.sk_contrato, f.num_contrato, f.valor_contratado, f.score_anomalia, m.descricao_modalidade, c.nome AS nome_credor, a.nome AS nome_orgao
FROM scored f LEFT JOIN modal m USING (sk_modalidade) LEFT JOIN creditor_cur c USING (sk_credor) LEFT JOIN agency a USING (sk_orgao)
WHERE f.score_anomalia IS NOT NULL ORDER BY f.score_anomalia DESC, f.sk_contrato LIMIT 10"""
register("o3_top_anomalies_named", sql(*FOREST, body=SQL_TOP_ANOMALIES))
register("m14_heuristic_scores", sql(*FOREST, body="""
, h AS (SELECT *, descricao_modalidade IN ('1-URGENT', '2-HIGH')
                  AND CAST(valor_contratado AS DOUBLE) >= (SELECT quantile_cont(CAST(valor_contratado AS DOUBLE), 0.95) FROM scored) AS heuristica
        FROM scored)
""" + _describe("h", ["score_anomalia"], by="heuristica")))
register("a20_score_histogram", sql(*FOREST, body="""
, b AS (SELECT min(CAST(score_anomalia AS DOUBLE)) AS mn, max(CAST(score_anomalia AS DOUBLE)) AS mx FROM scored)
, h AS (SELECT least(CASE WHEN x >= mx THEN 31 ELSE CAST(floor(30 * (x - mn) / (mx - mn)) AS BIGINT) + 1 END, 30) AS bin, count(*) AS n
FROM (SELECT CAST(score_anomalia AS DOUBLE) AS x FROM scored WHERE score_anomalia IS NOT NULL), b GROUP BY 1)
SELECT r.bin, coalesce(h.n, 0) AS n FROM range(1, 31) r(bin) LEFT JOIN h ON h.bin = r.bin"""))


def _table_text(source: str, columns: list[str], order: str) -> str:
    cells = " || ' | ' || ".join(f"coalesce({c}::VARCHAR, '')" for c in columns)
    head = "| " + " | ".join(columns) + " |" + "'" + " || chr(10) || '" + "|" + "|".join(["---"] * len(columns)) + "|"
    return f"(SELECT '{head}' || chr(10) || string_agg('| ' || {cells} || ' |', chr(10) ORDER BY {order}) FROM {source})"


register("r2_report", sql(*FOREST, SQL_HISTORY, body=SQL_NAIVE + ", anom AS (" + SQL_TOP_ANOMALIES + """),
infr AS (
  SELECT dc.nome, dc.cpf_cnpj, dc.historico_infringement, count(fc.sk_contrato) AS qtd_contratos, CAST(sum(fc.valor_contratado) AS DECIMAL(18,2)) AS valor_total
  FROM creditor_cur dc JOIN contract_star fc ON fc.sk_credor = dc.sk_credor WHERE dc.historico_infringement > 0 AND dc.versao_atual
  GROUP BY dc.nome, dc.cpf_cnpj, dc.historico_infringement ORDER BY valor_total DESC, dc.cpf_cnpj LIMIT 10),
fcs AS (
  SELECT p.trimestre_referencia, a.nome AS nome_orgao, p.valor_previsto, p.intervalo_inferior, p.intervalo_superior, p.modelo, p.sk_orgao
  FROM naive p JOIN agency a USING (sk_orgao) ORDER BY p.valor_previsto DESC, p.sk_orgao LIMIT 15),
total AS (
  SELECT coalesce(sum(valor_contratado), 0) AS c, coalesce(sum(valor_pago), 0) AS p, count(*) FILTER (WHERE valor_pago > valor_contratado) AS n,
    round(coalesce(CAST(sum(valor_pago) AS DOUBLE) * 100.0 / nullif(CAST(sum(valor_contratado) AS DOUBLE), 0), 0), 4) AS pct FROM contract_star)
SELECT 'Relatório de Insights (2026-07-23)' AS titulo,
  '## Rastreabilidade Financeira' || chr(10) || 'Do total contratado de R$ ' || format('{:,.2f}', c::DOUBLE) || ', R$ ' || format('{:,.2f}', p::DOUBLE)
  || ' já foram efetivamente pagos (' || printf('%.1f', pct) || '%). Foram identificados ' || n
  || ' contratos com pagamentos acima do valor originalmente contratado — recomenda-se auditoria pontual.' || chr(10) || chr(10)
  || '## Contratos com Padrões Anômalos' || chr(10) || """
    + _table_text("anom", ["sk_contrato", "num_contrato", "valor_contratado", "score_anomalia", "descricao_modalidade", "nome_credor", "nome_orgao"], "score_anomalia DESC, sk_contrato")
    + """ || chr(10) || chr(10) || '## Credores com Histórico de Infrações' || chr(10) || coalesce("""
    + _table_text("infr", ["nome", "cpf_cnpj", "historico_infringement", "qtd_contratos", "valor_total"], "valor_total DESC, cpf_cnpj")
    + """, 'Nenhum credor com histórico de infração encontrado.') || chr(10) || chr(10) || '## Previsão de Pagamentos do Próximo Trimestre' || chr(10) || """
    + _table_text("fcs", ["trimestre_referencia", "nome_orgao", "valor_previsto", "intervalo_inferior", "intervalo_superior", "modelo"], "valor_previsto DESC, sk_orgao")
    + """ || chr(10) || chr(10) || array_to_string([
    '## Recomendações', '1. Auditar prioritariamente os contratos no topo do ranking de anomalias.',
    '2. Revisar processos de contratação de credores com histórico de infração.', '3. Reservar orçamento conforme as previsões trimestrais por órgão.',
    '4. Investigar contratos com pagamento acima do valor contratado.', '', '_Relatório gerado por template determinístico._'], chr(10)) AS conteudo_markdown
FROM total"""))


# --------------------------------------------------------------------------- #
# Quantile boosting: a round is a step of a recursive query over all rows
# --------------------------------------------------------------------------- #
#: The forecast model's features, quantiles, rounds, rate.
_BOOST_FEATURES = ["trimestre", "ano_eleitoral", "valor_lag1", "valor_mesmo_trimestre_ano_anterior", "valor_contratado_acumulado", "sequencial_trimestre"]
_ALPHAS, _ROUNDS, _RATE = (0.1, 0.5, 0.9), 150, 0.1


def _boost_rows(source: str, label: str, train: str) -> str:
    columns = ", ".join(f"CAST({c} AS DOUBLE) AS x{j}" for j, c in enumerate(_BOOST_FEATURES))
    return f"SELECT codigo_orgao, {label} AS y, {train} AS train, {columns} FROM {source}"


def _level(before: str, name: str) -> str:
    """Best splits of the open nodes of ``before`` and the rows below them as ``name``."""
    part = lambda c, p: f"(CASE WHEN {c} > 0 THEN ({p} - (1.0::DOUBLE - alpha) * {c}) * ({p} - (1.0::DOUBLE - alpha) * {c}) / {c} ELSE 0 END)"
    feature = " ".join(f"WHEN {j} THEN x{j}" for j in range(len(_BOOST_FEATURES)))
    return f"""
{name}_cells AS (
  SELECT alpha, node, f, CASE f {feature} END AS x, count(*) AS n, sum((res > 0)::INTEGER) AS p
  FROM {before}, range({len(_BOOST_FEATURES)}) t(f) WHERE train AND open GROUP BY ALL),
{name}_runs AS (
  SELECT *, sum(n) OVER (PARTITION BY alpha, node, f ORDER BY x) AS cn, sum(p) OVER (PARTITION BY alpha, node, f ORDER BY x) AS cp,
    sum(n) OVER (PARTITION BY alpha, node, f) AS tn, sum(p) OVER (PARTITION BY alpha, node, f) AS tp FROM {name}_cells),
{name}_gains AS (
  SELECT alpha, node, f, x, {part('cn', 'cp')} + {part('(tn - cn)', '(tp - cp)')} - {part('tn', 'tp')} AS gain FROM {name}_runs WHERE cn < tn),
{name}_best AS (
  SELECT alpha, node, arg_max({{'f': f, 'x': x}}, row(gain, -f, -x)) AS s FROM {name}_gains WHERE gain > 1e-12 GROUP BY alpha, node),
{name} AS (
  SELECT b.* EXCLUDE (node, open), open AND s IS NOT NULL AS open,
    CASE WHEN open AND s IS NOT NULL THEN CASE WHEN (CASE s.f {feature} END) <= s.x THEN 2 * b.node + 1 ELSE 2 * b.node + 2 END ELSE b.node END AS node
  FROM {before} b LEFT JOIN {name}_best USING (alpha, node))"""


def boost_sql(rows: str, rounds: int = _ROUNDS) -> str:
    """CTE ``boosted``: the rows of the CTE ``rows`` with p10, p50 and p90 from the model of its training rows."""
    alphas = ", ".join(f"({a}::DOUBLE)" for a in _ALPHAS)
    quantile = lambda v: f"""list_extract(list({v} ORDER BY {v}), CAST(floor((count(*) - 1) * any_value(alpha)) AS BIGINT) + 1) AS lo,
    list_extract(list({v} ORDER BY {v}), CAST(ceil((count(*) - 1) * any_value(alpha)) AS BIGINT) + 1) AS hi, (count(*) - 1) * any_value(alpha) AS pos"""  # noqa: E731
    middle = "CASE WHEN floor(pos) = ceil(pos) THEN lo ELSE (ceil(pos) - pos) * lo + (pos - floor(pos)) * hi END"
    xs = ", ".join(f"x{j}" for j in range(len(_BOOST_FEATURES)))
    return f"""
alphas AS (SELECT * FROM (VALUES {alphas}) v(alpha)),
base AS (SELECT alpha, {quantile('y')} FROM {rows}, alphas WHERE train GROUP BY alpha),
boost AS (
  SELECT 0 AS round, alpha, id, y, train, {xs}, {middle} AS pred FROM (SELECT row_number() OVER () AS id, * FROM {rows}), base
  UNION ALL (
  WITH l0 AS (SELECT *, y - pred AS res, 0 AS node, true AS open FROM boost WHERE round < {rounds}),{_level('l0', 'l1')},{_level('l1', 'l2')},{_level('l2', 'l3')},
  leaf AS (SELECT alpha, node, {middle} AS leaf FROM (SELECT alpha, node, {quantile('res')} FROM l3 WHERE train GROUP BY alpha, node))
  SELECT round + 1, alpha, id, y, train, {xs}, pred + {_RATE}::DOUBLE * leaf FROM l3 JOIN leaf USING (alpha, node))),
boosted AS (
  SELECT r.*, p10, p50, p90 FROM (SELECT row_number() OVER () AS id, * FROM {rows}) r
  JOIN (SELECT id, max(pred) FILTER (alpha = 0.1) AS p10, max(pred) FILTER (alpha = 0.5) AS p50, max(pred) FILTER (alpha = 0.9) AS p90
        FROM boost WHERE round = {rounds} GROUP BY id) USING (id))"""


def _recursive(*ctes: str, body: str) -> str:
    return sql(*ctes, body=body).replace("WITH ", "WITH RECURSIVE ", 1)


SQL_NEXT = """
last_feature AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY codigo_orgao ORDER BY ano DESC, trimestre DESC) AS rn,
                   count(*) OVER (PARTITION BY codigo_orgao) AS n_quarters FROM features) WHERE rn = 1),
next_rows AS (
  SELECT l.codigo_orgao, l.sk_orgao, n_quarters, l.valor_total, 4 AS trimestre, 1 AS ano_eleitoral, l.valor_total AS valor_lag1,
    coalesce(y.valor_total, l.valor_total) AS valor_mesmo_trimestre_ano_anterior, l.valor_contratado_acumulado, 2026 * 4 + 4 AS sequencial_trimestre
  FROM last_feature l LEFT JOIN (SELECT codigo_orgao, valor_total FROM features WHERE ano = 2025 AND trimestre = 4) y USING (codigo_orgao))"""
_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in _BOOST_FEATURES)
register("m12_forecast", _recursive(
    *BASE_FEATURES, SQL_NEXT,
    "sent AS MATERIALIZED (" + _boost_rows("(SELECT *, count(*) OVER (PARTITION BY codigo_orgao) AS n_quarters FROM features)", "CAST(valor_total AS DOUBLE)", "true")
    + f" WHERE n_quarters >= 5 AND {_COMPLETE} UNION ALL " + _boost_rows("next_rows", "NULL::DOUBLE", "false") + " WHERE n_quarters >= 5)",
    boost_sql("sent"), body="""
, p AS (
  SELECT n.codigo_orgao, n.sk_orgao, CASE WHEN n_quarters >= 5 THEN 'quantile_boost' ELSE 'naive_persistence' END AS modelo,
    CASE WHEN n_quarters >= 5 THEN CAST(p10 AS DECIMAL(18,2)) ELSE CAST(valor_total * 0.7 AS DECIMAL(18,2)) END AS p10,
    CASE WHEN n_quarters >= 5 THEN CAST(p50 AS DECIMAL(18,2)) ELSE CAST(valor_total AS DECIMAL(18,2)) END AS p50,
    CASE WHEN n_quarters >= 5 THEN CAST(p90 AS DECIMAL(18,2)) ELSE CAST(valor_total * 1.3 AS DECIMAL(18,2)) END AS p90
  FROM next_rows n LEFT JOIN (SELECT * FROM boosted WHERE NOT train) b USING (codigo_orgao))
SELECT codigo_orgao, sk_orgao, '2026-Q4' AS trimestre_referencia, modelo, CAST(greatest(p50, 0) AS DECIMAL(18,2)) AS valor_previsto,
  CAST(greatest(least(p10, p50), 0) AS DECIMAL(18,2)) AS intervalo_inferior, CAST(greatest(p90, p50, 0) AS DECIMAL(18,2)) AS intervalo_superior FROM p"""))
register("m13_backtest", _recursive(
    *BASE_FEATURES, SQL_HOLDOUT.strip().lstrip(","),
    "sent AS MATERIALIZED (" + _boost_rows("holdout", "CAST(valor_total AS DOUBLE)", "fold = 'train'") + ")", boost_sql("sent"), body="""
SELECT count(*) AS n, round(avg(abs(y - p50)), 6) AS mae, round(avg(abs(y - p50) / nullif(y, 0.0)), 6) AS mape,
  round(avg(CAST(y BETWEEN p10 AND p90 AS DOUBLE)), 6) AS coverage FROM boosted WHERE NOT train"""))

register("g12_null_key_loads", sql(SQL_CONTRACTS, SQL_CONTRACT_FACT, body="""
, old AS (
  SELECT id_contrato_origem, ano, row_number() OVER (ORDER BY id_contrato_origem, ano) AS sk_contrato, status FROM contract_fact WHERE data_assinatura < DATE '1999-01-01'),
fresh AS (SELECT id_contrato_origem, ano, valor_contratado, status FROM contract_fact WHERE status <> 'P')
SELECT o.id_contrato_origem, o.ano, coalesce(f.valor_contratado, CAST(0 AS DECIMAL(18,2))) AS valor_contratado, o.status, o.sk_contrato
FROM old o LEFT JOIN fresh f USING (id_contrato_origem, ano)
UNION ALL
SELECT f.id_contrato_origem, f.ano, f.valor_contratado, f.status, (SELECT max(sk_contrato) FROM old) + row_number() OVER (ORDER BY f.id_contrato_origem, f.ano)
FROM fresh f ANTI JOIN old o USING (id_contrato_origem, ano)"""))
