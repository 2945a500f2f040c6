"""Spending entities over the driver's TPC-H-like tables, and their DuckDB oracle CTEs.

Mapping (fixed for this repo):

* contracts   <- ``orders`` x ``customer``: id = o_orderkey, signed = o_orderdate, creditor =
  the customer, agency = customer nation, modality = o_orderpriority, type = o_orderstatus
  with 'P' read as missing, value = o_totalprice; paid / committed = sums of the order's
  line prices (final lines / all lines).
* commitments <- ``lineitem``: id = l_orderkey*100 + l_linenumber, fiscal year = ship year,
  unit = l_suppkey, value = l_extendedprice. Keys repeat, so the latest-version rule applies.
* payments    <- ``lineitem`` lines with l_linestatus = 'F', same ids.
* units       <- one snapshot row per (supplier, ship year); a unit moves to the next nation
  from 1998 on, so the latest-year mapping matters.

The Spark builders produce raw text where the reference's sources carry text and clean it
with the library's column functions; the SQL CTEs state the cleaned result directly, so the
oracle comparison checks the cleaning too.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.functions import only_digits, parse_num, parse_ts
from spendlake.operators.dedupe import dedupe_latest
from spendlake.operators.joins import lookup_join, small

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --------------------------------------------------------------------------- #
# Spark side
# --------------------------------------------------------------------------- #
def contract_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paid and committed sums per order (partial aggregation before the shuffle)."""
    li = read(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return li.groupBy("l_orderkey").agg(
        F.sum(F.when(F.col("l_linestatus") == "F", price)).cast("decimal(18,2)").alias("paid"),
        F.sum(price).cast("decimal(18,2)").alias("committed"),
    )


LINE_SUMS = ("calculated_valor_empenhado", "calculated_valor_pago")


def raw_contracts(spark: SparkSession, sf_dir: str, cols=None) -> DataFrame:
    """Contract records as the paged API would deliver them (text values).

    ``cols`` (None: all) says what the caller needs: lines are read and summed only for their sums."""
    o = read(spark, sf_dir, "orders")
    c = read(spark, sf_dir, "customer")
    oc = lookup_join(o, small(c), on=[("o_custkey", "c_custkey")],
                     take={"c_name": "c_name", "c_nationkey": "c_nationkey",
                           "c_acctbal": "c_acctbal", "c_mktsegment": "c_mktsegment"})
    if cols is None or set(cols) & set(LINE_SUMS):
        lines = contract_lines(spark, sf_dir)
        oc = oc.join(lines, oc["o_orderkey"] == lines["l_orderkey"], "left").drop("l_orderkey")
        sums = {"calculated_valor_empenhado": F.col("committed"), "calculated_valor_pago": F.col("paid")}
    else:
        sums = {}
    nation = F.col("c_nationkey").cast("string")
    return oc.select(
        F.col("o_orderkey").alias("id"),
        F.lpad(F.col("o_orderkey").cast("string"), 10, "0").alias("num_contrato"),
        F.col("o_orderdate").cast("string").alias("data_assinatura"),
        F.col("o_orderdate").cast("string").alias("data_inicio"),
        F.timestamp_add("SECOND", F.floor("o_totalprice").cast("long") - F.lit(250000),
                        F.col("o_orderdate")).cast("string").alias("data_termino"),
        F.concat_ws("", F.col("c_name"), F.lit("/"), nation, F.lit("-"), nation).alias("cpf_cnpj_financiador"),
        F.concat_ws(" ", F.col("c_name"), F.substring("o_orderpriority", 3, 100)).alias("descricao_nome_credor"),
        ((F.col("c_acctbal") < 0).cast("int") + (F.col("o_totalprice") > 400000).cast("int"))
        .alias("infringement_status"),
        nation.alias("cod_orgao"),
        F.col("o_orderpriority").alias("descricao_modalidade"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("descricao_tipo"),
        F.col("o_totalprice").cast("string").alias("valor_contrato"),
        *[value.cast("string").alias(name) for name, value in sums.items()],
        F.col("o_orderstatus").alias("descricao_situacao"),
        F.col("c_mktsegment").alias("tipo_objeto"),
        (F.col("o_orderpriority") == "1-URGENT").cast("string").alias("emergency"),
        F.col("o_orderdate").cast("string").alias("updated_at"),
    )


def _project(raw: DataFrame, cols, always) -> DataFrame:
    """Keep only the needed columns before the latest-version dedupe: the dedupe packs the
    row into one aggregate value, which the optimizer cannot prune afterwards."""
    if cols is None:
        return raw
    keep = [c for c in raw.columns if c in set(cols) | set(always)]
    return raw.select(*keep)


CONTRACT_DEDUPE = ("id", "updated_at", "data_assinatura", "valor_contrato")
EVENT_DEDUPE = ("id", "ano", "updated_at", "dataemissao", "valor", "codigoug")
UNIT_DEDUPE = ("codigo", "ano", "updated_at", "codigoorgao", "titulo")


def contracts(spark: SparkSession, sf_dir: str, cols=None) -> DataFrame:
    """Silver contracts: parsed dates, digits-only documents, tolerant numbers, latest per id.

    ``cols`` restricts the output to what the caller needs (plus the dedupe columns)."""
    from spendlake.operators.clean import clean_contracts
    return clean_contracts(_project(raw_contracts(spark, sf_dir, cols), cols, CONTRACT_DEDUPE))


def _supplier_code(key: str):
    """``Supplier#%09d``; the formatter, dear for each line, is called for numbers of other lengths alone."""
    k = F.col(key)
    return F.when(k.between(0, 999_999_999), F.concat(F.lit("Supplier#"), F.lpad(k.cast("string"), 9, "0"))).otherwise(F.format_string("Supplier#%09d", k))


def _line_events(li: DataFrame, prefix: str) -> DataFrame:
    year = F.year("l_shipdate")
    return li.select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id"),
        year.alias("ano"),
        F.concat(year.cast("string"), F.lit(prefix), F.col("l_orderkey").cast("string"),
                 F.lit("-"), F.col("l_linenumber").cast("string")).alias("codigo"),
        F.col("l_suppkey").cast("string").alias("codigoug"),
        _supplier_code("l_suppkey").alias("codigocredor"),
        _supplier_code("l_suppkey").alias("nomecredor"),
        F.col("l_extendedprice").cast("string").alias("valor"),
        F.col("l_shipdate").cast("string").alias("dataemissao"),
        F.when(F.col("l_returnflag") != "N", F.col("l_shipdate")).cast("string").alias("updated_at"),
        F.when(F.col("l_linenumber") == 1, F.lit("0000000000"))
        .otherwise(F.lpad(F.col("l_orderkey").cast("string"), 10, "0")).alias("codcontrato"),
        F.col("l_returnflag").alias("modalidade"),
    )


def raw_commitments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_events(read(spark, sf_dir, "lineitem"), "NE")


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").filter(F.col("l_linestatus") == "F")
    return _line_events(li, "OB").withColumnRenamed("modalidade", "tipoob").drop("codcontrato")


def commitments(spark: SparkSession, sf_dir: str, cols=None, keep=None) -> DataFrame:
    """Silver commitments. ``cols`` restricts what the latest version is chosen from, ``keep`` what is
    kept of it (besides the keys): all columns still decide a tie."""
    from spendlake.operators.clean import clean_events
    return clean_events(_project(raw_commitments(spark, sf_dir), cols, EVENT_DEDUPE), keep=keep)


def payments(spark: SparkSession, sf_dir: str, cols=None, keep=None) -> DataFrame:
    """Silver payments; ``cols`` and ``keep`` as for commitments."""
    from spendlake.operators.clean import clean_events
    return clean_events(_project(raw_payments(spark, sf_dir), cols, EVENT_DEDUPE), keep=keep)


def raw_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    s = read(spark, sf_dir, "supplier")
    uy = li.select(F.col("l_suppkey"), F.year("l_shipdate").alias("ano")).distinct()
    u = lookup_join(uy, s, on=[("l_suppkey", "s_suppkey")],
                    take={"s_nationkey": "s_nationkey", "s_acctbal": "s_acctbal"}, how="inner")
    parent = F.when(F.col("ano") >= 1998, (F.col("s_nationkey") + 1) % 25).otherwise(F.col("s_nationkey"))
    return u.select(
        F.col("l_suppkey").cast("string").alias("codigo"),
        F.col("ano"),
        F.concat(F.lit("UG "), F.col("l_suppkey").cast("string")).alias("titulo"),
        F.when(F.col("s_acctbal") >= 0,
               F.format_string("%02d.%03d.%03d/0001-%02d", F.col("s_nationkey"), F.col("l_suppkey"),
                               F.col("ano") - 1900, F.col("s_nationkey"))).alias("cnpj"),
        parent.cast("string").alias("codigoorgao"),
        F.when(F.col("s_acctbal") < 0, F.lit("INDIRETA")).otherwise(F.lit("DIRETA")).alias("tipoadministracao"),
        F.when(F.col("s_nationkey") < 5, F.lit("JUDICIARIO")).otherwise(F.lit("EXECUTIVO")).alias("nomepoder"),
        F.concat(F.col("ano").cast("string"), F.lit("-01-01")).alias("created_at"),
        F.concat(F.col("ano").cast("string"), F.lit("-01-01")).alias("updated_at"),
    )


def units(spark: SparkSession, sf_dir: str, cols=None) -> DataFrame:
    from spendlake.operators.clean import clean_units
    return clean_units(_project(raw_units(spark, sf_dir), cols, UNIT_DEDUPE))


# --------------------------------------------------------------------------- #
# Oracle side (DuckDB SQL). Each constant is a WITH-list body that defines the same
# cleaned entity the Spark builder returns.
# --------------------------------------------------------------------------- #
SQL_CONTRACT_LINES = """
contract_lines AS (
  SELECT l_orderkey,
         CAST(SUM(CASE WHEN l_linestatus = 'F' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DECIMAL(18,2)) AS paid,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS committed
  FROM lineitem GROUP BY l_orderkey)"""

SQL_CONTRACTS = SQL_CONTRACT_LINES + """,
contracts AS (
  SELECT o.o_orderkey AS id,
         lpad(CAST(o.o_orderkey AS VARCHAR), 10, '0') AS num_contrato,
         o.o_orderdate AS data_assinatura,
         o.o_orderdate AS data_inicio,
         o.o_orderdate + to_seconds(CAST(floor(o.o_totalprice) AS BIGINT) - 250000) AS data_termino,
         regexp_replace(c.c_name || '/' || CAST(c.c_nationkey AS VARCHAR) || '-' || CAST(c.c_nationkey AS VARCHAR), '[^0-9]', '', 'g') AS cpf_cnpj_financiador,
         c.c_name || ' ' || substr(o.o_orderpriority, 3, 100) AS descricao_nome_credor,
         CAST(c.c_acctbal < 0 AS INTEGER) + CAST(o.o_totalprice > 400000 AS INTEGER) AS infringement_status,
         CAST(c.c_nationkey AS VARCHAR) AS cod_orgao,
         o.o_orderpriority AS descricao_modalidade,
         nullif(o.o_orderstatus, 'P') AS descricao_tipo,
         o.o_totalprice AS valor_contrato,
         coalesce(CAST(cl.committed AS DOUBLE), 0.0) AS calculated_valor_empenhado,
         coalesce(CAST(cl.paid AS DOUBLE), 0.0) AS calculated_valor_pago,
         o.o_orderstatus AS descricao_situacao,
         c.c_mktsegment AS tipo_objeto,
         o.o_orderpriority = '1-URGENT' AS emergency,
         o.o_orderdate AS updated_at
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN contract_lines cl ON cl.l_orderkey = o.o_orderkey)"""


def _sql_line_events(name: str, prefix: str, where: str, tail: str) -> str:
    return f"""
{name}_raw AS (
  SELECT l_orderkey * 100 + l_linenumber AS id,
         CAST(year(l_shipdate) AS INTEGER) AS ano,
         CAST(year(l_shipdate) AS VARCHAR) || '{prefix}' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS codigo,
         CAST(l_suppkey AS VARCHAR) AS codigoug,
         lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS codigocredor,
         'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS nomecredor,
         l_extendedprice AS valor,
         l_shipdate AS dataemissao,
         CASE WHEN l_returnflag <> 'N' THEN l_shipdate END AS updated_at{tail}
  FROM lineitem {where}),
{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id, ano ORDER BY updated_at DESC NULLS FIRST,
                                 dataemissao DESC, valor DESC, codigoug DESC) AS rn
    FROM {name}_raw) WHERE rn = 1)"""


SQL_COMMITMENTS = _sql_line_events(
    "commitments", "NE", "",
    """,
         CASE WHEN l_linenumber = 1 THEN '0000000000' ELSE lpad(CAST(l_orderkey AS VARCHAR), 10, '0') END AS codcontrato,
         l_returnflag AS modalidade""")

SQL_PAYMENTS = _sql_line_events("payments", "OB", "WHERE l_linestatus = 'F'", """,
         l_returnflag AS tipoob""")

SQL_UNITS = """
units AS (
  SELECT CAST(uy.l_suppkey AS VARCHAR) AS codigo,
         uy.ano,
         'UG ' || CAST(uy.l_suppkey AS VARCHAR) AS titulo,
         CASE WHEN s.s_acctbal >= 0 THEN
           regexp_replace(printf('%02d.%03d.%03d/0001-%02d', s.s_nationkey, uy.l_suppkey, uy.ano - 1900, s.s_nationkey), '[^0-9]', '', 'g')
         END AS cnpj,
         CAST(CASE WHEN uy.ano >= 1998 THEN (s.s_nationkey + 1) % 25 ELSE s.s_nationkey END AS VARCHAR) AS codigoorgao,
         CASE WHEN s.s_acctbal < 0 THEN 'INDIRETA' ELSE 'DIRETA' END AS tipoadministracao,
         CASE WHEN s.s_nationkey < 5 THEN 'JUDICIARIO' ELSE 'EXECUTIVO' END AS nomepoder,
         CAST(CAST(uy.ano AS VARCHAR) || '-01-01' AS TIMESTAMP) AS created_at,
         CAST(CAST(uy.ano AS VARCHAR) || '-01-01' AS TIMESTAMP) AS updated_at
  FROM (SELECT DISTINCT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS ano FROM lineitem) uy
  JOIN supplier s ON s.s_suppkey = uy.l_suppkey)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes) + "\n"
