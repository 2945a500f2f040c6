"""Fact builders on business keys (surrogate keys are resolved later by lookup joins)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.functions import days_between, parse_bool, parse_num, to_money
from spendlake.operators.columns import ensure_columns
from spendlake.operators.joins import lookup_join

CONTRACT_OPTIONAL = {
    "num_contrato": ("string", None),
    "calculated_valor_empenhado": ("double", 0.0),
    "calculated_valor_pago": ("double", 0.0),
    "descricao_situacao": ("string", None),
    "tipo_objeto": ("string", None),
    "emergency": ("string", None),
    "infringement_status": ("string", None),
}


def contract_fact(contracts: DataFrame) -> DataFrame:
    """Contract fact: one row per (contract id, signing year)."""
    c = ensure_columns(contracts, CONTRACT_OPTIONAL)
    return c.select(
        F.col("id").cast("long").alias("id_contrato_origem"),
        F.col("num_contrato"),
        F.col("data_assinatura").cast("date").alias("data_assinatura"),
        F.col("cpf_cnpj_financiador").alias("cpf_cnpj"),
        F.col("cod_orgao").alias("codigo_orgao"),
        F.col("descricao_modalidade"),
        F.col("descricao_tipo"),
        to_money("valor_contrato").alias("valor_contratado"),
        to_money(parse_num("calculated_valor_empenhado")).alias("valor_empenhado"),
        to_money(parse_num("calculated_valor_pago")).alias("valor_pago"),
        F.col("descricao_situacao").alias("status"),
        F.col("tipo_objeto"),
        parse_bool("emergency").alias("flag_emergency"),
        days_between("data_termino", "data_inicio").alias("dias_vigencia"),
        F.coalesce(F.col("infringement_status").try_cast("int"), F.lit(0)).alias("historico_credor_infringement"),
        F.year("data_assinatura").alias("ano"),
    ).dropna(subset=["id_contrato_origem", "ano"])


def unit_fact(events: DataFrame, unit_map: DataFrame, id_col: str, code_col: str,
              extra: dict[str, str], sk: str | None = None) -> DataFrame:
    """Commitment / payment fact: unit rolled up to its agency by the latest mapping (``sk``: a key the
    events have already)."""
    df = lookup_join(events, unit_map, on=[("codigoug", "codigo_ug")], take={"codigo_orgao": "codigo_orgao"})
    return df.select(
        F.col("id").cast("long").alias(id_col),
        F.col("codigo").alias(code_col),
        F.col("dataemissao").cast("date").alias("data_emissao"),
        F.col("codigo_orgao"),
        F.col("codigocredor").alias("cpf_cnpj"),
        *[F.col(src).alias(dst) for src, dst in extra.items()],
        to_money("valor").alias("valor"),
        F.col("ano").cast("int").alias("ano"),
        *([sk] if sk else []),
    ).dropna(subset=[id_col, "ano"])


def commitment_fact(commitments: DataFrame, unit_map: DataFrame, sk: str | None = None) -> DataFrame:
    c = ensure_columns(commitments, {"codcontrato": ("string", None), "modalidade": ("string", None)})
    return unit_fact(c, unit_map, "id_empenho_origem", "codigo_empenho",
                     {"codcontrato": "codcontrato", "modalidade": "modalidade"}, sk)


def payment_fact(payments: DataFrame, unit_map: DataFrame, sk: str | None = None) -> DataFrame:
    p = ensure_columns(payments, {"tipoob": ("string", None)})
    return unit_fact(p, unit_map, "id_ob_origem", "codigo", {"tipoob": "tipo_ob"}, sk)


def link_commitments_to_contracts(fact_commitment: DataFrame, contracts: DataFrame,
                                  code: str = "codcontrato", number: str = "num_contrato",
                                  key: str = "sk_contrato", order: str = "data_assinatura") -> DataFrame:
    """Resolve a commitment's contract number to the contract key.

    An all-zero number means "no contract". Contract numbers are de-duplicated first (the
    latest signing wins) so the lookup stays many-to-one.
    """
    from spendlake.operators.dedupe import last_per_key

    nums = last_per_key(contracts.select(number, order, key).dropna(subset=[number]), [number], [order], tie=[key])
    none = F.col(code).isNull() | F.regexp_like(F.col(code), F.lit("^0+$"))
    # rows without a number have nothing to look up; in the join they would all meet in one task
    linked = lookup_join(fact_commitment.filter(~none), nums, on=[(code, number)], take={key: key})
    rest = fact_commitment.filter(none).withColumn(key, F.lit(None).cast(contracts.schema[key].dataType))
    return linked.unionByName(rest)
