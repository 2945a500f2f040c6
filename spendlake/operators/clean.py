"""Bronze -> Silver cleaning per entity: tolerant typing, documents, latest version, enrichment."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.functions import only_digits, parse_num, parse_ts
from spendlake.operators.columns import drop_if_present
from spendlake.operators.dedupe import dedupe_latest
from spendlake.operators.joins import lookup_join

EVENT_DATES = ["dataemissao", "datacancelamento", "datacontabilizacao", "created_at", "updated_at"]
CONTRACT_DATES = ["data_assinatura", "data_inicio", "data_termino", "data_publicacao_portal",
                  "data_rescisao", "created_at", "updated_at"]


def parse_dates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Parse the listed columns that exist to naive timestamps (see ``parse_ts``)."""
    out = df
    for c in cols:
        if c in out.columns:
            out = out.withColumn(c, parse_ts(c))
    return out


def clean_events(df: DataFrame, keys: Sequence[str] = ("id", "ano"),
                 tie: Sequence[str] = ("dataemissao", "valor", "codigoug"), keep: Sequence[str] | None = None) -> DataFrame:
    """Commitments and payments: dates, creditor document, value (junk -> 0), latest per key.

    ``keep``: the columns wanted besides the keys (see ``dedupe_latest``)."""
    out = parse_dates(df, EVENT_DATES)
    if "codigocredor" in out.columns:
        out = out.withColumn("codigocredor", only_digits("codigocredor"))
    out = out.withColumn("valor", parse_num("valor"))
    return dedupe_latest(out, list(keys), "updated_at", tie=[t for t in tie if t in out.columns], keep=keep)


def clean_units(df: DataFrame) -> DataFrame:
    out = parse_dates(df, ["created_at", "updated_at"])
    if "cnpj" in out.columns:
        out = out.withColumn("cnpj", only_digits("cnpj"))
    return dedupe_latest(out, ["codigo", "ano"], "updated_at", tie=["codigoorgao", "titulo"])


def clean_contracts(df: DataFrame) -> DataFrame:
    out = parse_dates(df, CONTRACT_DATES)
    if "cpf_cnpj_financiador" in out.columns:
        out = out.withColumn("cpf_cnpj_financiador", only_digits("cpf_cnpj_financiador"))
    for c in ("valor_contrato", "calculated_valor_pago", "calculated_valor_empenhado"):
        if c in out.columns:
            out = out.withColumn(c, parse_num(c))
    if "emergency" in out.columns:
        out = out.withColumn("emergency", F.col("emergency").cast("string").try_cast("boolean"))
    if "infringement_status" in out.columns:
        out = out.withColumn("infringement_status", F.col("infringement_status").cast("string").try_cast("int"))
    return dedupe_latest(out, ["id"], "updated_at", tie=["data_assinatura", "valor_contrato"])


def enrich_with_units(events: DataFrame, units: DataFrame) -> DataFrame:
    """Commitments x unit snapshot on (unit code, year): adds ``nome_ug`` and ``cnpj_ug``.

    The unit's key columns never leak into the result, so the event's own ``codigo``
    (its document number) survives.
    """
    out = lookup_join(events, units, on=[("codigoug", "codigo"), ("ano", "ano")],
                      take={"titulo": "nome_ug", "cnpj": "cnpj_ug"})
    return drop_if_present(out, "codigo_ug")
