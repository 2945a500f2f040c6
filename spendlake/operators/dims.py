"""Dimension builders: calendar, agency (mode + head-office patch), modality, creditor."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.functions import day_name_pt, month_name_pt, person_type, year_month
from spendlake.operators.dedupe import first_per_key
from spendlake.operators.joins import patch_join


def distinct_days(*cols: tuple[DataFrame, str]) -> DataFrame:
    """Distinct calendar days (``data``) over several (DataFrame, timestamp column) pairs."""
    parts = [df.select(F.col(c).cast("date").alias("data")) for df, c in cols]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.dropna().distinct()


def calendar_attributes(days: DataFrame, col: str = "data") -> DataFrame:
    d = F.col(col)
    return days.select(
        d.alias("data"),
        F.year(d).alias("ano"),
        F.quarter(d).alias("trimestre"),
        F.month(d).alias("mes"),
        F.dayofmonth(d).alias("dia"),
        F.weekday(d).alias("dia_semana"),
        day_name_pt(d).alias("nome_dia_semana"),
        month_name_pt(d).alias("nome_mes"),
        year_month(d).alias("ano_mes"),
    )


def calendar_dim(*cols: tuple[DataFrame, str]) -> DataFrame:
    """Calendar dimension over the distinct days of the given timestamp columns."""
    return calendar_attributes(distinct_days(*cols))


def mode_by_group(df: DataFrame, key: str, attrs: dict[str, str]) -> DataFrame:
    """Most frequent non-null value per group for each ``attr -> alias``; ties give the
    smallest value, an all-null group gives null.

    Two aggregations, both combined map-side: occurrences per (group, attribute, value),
    then per (group, attribute) the value with the largest count (``min_by`` over
    ``(-count, value)``); a final pivot puts attributes back in columns. No reducer ever
    holds a group's distinct values, however large the group. Attributes of one type are
    stacked so all modes share the same two aggregations.
    """
    names = list(attrs)
    types = {df.schema[a].dataType.simpleString() for a in names}
    if len(types) > 1:
        # mixed types: one stack per type keeps each value's own ordering
        out = df.select(key).distinct()
        for t in sorted(types):
            sub = {a: al for a, al in attrs.items() if df.schema[a].dataType.simpleString() == t}
            out = out.join(mode_by_group(df, key, sub), key, "left")
        return out.select(key, *attrs.values())
    stacked = df.select(key, F.explode(F.array(*[
        F.struct(F.lit(i).alias("a"), F.col(a).alias("v")) for i, a in enumerate(names)])).alias("__s")) \
        .select(key, F.col("__s.a").alias("__a"), F.col("__s.v").alias("__v"))
    counts = stacked.groupBy(key, "__a", "__v").agg(F.count("__v").alias("__c"))
    best = counts.groupBy(key, "__a").agg(
        F.min_by("__v", F.struct((-F.col("__c")).alias("c"), F.col("__v").alias("v"))).alias("__m"))
    return best.groupBy(key).agg(*[F.max(F.when(F.col("__a") == i, F.col("__m"))).alias(attrs[a])
                                   for i, a in enumerate(names)])


def agency_dim(units: DataFrame, code: str = "codigo", parent: str = "codigoorgao",
               attrs: dict[str, str] | None = None, order: Sequence[str] = ("updated_at", "ano"),
               out_key: str = "codigo_orgao") -> DataFrame:
    """Agency dimension at parent grain.

    Each attribute is the mode over the agency's units, then overwritten — value by value,
    nulls ignored — by the head-office unit (the unit whose own code equals the agency
    code); with several head-office rows the earliest by ``order`` is used.
    """
    attrs = attrs or {"titulo": "nome", "cnpj": "cnpj", "tipoadministracao": "tipo_administracao",
                      "nomepoder": "esfera"}
    ug = units.dropna(subset=[parent])
    fallback = mode_by_group(ug, parent, attrs)
    order = [o for o in order if o in ug.columns]
    head = ug.filter(F.col(code) == F.col(parent)).select(parent, *order, *attrs.keys())
    head = first_per_key(head, [parent], order, tie=list(attrs.keys()))
    head = head.select(parent, *[F.col(a).alias(al) for a, al in attrs.items()])
    dim = patch_join(fallback, head, parent, list(attrs.values()))
    return dim.withColumnRenamed(parent, out_key)


def modality_dim(contracts: DataFrame, modality: str = "descricao_modalidade",
                 kind: str = "descricao_tipo") -> DataFrame:
    """Distinct (modality, type) pairs with a non-null modality; a null type is one value."""
    return contracts.select(modality, kind).dropna(subset=[modality]).distinct()


def creditor_dim(contracts: DataFrame, commitments: DataFrame,
                 c_doc: str = "cpf_cnpj_financiador", c_name: str = "descricao_nome_credor",
                 c_hist: str = "infringement_status", e_doc: str = "codigocredor",
                 e_name: str = "nomecredor") -> DataFrame:
    """Creditors of contracts and commitments, one row per document.

    ``historico_infringement`` is the max infractions count (commitments count 0); the name
    is the non-null name of the row with the most infractions, ties going to the greatest
    name. ``tipo_pessoa`` follows the document length.
    """
    a = contracts.select(F.col(c_doc).alias("cpf_cnpj"), F.col(c_name).alias("nome"),
                         F.col(c_hist).cast("string").try_cast("int").alias("h"))
    b = commitments.select(F.col(e_doc).alias("cpf_cnpj"), F.col(e_name).alias("nome"),
                           F.lit(0).alias("h"))
    u = a.unionByName(b).dropna(subset=["cpf_cnpj"]).withColumn("h", F.coalesce("h", F.lit(0)))
    named = F.when(F.col("nome").isNotNull(), F.struct("h", "nome"))
    dim = u.groupBy("cpf_cnpj").agg(
        F.max_by("nome", named).alias("nome"),
        F.max("h").cast("int").alias("historico_infringement"),
    )
    return dim.withColumn("tipo_pessoa", person_type("cpf_cnpj")) \
        .select("cpf_cnpj", "nome", "tipo_pessoa", "historico_infringement")
