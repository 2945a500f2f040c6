"""Silver -> Gold star schema over the driver tables: dimensions with surrogate keys, facts
with resolved foreign keys. Each builder is lazy except for key assignment (which
checkpoints the new rows once)."""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.operators.dedupe import latest_mapping
from spendlake.operators.dims import agency_dim, calendar_dim, creditor_dim, modality_dim
from spendlake.operators.facts import commitment_fact, contract_fact, link_commitments_to_contracts, payment_fact
from spendlake.operators.joins import lookup_join, small, small_for
from spendlake.operators.merge import assign_keys
from spendlake.plans import domain
from spendlake.session import stored

CREDITOR_CONTRACT_COLS = ["cpf_cnpj_financiador", "descricao_nome_credor", "infringement_status"]
CREDITOR_EVENT_COLS = ["codigocredor", "nomecredor"]

# Fixed load date for the driver queries (SCD2 versions open on it).
LOAD_DATE = _dt.date(2026, 7, 23)


#: What the facts read of commitments and payments (besides the keys).
COMMITMENT_COLS = ["codigo", "codigoug", "codigocredor", "valor", "dataemissao", "codcontrato", "modalidade"]
PAYMENT_COLS = ["codigo", "codigoug", "codigocredor", "valor", "dataemissao", "tipoob"]
CONTRACT_KEY_COLS = ["num_contrato", "data_assinatura", *CREDITOR_CONTRACT_COLS]


class Silver:
    """The Silver entities of one query: each is built and written once, on first use, however many
    dimensions and facts read it. ``contracts``, ``commitments``, ``payments``: the columns the query needs (None: all).

    ``keyed``: entity -> surrogate key of its fact, given out when the entity is stored: the joins that follow
    keep a row one row, so that the fact is neither shuffled nor stored again for its key."""

    def __init__(self, spark: SparkSession, d: str, contracts=None, commitments=None, payments=None, keyed: dict[str, str] | None = None):
        self._keyed = keyed or {}
        keep = {"commitments": commitments, "payments": payments}
        self._make = {"contracts": lambda: domain.contracts(spark, d, cols=contracts), "units": lambda: domain.units(spark, d),
                      **{n: lambda n=n, c=c: self._part(getattr(domain, n)(spark, d, keep=c), c) for n, c in keep.items()}}
        self._made: dict[str, DataFrame] = {}

    @staticmethod
    def _part(df: DataFrame, cols) -> DataFrame:
        return df if cols is None else df.select(*cols)

    def _once(self, name: str) -> DataFrame:
        if name not in self._made:
            df, sk = self._make[name](), self._keyed.get(name)
            # rows without id or year come last: facts leave them out
            self._made[name] = assign_keys(df, sk, [F.col("id").isNull() | F.col("ano").isNull(), "id", "ano"]) if sk else stored(df, name)
        return self._made[name]

    contracts = property(lambda self: self._once("contracts"))
    commitments = property(lambda self: self._once("commitments"))
    payments = property(lambda self: self._once("payments"))
    units = property(lambda self: self._once("units"))


def contract_silver(spark: SparkSession, d: str) -> Silver:
    """For the contract fact and the dimensions: whole contracts, days and creditors of the others."""
    return Silver(spark, d, commitments=["dataemissao", *CREDITOR_EVENT_COLS], payments=["dataemissao"])


def commitment_silver(spark: SparkSession, d: str) -> Silver:
    return Silver(spark, d, contracts=CONTRACT_KEY_COLS, commitments=["id", "ano", *COMMITMENT_COLS, "nomecredor"], payments=["dataemissao"],
                  keyed={"commitments": "sk_empenho"})


def payment_silver(spark: SparkSession, d: str) -> Silver:
    return Silver(spark, d, contracts=CONTRACT_KEY_COLS, commitments=["dataemissao", *CREDITOR_EVENT_COLS], payments=["id", "ano", *PAYMENT_COLS],
                  keyed={"payments": "sk_ordem_bancaria"})


def unit_map(spark: SparkSession, d: str, silver: Silver | None = None) -> DataFrame:
    units = silver.units if silver else domain.units(spark, d, cols=["codigo", "ano", "codigoorgao"])
    return latest_mapping(units, "codigo", "codigoorgao", "ano", key_alias="codigo_ug", value_alias="codigo_orgao")


def unit_lookup(spark: SparkSession, d: str, silver: Silver | None = None) -> DataFrame:
    """The unit map for a join with the facts: stored, so that its size is known before."""
    return small(stored(unit_map(spark, d, silver), "unit_map"))


def dim_tempo(spark: SparkSession, d: str, silver: Silver | None = None) -> DataFrame:
    con = silver.contracts if silver else domain.contracts(spark, d, cols=["data_assinatura"])
    emp, pay = (silver.commitments, silver.payments) if silver else (f(spark, d, cols=["dataemissao"]) for f in (domain.commitments, domain.payments))
    return assign_keys(calendar_dim((con, "data_assinatura"), (emp, "dataemissao"), (pay, "dataemissao")), "sk_tempo", ["data"])


def dim_orgao(spark: SparkSession, d: str, silver: Silver | None = None) -> DataFrame:
    return assign_keys(agency_dim(silver.units if silver else stored(domain.units(spark, d), "units")), "sk_orgao", ["codigo_orgao"])


def dim_modalidade(spark: SparkSession, d: str, silver: Silver | None = None) -> DataFrame:
    con = silver.contracts if silver else domain.contracts(spark, d, cols=["descricao_modalidade", "descricao_tipo"])
    return assign_keys(modality_dim(con), "sk_modalidade",
                       ["descricao_modalidade", "descricao_tipo"])


def dim_credor(spark: SparkSession, d: str, silver: Silver | None = None, as_of=LOAD_DATE) -> DataFrame:
    """First load of the creditor dimension: every creditor opens a current version."""
    base = creditor_dim(*(silver.contracts, silver.commitments) if silver else
                        (domain.contracts(spark, d, cols=CREDITOR_CONTRACT_COLS), domain.commitments(spark, d, cols=CREDITOR_EVENT_COLS)))
    base = base.select("*", F.lit(str(as_of)).cast("date").alias("data_inicio"),
                       F.lit(None).cast("date").alias("data_fim"), F.lit(True).alias("versao_atual"))
    return assign_keys(base, "sk_credor", ["cpf_cnpj"])


def calendar_hint(dim: DataFrame, limit: int = 1_000_000) -> str | None:
    """``broadcast`` for a calendar of a checked size (one row per day), else a plain join."""
    return "broadcast" if dim.limit(limit + 1).count() <= limit else None


def contract_keys(f: DataFrame, dims: dict) -> DataFrame:
    """Contract fact with its four foreign keys (modality matched null-safe)."""
    t = dims["dim_tempo"]
    f = lookup_join(f, t, [("data_assinatura", "data")], {"sk_tempo": "sk_tempo_assinatura"}, hint=calendar_hint(t))
    f = lookup_join(f, small(dims["dim_orgao"]), [("codigo_orgao", "codigo_orgao")], {"sk_orgao": "sk_orgao"})
    f = lookup_join(f, small(dims["dim_modalidade"]), [("descricao_modalidade", "descricao_modalidade"),
                                                ("descricao_tipo", "descricao_tipo")], {"sk_modalidade": "sk_modalidade"},
                    null_safe=["descricao_tipo"])
    return creditor_key(f, dims)


def creditor_key(f: DataFrame, dims: dict) -> DataFrame:
    """The fact with the key of its creditor's current version."""
    current = dims["dim_credor"].filter("versao_atual").select("cpf_cnpj", "sk_credor")
    return lookup_join(f, small_for(f, "cpf_cnpj", current, "cpf_cnpj"), [("cpf_cnpj", "cpf_cnpj")], {"sk_credor": "sk_credor"})


def unit_fact_keys(f: DataFrame, dims: dict, date_col: str = "data_emissao") -> DataFrame:
    """Commitment or payment fact with its day, agency and creditor keys."""
    t = dims["dim_tempo"]
    f = lookup_join(f, t, [(date_col, "data")], {"sk_tempo": "sk_tempo"}, hint=calendar_hint(t))
    f = lookup_join(f, small(dims["dim_orgao"]), [("codigo_orgao", "codigo_orgao")], {"sk_orgao": "sk_orgao"})
    return creditor_key(f, dims)


DIMENSIONS = {"dim_tempo": dim_tempo, "dim_orgao": dim_orgao, "dim_modalidade": dim_modalidade, "dim_credor": dim_credor}
UNIT_FACT_DIMS = ("dim_tempo", "dim_orgao", "dim_credor")


def dimensions(spark: SparkSession, d: str, names=tuple(DIMENSIONS), silver: Silver | None = None) -> dict[str, DataFrame]:
    return {n: DIMENSIONS[n](spark, d, silver) for n in names}


def fato_contrato(spark: SparkSession, d: str, dims: dict | None = None, silver: Silver | None = None) -> DataFrame:
    """Contract fact with its foreign keys and a key."""
    silver = silver or contract_silver(spark, d)
    f = contract_keys(contract_fact(silver.contracts), dims or dimensions(spark, d, silver=silver))
    f = f.withColumn("score_anomalia", F.lit(None).cast("decimal(5,4)"))
    return assign_keys(f, "sk_contrato", ["id_contrato_origem", "ano"])


def contract_dates(con: DataFrame) -> DataFrame:
    """Contract id, number, signing day and year: the rows of the contract fact."""
    return con.select(F.col("id").cast("long").alias("id_contrato_origem"), F.year("data_assinatura").alias("ano"), "num_contrato",
                      F.col("data_assinatura").cast("date").alias("data_assinatura")).dropna(subset=["id_contrato_origem", "ano"])


def contract_numbers(con: DataFrame) -> DataFrame:
    """Contract number, signing day and key, numbered as in the contract fact."""
    return assign_keys(contract_dates(con), "sk_contrato", ["id_contrato_origem", "ano"])


def _last(f: DataFrame, col: str) -> DataFrame:
    return f.select(*[c for c in f.columns if c != col], col)


def fato_empenho(spark: SparkSession, d: str, dims: dict | None = None, silver: Silver | None = None) -> DataFrame:
    """Commitment fact with its foreign keys, its contract and a key."""
    silver = silver or commitment_silver(spark, d)
    f = commitment_fact(silver.commitments, unit_lookup(spark, d, silver), sk="sk_empenho")
    f = unit_fact_keys(f, dims or dimensions(spark, d, UNIT_FACT_DIMS, silver))
    f = link_commitments_to_contracts(f, contract_numbers(silver.contracts))
    return _last(f, "sk_empenho")


def fato_ordem_bancaria(spark: SparkSession, d: str, dims: dict | None = None, silver: Silver | None = None) -> DataFrame:
    """Payment fact with its foreign keys and a key."""
    silver = silver or payment_silver(spark, d)
    f = payment_fact(silver.payments, unit_lookup(spark, d, silver), sk="sk_ordem_bancaria")
    f = unit_fact_keys(f, dims or dimensions(spark, d, UNIT_FACT_DIMS, silver))
    return _last(f, "sk_ordem_bancaria")
