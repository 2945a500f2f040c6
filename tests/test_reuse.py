"""Work is done once: what several dimensions, facts and merges read is built and written a single time."""
from pyspark.sql import functions as F

from spendlake.operators.dedupe import dedupe_latest
from spendlake.operators.joins import lookup_join, small
from spendlake.operators.merge import assign_keys, merge_upsert, scd2_merge
from spendlake.plans import domain, gold

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_kept_columns_do_not_change_the_row_chosen(spark):
    """Two versions tie on date, value and unit: the whole row decides, whatever is kept of it."""
    rows = [(i % 5, f"a{i}", f"b{i * 7 % 11}", "2024-01-01") for i in range(40)]
    df = spark.createDataFrame(rows, "k int, a string, b string, updated_at string")
    whole = sorted((r["k"], r["a"]) for r in dedupe_latest(df, ["k"]).collect())
    part = dedupe_latest(df, ["k"], keep=["a"])
    assert part.columns == ["k", "a"] and sorted(tuple(r) for r in part.collect()) == whole


def test_a_small_stored_dimension_is_broadcast_and_a_large_one_is_not(spark):
    fact = spark.range(100).withColumnRenamed("id", "k")
    dim = spark.range(10).selectExpr("id AS d", "id * 2 AS v")
    join = lambda limit: lookup_join(fact, small(dim, limit), [("k", "d")], {"v": "v"})
    assert "strategy=broadcast" in _plan(join(10)) and "strategy=broadcast" not in _plan(join(9))
    assert sorted(map(str, join(10).collect())) == sorted(map(str, join(9).collect()))


def test_chained_upserts_read_their_source_no_more_than_once_a_merge(spark):
    """The result of a keyed upsert is stored rows: neither its joins nor its source are planned again."""
    target = assign_keys(spark.range(5).selectExpr("id AS k", "'old' AS v"), "sk", ["k"])
    source = spark.range(3, 8).selectExpr("id AS k", "'new' AS v")
    once = merge_upsert(target, source, ["k"], ["v"], sk="sk")
    twice = merge_upsert(once, source, ["k"], ["v"], sk="sk")
    assert "FullOuter" not in _plan(once) and "FullOuter" not in _plan(twice)
    assert sorted((r["k"], r["v"], r["sk"]) for r in twice.collect()) == [(i, "old" if i < 3 else "new", i + 1) for i in range(8)]


def test_versions_are_joined_once(spark):
    history = spark.createDataFrame([(1, "d1", "A", "2025-01-01", None, True)], "sk long, doc string, nome string, i string, data_fim date, versao_atual boolean") \
        .selectExpr("sk", "doc", "nome", "CAST(i AS DATE) AS data_inicio", "data_fim", "versao_atual")
    out = scd2_merge(history, spark.createDataFrame([("d1", "B"), ("d2", "C")], "doc string, nome string"), "doc", ["nome"], [], "2026-01-01")
    assert "FullOuter" not in _plan(out)
    assert sorted((r["doc"], r["nome"], r["versao_atual"], r["sk"]) for r in out.collect()) == [("d1", "A", False, 1), ("d1", "B", True, 2), ("d2", "C", True, 3)]


def test_silver_is_built_once_a_query(spark, monkeypatch):
    built = []
    for name in ("contracts", "commitments", "payments", "units"):
        real = getattr(domain, name)
        monkeypatch.setattr(domain, name, lambda *a, _real=real, _name=name, **k: built.append(_name) or _real(*a, **k))
    gold.fato_empenho(spark, SF)
    assert sorted(built) == ["commitments", "contracts", "payments", "units"]


def test_contracts_without_their_sums_do_not_read_the_lines(spark):
    cols = ["num_contrato", "valor_contrato"]
    assert "l_orderkey" not in _plan(domain.contracts(spark, SF, cols=cols))
    part, whole = domain.contracts(spark, SF, cols=cols), domain.contracts(spark, SF)
    assert sorted(map(tuple, part.select("id", *cols).collect())) == sorted(map(tuple, whole.select("id", *cols).collect()))
    assert whole.agg(F.sum("calculated_valor_empenhado")).first()[0] > 0
