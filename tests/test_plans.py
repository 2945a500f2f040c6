"""Plan-level checks of the scale claims (hot key = a third of all rows)."""
from pyspark.sql import functions as F

from spendlake.operators.dedupe import dedupe_latest
from spendlake.operators.dims import mode_by_group
from spendlake.operators.merge import assign_keys
from spendlake.operators.quantiles import exact_percentiles


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _hot(spark, n=30000):
    # key 0 holds a third of the rows
    return spark.range(n).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k",
                                     "CAST(id AS DOUBLE) AS v", "CAST(NULL AS TIMESTAMP_NTZ) AS updated_at",
                                     "CAST(id % 7 AS STRING) AS s")


def test_dedupe_combines_before_shuffle_and_uses_no_window(spark):
    out = dedupe_latest(_hot(spark), ["k"], tie=["v"])
    plan = _plan(out)
    assert "Window" not in plan
    assert "partial_max_by" in plan
    assert out.filter("k = 0").first()["v"] == 29997.0


def test_mode_has_no_single_buffer_aggregate(spark):
    out = mode_by_group(_hot(spark), "k", {"s": "m"})
    plan = _plan(out)
    assert "mode(" not in plan and "partial_min_by" in plan
    assert out.filter("k = 0").first()["m"] == "0"


def test_exact_percentiles_avoid_builtin_percentile(spark):
    out = exact_percentiles(_hot(spark), "v", [0.5], by=["k"])
    assert "percentile(" not in _plan(out).replace("percentile_approx", "")
    assert out.filter("k = 0").first()["q0"] == 14998.5


def test_assign_keys_keeps_partitions(spark):
    out = assign_keys(spark.range(5000).withColumnRenamed("id", "k"), "sk", ["k"], num_partitions=8)
    assert out.rdd.getNumPartitions() > 1
    assert out.agg(F.min("sk"), F.max("sk"), F.countDistinct("sk")).first() == (1, 5000, 5000)


def test_months_and_buckets_are_split_by_a_rebalance(spark, tmp_path):
    """A hot month is no longer one task's work: the write asks for a rebalance, not for a partition a month."""
    from spendlake.sources.tables import read_partitioned, write_partitioned
    df = _hot(spark).selectExpr("k", "v", "TIMESTAMP_NTZ '2024-01-05 00:00:00' AS d")
    write_partitioned(df, str(tmp_path / "t"), "d")
    assert read_partitioned(spark, str(tmp_path / "t")).count() == 30000
    import inspect
    from spendlake.sources import tables
    from spendlake.streaming import incremental
    assert "rebalance" in inspect.getsource(tables.write_partitioned) and "rebalance" in inspect.getsource(incremental.merge_into_buckets)


def test_rows_without_a_contract_number_skip_the_join(spark):
    from spendlake.operators.facts import link_commitments_to_contracts
    f = spark.createDataFrame([(1, "000"), (2, None), (3, "7"), (4, "8")], "id int, codcontrato string")
    c = spark.createDataFrame([("7", "2020-01-01", 70), ("7", "2021-01-01", 71)], "num_contrato string, data_assinatura string, sk_contrato long")
    out = link_commitments_to_contracts(f, c)
    assert sorted((r["id"], r["sk_contrato"]) for r in out.collect()) == [(1, None), (2, None), (3, 71), (4, None)]
    assert "Union" in _plan(out)


def test_histogram_has_every_bin_and_value_counts_no_null(spark):
    from spendlake.operators.aggregates import histogram, value_counts
    df = spark.createDataFrame([(0.0, "a"), (100.0, None)], "v double, s string")
    assert sorted((r["bin"], r["n"]) for r in histogram(df, "v", 30).collect()) == [(b, int(b in (1, 30))) for b in range(1, 31)]
    assert [tuple(r) for r in value_counts(df, "s").collect()] == [("a", 1)]


def test_a_cluster_without_a_checkpoint_folder_is_refused():
    import pytest
    from spendlake import session

    class Fake:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://host:7077"
    with pytest.raises(ValueError, match="checkpoint"):
        session.ensure_checkpoint_dir(Fake)
