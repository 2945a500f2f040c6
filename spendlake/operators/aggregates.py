"""Aggregate operators: exact describe, value counts, period sums, histogram, scaling, errors.

All are single ``groupBy``/``agg`` plans (partial aggregation before the shuffle). Global
scalars (min/max for scaling, histogram bounds) are scalar subqueries — evaluated once,
inlined as constants — never an unpartitioned window.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUARTILES = (0.25, 0.5, 0.75)


def describe_exact(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (),
                   digits: int = 6) -> DataFrame:
    """count, mean, sample std, min, exact (interpolated) quartiles, max per column.

    Long format: one row per (group..., column). The columns are stacked into one
    (column, value) frame, so every statistic of every column comes from the same passes;
    quartiles come from ``exact_percentiles`` (distributed, never one group in one task),
    not the approximate ``summary()``.
    """
    from spendlake.operators.quantiles import exact_percentiles
    by = list(by)
    stacked = df.select(*by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])).alias("__s")) \
        .select(*by, "__s.column", F.col("__s.v").alias("__v"))
    keys = by + ["column"]
    moments = {"count": F.count, "mean": lambda v: F.round(F.avg(v), digits),
               "std": lambda v: F.round(F.stddev_samp(v), digits), "min": F.min, "max": F.max}
    out = exact_percentiles(stacked, "__v", QUARTILES, by=keys, extra=moments)
    return out.select(*by, "count", "mean", "std", "min",
                      *[F.round(F.col(f"q{i}"), digits).alias(f"p{int(q * 100)}") for i, q in enumerate(QUARTILES)],
                      "max", "column")


def percentile_scalar(df: DataFrame, col: str, p: float):
    """Exact percentile of a whole column as a scalar subquery Column."""
    from spendlake.operators.quantiles import exact_percentiles
    return exact_percentiles(df, col, [p]).select("q0").scalar()


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per non-null value, most frequent first."""
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.col(col))


def period_sum(df: DataFrame, date_col: str, value: str, unit: str = "month",
               out: str = "total") -> DataFrame:
    p = F.date_trunc(unit, F.col(date_col)).cast("date").alias("periodo")
    return df.groupBy(p).agg(F.sum(value).cast("decimal(18,2)").alias(out))


def minmax_scale(df: DataFrame, col: str, out: str) -> DataFrame:
    """(x - min) / (max - min) over the batch; a constant batch gives 0."""
    stats = df.select(F.min(F.col(col).cast("double")).alias("mn"),
                      F.max(F.col(col).cast("double")).alias("mx"))
    mn = stats.select("mn").scalar()
    mx = stats.select("mx").scalar()
    x = F.col(col).cast("double")
    return df.withColumn(out, F.when(mx == mn, F.lit(0.0)).otherwise((x - mn) / (mx - mn)))


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between the batch min and max, empty ones included; the max lands in the last bin."""
    x = F.col(col).cast("double")
    mn = df.select(F.min(x)).scalar()
    mx = df.select(F.max(x)).scalar()
    b = F.least(F.width_bucket(x, mn, mx, F.lit(bins)), F.lit(bins))
    counts = df.filter(x.isNotNull()).groupBy(b.cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").alias("bin"))
    return every.join(F.broadcast(counts), "bin", "left").select("bin", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den with 0 when den is 0 or null."""
    return F.coalesce(F.try_divide(num, F.nullif(den, F.lit(0))), F.lit(0))


def forecast_errors(df: DataFrame, actual: str, pred: str, lo: str, hi: str,
                    digits: int = 6) -> DataFrame:
    """MAE, MAPE (zero actuals skipped) and interval coverage."""
    y, p = F.col(actual).cast("double"), F.col(pred).cast("double")
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(F.abs(y - p)), digits).alias("mae"),
        F.round(F.avg(F.abs(y - p) / F.nullif(y, F.lit(0.0))), digits).alias("mape"),
        F.round(F.avg(y.between(F.col(lo).cast("double"), F.col(hi).cast("double")).cast("double")),
                digits).alias("coverage"),
    )
