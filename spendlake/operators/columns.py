"""Schema-shaping helpers: optional columns with defaults, tolerant drops, null handling."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ensure_columns(df: DataFrame, spec: dict[str, tuple[str, object]]) -> DataFrame:
    """Give ``df`` a fixed schema: every ``name -> (type, default)`` column exists with that type.

    Missing columns are added as the default literal; present ones are cast. The plan therefore
    has the same output schema whatever the raw input carried.
    """
    out = df
    for name, (dtype, default) in spec.items():
        if name in out.columns:
            out = out.withColumn(name, F.col(name).cast(dtype))
        else:
            out = out.withColumn(name, F.lit(default).cast(dtype))
    return out


def drop_if_present(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*[n for n in names if n in df.columns])
