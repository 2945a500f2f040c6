"""Keep-one-row-per-key operators (latest version, first head-office row, latest mapping).

All of them are aggregations (``max_by``/``min_by`` over a struct ordering key), not
``row_number`` windows: the aggregation combines map-side, so a key that holds a third of
all rows is reduced inside every map task before the shuffle instead of being sorted whole
in one reducer. Every ordering is total (explicit tie-break columns, and a row hash last),
so results do not depend on partitioning or file order.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _row_hash(df: DataFrame, exclude: Sequence[str] = ()) -> Column:
    cols = [F.col(c) for c in df.columns if c not in exclude]
    return F.xxhash64(*cols) if cols else F.lit(0)


def _rank_struct(order: str | None, tie: Sequence, desc_nulls_first: bool) -> Column:
    parts: list[Column] = []
    if order is not None:
        o = F.col(order)
        if desc_nulls_first:
            # a null order value sorts after every value, i.e. it is the "latest"
            parts += [o.isNull().alias("_null"), o.alias("_o")]
        else:
            parts += [o.alias("_o")]
    for i, t in enumerate(tie):
        parts.append((F.col(t) if isinstance(t, str) else t).alias(f"_t{i}"))
    return F.struct(*parts, F.col("__h"))


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: str = "updated_at",
                  tie: Sequence = (), keep: Sequence[str] | None = None) -> DataFrame:
    """Latest row per key by ``order`` (null ``order`` counts as newest).

    Ties are broken by ``tie`` (larger wins), then by a hash of the whole row. Without the
    order column the tie columns alone decide. ``keep``: the columns wanted besides the keys
    (default: all); others decide as before, but are neither sorted nor shuffled.
    """
    order_col = order if order in df.columns else None
    names = [c for c in df.columns if keep is None or c in keys or c in keep]
    rest = [c for c in names if c not in keys]
    if not rest:
        return df.select(*names).dropDuplicates(list(keys))
    rank = _rank_struct(order_col, tie, desc_nulls_first=True)
    picked = df.withColumn("__h", _row_hash(df)).groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return picked.select(*[F.col(k) for k in keys], "_row.*").select(*names)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  tie: Sequence = ()) -> DataFrame:
    """Earliest row per key by ``order`` ascending (nulls first), then ``tie`` ascending."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)],
                    *[(F.col(t) if isinstance(t, str) else t).alias(f"_t{i}") for i, t in enumerate(tie)],
                    _row_hash(df).alias("_h"))
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("_row"))
    return picked.select(*[F.col(k) for k in keys], "_row.*").select(*df.columns)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 tie: Sequence = ()) -> DataFrame:
    """Latest row per key by ``order`` descending (the ``iloc[-1]`` of a sorted group)."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)],
                    *[(F.col(t) if isinstance(t, str) else t).alias(f"_t{i}") for i, t in enumerate(tie)],
                    _row_hash(df).alias("_h"))
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return picked.select(*[F.col(k) for k in keys], "_row.*").select(*df.columns)


def latest_mapping(df: DataFrame, key: str, value: str, order: str,
                   tie: Sequence = (), key_alias: str | None = None,
                   value_alias: str | None = None) -> DataFrame:
    """One ``key -> value`` pair per key, taken from the row with the greatest ``order``.

    Used for units that moved to another parent agency over the years: the newest year wins,
    so the later lookup join stays many-to-one.
    """
    rank = F.struct(F.col(order), *[(F.col(t) if isinstance(t, str) else t) for t in tie],
                    F.col(value).alias("_v"))
    return (df.groupBy(key)
            .agg(F.max_by(F.col(value), rank).alias(value_alias or value))
            .withColumnRenamed(key, key_alias or key))
