"""Lookup (dimension) joins and the null-ignoring patch join.

No join here forces a broadcast. Spark's planner broadcasts a side only when its size
estimate — and, with AQE on, the size measured at runtime after the shuffle map stage —
is under ``autoBroadcastJoinThreshold``; beyond that the same plan runs as a sort-merge
join. That is the size check: a dimension that outgrows the threshold degrades to a
shuffle join instead of blowing executor memory. ``hint`` is only for callers that have a
proven bound (e.g. a calendar: one row per day); ``small`` counts a stored dimension first.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.session import stored

BROADCAST_ROWS = 1_000_000           # keys and a value or two a row: about 100 MB


def small(dim: DataFrame, limit: int | None = None) -> DataFrame:
    """``dim`` marked for broadcast where it has at most ``limit`` rows (counted first: pass a stored frame),
    so that facts are not shuffled to meet it; beyond that ``dim`` as it is, for a shuffled join.

    Without the mark AQE finds out that a dimension is small only when the fact has been shuffled too."""
    limit = BROADCAST_ROWS if limit is None else limit
    return F.broadcast(dim) if dim.limit(limit + 1).count() <= limit else dim


def small_for(left: DataFrame, col: str, dim: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """``small`` for a dimension (unique ``key``) of which ``left`` may refer to a few rows only.

    A dimension beyond the limit is cut to the rows whose key occurs in ``left[col]`` where these are few enough
    (an estimate says whether it is worth looking, the exact count decides): no other row can meet ``left``, and a fact
    of any size is not shuffled for them. Else ``dim`` as it is, for a shuffled join."""
    limit = BROADCAST_ROWS if limit is None else limit
    if dim.limit(limit + 1).count() <= limit:
        return F.broadcast(dim)
    refs = left.select(F.col(col).alias(key)).dropna()
    if refs.agg(F.approx_count_distinct(key)).first()[0] > 1.1 * limit:
        return dim
    refs = stored(refs.distinct(), "references")
    if refs.limit(limit + 1).count() > limit:
        return dim
    return small(stored(dim.join(F.broadcast(refs), key, "left_semi").select(*dim.columns), "referred"), limit)


def lookup_join(left: DataFrame, dim: DataFrame, on: Sequence[tuple[str, str]],
                take: dict[str, str], how: str = "left", null_safe: Sequence[str] = (),
                hint: str | None = None) -> DataFrame:
    """Attach ``take`` columns (``dim_col -> new_name``) of ``dim`` to ``left``.

    ``on`` is a list of ``(left_col, dim_col)`` pairs. Dimension key columns are renamed to
    private names first and dropped afterwards, so a left column that shares a name with a
    dimension column always survives (no suffixes, no leaking keys). Pairs whose left
    column is listed in ``null_safe`` match null to null.
    """
    rkeys = {rc: f"__k{i}" for i, (_, rc) in enumerate(on)}
    rsel = [F.col(rc).alias(rkeys[rc]) for _, rc in on]
    rsel += [F.col(src).alias(dst) for src, dst in take.items()]
    right = dim.select(*rsel)
    if hint:
        right = right.hint(hint)
    cond = None
    for lc, rc in on:
        c = (left[lc].eqNullSafe(right[rkeys[rc]]) if lc in null_safe
             else left[lc] == right[rkeys[rc]])
        cond = c if cond is None else cond & c
    out = left.join(right, cond, how)
    return out.drop(*rkeys.values())


def patch_join(base: DataFrame, patch: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Non-null values of ``patch`` overwrite ``base`` per key (``DataFrame.update`` semantics)."""
    p = patch.select(F.col(key).alias("__pk"), *[F.col(c).alias(f"__p_{c}") for c in cols])
    out = base.join(p, base[key] == p["__pk"], "left")
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(f"__p_{c}"), F.col(c)))
    return out.drop("__pk", *[f"__p_{c}" for c in cols])
