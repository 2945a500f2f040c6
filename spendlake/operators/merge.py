"""Keyed merges on immutable tables: surrogate keys, insert-if-absent, upsert, SCD type 2.

Parquet has no ``MERGE INTO``; each operator is a pure function
``(target, source) -> new_target`` and a writer (``sources.tables.VersionedTable``) stores the
result as a new version. All are joins on the business key, so they shuffle once on that
key and scale with the cluster.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.session import stored


# --------------------------------------------------------------------------- #
# Surrogate keys
# --------------------------------------------------------------------------- #
def _by(order: Sequence[str | Column]) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).asc_nulls_first() for c in order]


def _dealt_by_order(df: DataFrame, order: Sequence[str | Column], num_partitions: int | None) -> DataFrame:
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *_by(order))


def _count_on(dealt: DataFrame, sk: str, order: Sequence[str | Column], start: Column | int) -> DataFrame:
    """``dealt`` (range-partitioned by ``order``) sorted, stored and numbered."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))     # the row's number in its partition
    ranged = stored(dealt.sortWithinPartitions(*_by(order)).select("*", F.spark_partition_id().alias("__pid"), place.alias("__place")), "keys")
    # one row per non-empty partition: bounded by the partition count, so the prefix sums
    # are taken on the driver and the offset table is broadcast back
    rows, before = [], 0
    for pid, cnt in sorted(map(tuple, ranged.groupBy("__pid").count().collect())):
        rows.append((pid, before))
        before += cnt
    offsets = dealt.sparkSession.createDataFrame(rows or [(0, 0)], "__pid int, __before long")
    start_col = start if isinstance(start, Column) else F.lit(start)
    key = F.coalesce(start_col.cast("long"), F.lit(0).cast("long")) + F.col("__before") + F.col("__place") + 1
    return ranged.join(F.broadcast(offsets), "__pid").withColumn(sk, key.cast("long")).drop("__pid", "__place", "__before")


def assign_keys(df: DataFrame, sk: str, order: Sequence[str | Column], start: Column | int = 0,
                num_partitions: int | None = None) -> DataFrame:
    """Add a dense ``sk`` = ``start`` + 1, 2, ... in ``order`` (a unique business key).

    Distributed: the rows are range-partitioned and sorted by ``order`` and stored as Parquet in the
    checkpoint folder (so both passes see the same partitions even after an executor
    loss), per-partition counts (one row per partition) give each partition its offset,
    and the offset table — one row per partition — is broadcast back. No single task ever
    sees more than its own partition, unlike an unpartitioned ``row_number``.
    """
    return _count_on(_dealt_by_order(df, order, num_partitions), sk, order, start)


def number_keys(keys: DataFrame, sk: str, start: Column | int = 0, num_partitions: int | None = None) -> DataFrame:
    """The rows of ``keys`` (nothing but a business key) with a dense ``sk`` in their order.

    Raises if a key occurs twice. Equal keys meet in the range partition that numbers them, so counting them
    takes no shuffle besides; wide rows get their number by a join on the key."""
    order = keys.columns
    counted = _dealt_by_order(keys, order, num_partitions).groupBy(*order).agg(F.count(F.lit(1)).alias("__n"))
    numbered = _count_on(counted, sk, order, start)
    if numbered.filter("__n > 1").limit(1).count():
        raise ValueError(f"source has duplicate keys on {list(order)}")
    return numbered.drop("__n")


def next_key_start(target: DataFrame, sk: str) -> Column:
    """``max(sk)`` of the target as a scalar subquery (0 when the target is empty)."""
    return F.coalesce(target.select(F.max(sk)).scalar(), F.lit(0).cast("long"))


def _key_cond(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool):
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k]) if null_safe else left[k] == right[k]
        cond = c if cond is None else cond & c
    return cond


def require_unique(source: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key value occurs in more than one row (null keys match nothing and may repeat)."""
    if source.select(*keys).dropna().groupBy(*keys).count().filter("count > 1").limit(1).count():
        raise ValueError(f"source has duplicate keys on {list(keys)}")


# --------------------------------------------------------------------------- #
# Insert-if-absent, update-by-key, upsert
# --------------------------------------------------------------------------- #
def insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str], sk: str | None = None,
                  null_safe: bool = False) -> DataFrame:
    """Add source rows whose key is not in the target (``ON CONFLICT DO NOTHING``).

    Of source rows with one key the smallest by the other columns counts (nulls first); a null
    part of the key is one value when ``null_safe``, else such rows have no key and are left out (they
    would be absent, and come in, on every load). New rows get keys after the target's max.
    """
    source = source if null_safe else source.dropna(subset=list(keys))
    cols = [c for c in target.columns if c != sk]
    rest = [c for c in cols if c not in keys]
    if rest:
        src = source.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__r")).select(*keys, "__r.*").select(*cols)
    else:
        src = source.select(*cols).distinct()
    t = target.select(*keys)
    new = src.join(t, _key_cond(src, t, keys, null_safe), "left_anti")
    if sk:
        new = assign_keys(new, sk, keys, start=next_key_start(target, sk))
    return target.unionByName(new.select(*target.columns))


def update_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str],
                  cols: Sequence[str]) -> DataFrame:
    """Replace ``cols`` of target rows whose key is in ``source`` (once); others unchanged."""
    require_unique(source, keys)
    s = source.select(*keys, *[F.col(c).alias(f"__s_{c}") for c in cols],
                      F.lit(True).alias("__hit"))
    out = target.join(s, list(keys), "left")
    for c in cols:
        out = out.withColumn(c, F.when(F.col("__hit"), F.col(f"__s_{c}")).otherwise(F.col(c)))
    return out.select(*target.columns)


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 update_cols: Sequence[str], insert_cols: Sequence[str] | None = None,
                 sk: str | None = None, check_unique: bool = True) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE SET update_cols``.

    Matched rows take ``update_cols`` from the source — a null in the source overwrites —
    and keep every other column (surrogate key included) from the target. Unmatched source
    rows are inserted with ``insert_cols`` (default: all source columns present in the
    target) and fresh keys. Target rows absent from the source pass through. Source rows with a null
    in their key are left out: they match nothing, so each load would insert them again.
    ``source`` is read several times (pass a stored frame); with ``sk`` the joined rows are written once,
    so that neither chained merges nor the key assignment build them again.
    """
    source = source.dropna(subset=list(keys))
    if check_unique:
        require_unique(source, keys)
    insert_cols = list(insert_cols) if insert_cols is not None else [
        c for c in source.columns if c in target.columns]
    tcols = target.columns
    t = target.select(*[F.col(c).alias(f"__t_{c}") for c in tcols], F.lit(True).alias("__tp"))
    s = source.select(*[F.col(c).alias(f"__s_{c}") for c in source.columns], F.lit(True).alias("__sp"))
    cond = None
    for k in keys:
        c = t[f"__t_{k}"] == s[f"__s_{k}"]
        cond = c if cond is None else cond & c
    j = t.join(s, cond, "full_outer")
    sel = []
    for c in tcols:
        tc, sc = F.col(f"__t_{c}"), (F.col(f"__s_{c}") if c in source.columns else None)
        if c in keys:
            v = F.coalesce(tc, sc)
        elif c in update_cols and sc is not None:
            v = F.when(F.col("__sp"), sc).otherwise(tc)
        elif c in insert_cols and sc is not None:
            v = F.when(F.col("__tp"), tc).otherwise(sc)
        else:
            v = tc
        sel.append(v.alias(c))
    merged = j.select(*sel, F.col("__tp").isNotNull().alias("__old"))
    if not sk:
        return merged.drop("__old")
    merged = stored(merged, "merged")
    old = merged.filter("__old").drop("__old")
    new = merged.filter(~F.col("__old")).drop("__old", sk)
    new = assign_keys(new, sk, keys, start=next_key_start(target, sk))
    return old.unionByName(new.select(*tcols))


# --------------------------------------------------------------------------- #
# Slowly changing dimension, type 2
# --------------------------------------------------------------------------- #
def scd2_merge(history: DataFrame, incoming: DataFrame, key: str, versioned: Sequence[str],
               inplace: Sequence[str], as_of, sk: str = "sk", start_col: str = "data_inicio",
               end_col: str = "data_fim", current_col: str = "versao_atual") -> DataFrame:
    """One-pass SCD2 merge of ``incoming`` (one row per ``key``) into ``history``.

    Against the current version of each key, an incoming row is *new* (no current version),
    *changed* (a ``versioned`` column differs, null-safe) or *same*. Changed: the current
    version is closed (``end_col`` = ``as_of``, not current) and a new version opens on
    ``as_of``. New: a first version opens on ``as_of``. Same: ``inplace`` columns are
    overwritten in the current version. Closed versions and keys absent from the batch pass
    through. New versions get surrogate keys after the history's max. Incoming rows without a key
    are left out.
    """
    incoming = stored(incoming.dropna(subset=[key]), "incoming")
    require_unique(incoming, [key])
    as_of_c = F.lit(str(as_of)).cast("date")
    hcols = history.columns
    attrs = [c for c in incoming.columns if c != key and c in hcols]
    past = history.filter(~F.col(current_col))
    cur = history.filter(F.col(current_col))
    c = cur.select(*[F.col(x).alias(f"__c_{x}") for x in hcols])
    i = incoming.select(F.col(key).alias("__i_key"), *[F.col(a).alias(f"__i_{a}") for a in attrs])
    j = c.join(i, c[f"__c_{key}"] == i["__i_key"], "full_outer")
    has_c, has_i = F.col(f"__c_{key}").isNotNull(), F.col("__i_key").isNotNull()
    changed = None
    for v in versioned:
        d = ~F.col(f"__c_{v}").eqNullSafe(F.col(f"__i_{v}"))
        changed = d if changed is None else changed | d
    action = (F.when(~has_i, "keep").when(~has_c, "new").when(changed, "changed").otherwise("same"))
    j = j.withColumn("__action", action)

    def version(kind: str) -> Column:
        fields = []
        for x in hcols:
            if x == key:
                val = F.coalesce(F.col(f"__c_{key}"), F.col("__i_key"))
            elif x == sk:
                val = F.col(f"__c_{sk}") if kind in ("keep", "close", "same") else F.lit(None).cast("long")
            elif x == start_col:
                val = F.col(f"__c_{x}") if kind in ("keep", "close", "same") else as_of_c
            elif x == end_col:
                val = (as_of_c if kind == "close" else
                       F.col(f"__c_{x}") if kind in ("keep", "same") else F.lit(None).cast("date"))
            elif x == current_col:
                val = F.lit(kind != "close")
            elif kind == "same" and x in inplace:
                val = F.col(f"__i_{x}")
            elif kind in ("open",) and x in attrs:
                val = F.col(f"__i_{x}")
            else:
                val = F.col(f"__c_{x}")
            fields.append(val.cast(history.schema[x].dataType).alias(x))
        return F.struct(*fields)

    rows = F.when(F.col("__action") == "keep", F.array(version("keep"))) \
        .when(F.col("__action") == "same", F.array(version("same"))) \
        .when(F.col("__action") == "new", F.array(version("open"))) \
        .otherwise(F.array(version("close"), version("open")))
    out = stored(j.select(F.explode(rows).alias("__r")).select("__r.*"), "versions")
    old = out.filter(F.col(sk).isNotNull())
    new = out.filter(F.col(sk).isNull()).drop(sk)
    new = assign_keys(new, sk, [key], start=next_key_start(history, sk))
    return past.unionByName(old).unionByName(new.select(*hcols))
