"""Similarity join of documents on word shingles: size-aware, heavy and light.

A document is the set of its distinct shingles of five words; two documents link when their
Jaccard similarity is at least ``PERCENT``/100. Documents with the same set are one class, and
classes are joined:

* Light sets (up to a size x) are joined by enumeration. For every partner size b a set of size
  a must share ``need(a, b)`` shingles with, all its subsets of just that many are emitted under
  (a, b, subset). Two sets link exactly if they share such a key, so nothing is verified, and
  one link to a member of either size stands for all the links within a key.
* Heavy sets scan inverted lists. Shingles are ordered by how common they are (counted over all
  documents in a hashed table of fixed size; the order only decides how long lists get, never
  the result), and by the prefix principle two linked sets share at least ``MEETINGS`` of their
  first few. What meets that often is verified on the whole sets.
* x is the size at which enumerating costs more rows than lists would, over the sizes present.

A list of copies is not turned into pairs: each list is first verified against one hub, the set whose
shingles are the most common (what a group was copied from has no shingles of its own). Then entries of lists that are in
different components are verified against their neighbours in the orders of a few min-hashes: sets that
are alike share one with the probability of
their similarity and stand side by side, so a group whose members are not all like one hub is joined too.
Only entries of different components that still meet are then compared one by one, which makes the result
exact whatever hubs and neighbours have found. Before they are paired, each entry is bounded. Two sets that meet at
some shingle have both their rarer shingles in lists, so what no list has kept is not shared; and pairs that
share a shingle of a short list are found there, so in a long list only pairs count that share none of those
either. A set thus shares at most its size less the number of such shingles before the one met. Copies that
have changed too much for a link stay below what it needs and make no pairs with their group. Lists of very common shingles are salted and have a hub for each
part. No pair is verified twice, and each of the three steps makes the sets of its own pairs from the texts.

Defined cases: null, empty and wordless texts have an empty set, link with nothing and are their
own component; fewer words than five make one shingle; several rows with one id are handled
as rows; null ids take part in links, but a component is named by its smallest non-null id.
Hashes have 64 bits (sets are compared by them).
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlake.llm import sketch
from spendlake.llm import text as X
from spendlake.llm.components import components
from spendlake.llm.frames import ready, stored
from spendlake.llm.tokens import give_back

SHINGLE, PERCENT = 5, 80
MAX_LIGHT = 24          # sizes up to this may be enumerated, if that is cheaper
LIST_ROW_COST = 4       # a list entry is scanned and may be verified; a subset row is only met
MEETINGS = 4            # shingles that two sets must share within their prefixes (or all, if they need fewer)
LONG_LIST = 16          # entries from which pairs that share a shorter list are left to that
ROUNDS = 4              # orders in which neighbours along the lists are met, each of another min-hash
HOT_LIST = 20_000       # entries of a list that one part should hold


def need(a: int, b: int, percent: int = PERCENT) -> int:
    """Shingles that sets of sizes a and b must share."""
    return -(-percent * (a + b) // (100 + percent))


def partners(n: int, percent: int = PERCENT) -> range:
    """Sizes that a set of size n can link with."""
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def subset_keys(n: int, percent: int = PERCENT) -> list[tuple[int, int, int]]:
    """(smaller size, larger size, subset size) that a light set of size n enumerates; equal sets
    are one class already, so subsets of the full size against the same size are left out."""
    found = [(min(n, m), max(n, m), need(n, m, percent)) for m in partners(n, percent)]
    return [(a, b, c) for a, b, c in found if c <= a and not a == b == c]


def boundary(sizes: dict[int, int], percent: int = PERCENT) -> int:
    """The light size limit with the fewest weighted rows; ``sizes``: classes by size up to MAX_LIGHT."""
    def cost(x: int) -> int:
        light = sum(k * sum(comb(n, c) for _, _, c in subset_keys(n, percent)) for n, k in sizes.items() if n <= x)
        lists = sum(k * min(n, n - -(-percent * n // 100) + MEETINGS) for n, k in sizes.items() if 100 * n > percent * x)
        return light + LIST_ROW_COST * lists
    return min(range(MAX_LIGHT + 1), key=lambda x: (cost(x), x))


def _class_ids(sets: list[np.ndarray]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(s.tobytes(), seed=7) for s in sets], np.uint64).view(np.int64)


def _min_hashes(sets: list[np.ndarray]) -> list[np.ndarray]:
    """The least hash of each set under ``ROUNDS`` hash functions; 0 for an empty set."""
    sizes = np.array([len(s) for s in sets])
    full = np.flatnonzero(sizes)
    out = [np.zeros(len(sets), np.int64) for _ in range(ROUNDS)]
    if len(full):
        every = np.concatenate([sets[i] for i in full])
        starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        for r, column in enumerate(out):
            column[full] = np.minimum.reduceat(X.mix(every ^ np.uint64(0x9E3779B97F4A7C15 * (r + 1) % 2**64)), starts).view(np.int64)
    return out


def _members(id_type: pa.DataType):
    """Rows of documents (class, size, min-hashes) and, at a task's end, of its shingle counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, met = sketch.Counts(), set()
        names = ["doc_id", "n", "cid", *MARKS, "segment", "counts"]
        for batch in batches:
            data, offsets = X.utf8(batch.column(1))
            sizes, cids, marks = [], [], []
            for lo, hi in X.slices(offsets):
                sets = X.shingle_sets(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], SHINGLE)
                own = _class_ids(sets)
                fresh = []
                for s, c in zip(sets, own.tolist()):
                    if len(s) and c not in met:
                        met.add(c)
                        fresh.append(s)
                if fresh:
                    counts.add(sketch.place(np.concatenate(fresh)))
                sizes += [len(s) for s in sets]
                cids.append(own)
                marks.append(np.stack(_min_hashes(sets)))
            give_back()
            n = len(batch)
            marks = np.concatenate(marks, axis=1) if marks else np.zeros((ROUNDS, 0), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(id_type), pa.array(sizes, pa.int64()), pa.array(np.concatenate(cids) if cids else [], pa.int64()),
                                              *[pa.array(m, pa.int64()) for m in marks], pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=names)
        used, raw = counts.rows()
        n = len(used)
        yield pa.RecordBatch.from_arrays([pa.nulls(n, id_type), *[pa.nulls(n, pa.int64())] * (2 + ROUNDS), pa.array(used, pa.int32()), pa.array(raw, pa.binary())], names=names)
    return run


ENTRY = "key long, part int, info long, cid long, n int, core int"     # info: position in the set's order, parts, first
MARKS = [f"mark{r}" for r in range(ROUNDS)]


def _entries(levels, light: int, percent: int):
    """Subset rows (part -1, first: same sizes) and list rows (first: in the index prefix) of each class;
    core: how common its shingles are, on the whole."""
    def rows_of(s: np.ndarray, table: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
        n, out = len(s), []
        rarity = table[sketch.place(s)]
        core = int(rarity.mean() * 256)
        if n <= light:
            members = s.tolist()
            for a, b, c in subset_keys(n, percent):
                raw = np.array(list(combinations(members, c)), np.uint64).reshape(-1, c)
                keys = np.array([xxhash.xxh3_64_intdigest(r.tobytes(), seed=a * 1000 + b) for r in raw], np.uint64)
                out.append((keys, np.full(len(keys), -1), np.full(len(keys), a == b), core))
        if 100 * n > percent * light:
            index = min(n, n - need(n, n, percent) + MEETINGS)
            probe = min(n, n - -(-percent * n // 100) + MEETINGS) if n > light else index
            order = np.lexsort((s, rarity))[:probe]
            parts = 1 + (sketch.count_at(rarity[order].astype(float)) // HOT_LIST).astype(np.int64)
            out.append((s[order], parts, np.arange(len(order)) < index, core))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            give_back()
            data, offsets = X.utf8(batch.column(0))
            for lo, hi in X.slices(offsets):
                sets = X.shingle_sets(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], SHINGLE)
                found, owners, sizes = [], [], []
                for s, c in zip(sets, _class_ids(sets).tolist()):
                    if len(s) and c not in met:
                        met.add(c)
                        for x in rows_of(s, levels.value):
                            found.append(x)
                            owners.append(c)
                            sizes.append(len(s))
                if not found:
                    continue
                reps = [len(x[0]) for x in found]
                cid = np.repeat(np.array(owners, np.int64), reps)
                parts = np.concatenate([x[1] for x in found])
                part = np.where(parts > 0, cid % np.maximum(parts, 1), -1)
                position = np.concatenate([np.arange(k) for k in reps])
                info = (position << 32) + np.maximum(parts, 0) * 2 + np.concatenate([x[2] for x in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([x[0] for x in found]).view(np.int64)), pa.array(part.astype(np.int32)), pa.array(info.astype(np.int64)),
                     pa.array(cid), pa.array(np.repeat(np.array(sizes, np.int32), reps)), pa.array(np.repeat(np.array([x[3] for x in found], np.int32), reps))],
                    names=["key", "part", "info", "cid", "n", "core"])
    return run


def _sets(wanted):
    """(cid, set) of the classes that a bit table lets through, each once a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            give_back()
            data, offsets = X.utf8(batch.column(0))
            for lo, hi in X.slices(offsets):
                sets = X.shingle_sets(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], SHINGLE)
                cids = _class_ids(sets)
                through = wanted.value[sketch.place(X.mix(cids.view(np.uint64).copy()))]
                rows = []
                for i, c in enumerate(cids.tolist()):
                    if through[i] and c not in met and len(sets[i]):
                        met.add(c)
                        rows.append(i)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(cids[rows]), pa.array([sets[i].view(np.int64) for i in rows], pa.list_(pa.int64()))], names=["cid", "shingles"])
    return run


def _mixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64).copy()
        yield pa.RecordBatch.from_arrays([pa.array(X.mix(raw).view(np.int64))], names=["cid"])


def sets_of(classes: DataFrame, texts: DataFrame) -> tuple[DataFrame, Broadcast]:
    """(cid, shingles), each once, of ``classes`` (cid, distinct) and of few others; with the bit table it needs."""
    wanted = classes.sparkSession.sparkContext.broadcast(sketch.filter_of(classes.mapInArrow(_mixed, "cid long")))
    return texts.mapInArrow(_sets(wanted), "cid long, shingles array<long>").dropDuplicates(["cid"]), wanted


def verified(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The (written) pairs (u, v) of classes whose whole sets are similar enough, written.

    Sets are made from the texts for the classes of these pairs alone: they are shuffled once and never written."""
    sets, wanted = sets_of(pairs.select(F.explode(F.array("u", "v")).alias("cid")).distinct(), texts)
    joined = pairs.join(sets.select(F.col("cid").alias("u"), F.col("shingles").alias("s")), "u")
    joined = joined.join(sets.select(F.col("cid").alias("v"), F.col("shingles").alias("t")), "v")
    common = F.size(F.array_intersect("s", "t"))
    found = stored(joined.filter(common * (100 + percent) >= percent * (F.size("s") + F.size("t"))).select("u", "v"), "verified")
    wanted.unpersist()
    return found


def _pair(a: str, b: str):
    return F.least(a, b).alias("u"), F.greatest(a, b).alias("v")


def similar_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every document row."""
    spark = ready(docs)
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    texts = docs.select("text")
    from pyspark.sql.pandas.types import to_arrow_type
    id_type = docs.schema["doc_id"].dataType
    members = stored(docs.mapInArrow(_members(to_arrow_type(id_type)), f"doc_id {id_type.simpleString()}, n long, cid long, {', '.join(m + ' long' for m in MARKS)}, segment int, counts binary"), "members")
    levels = sketch.summed(members.filter("segment is not null").select("segment", "counts"))
    members = members.filter("cid is not null").select("doc_id", "n", "cid", *MARKS)
    small = members.filter((F.col("n") > 0) & (F.col("n") <= 100 * MAX_LIGHT // percent)).select("cid", "n").distinct()
    light = boundary({r["n"]: r["k"] for r in small.groupBy("n").agg(F.count("*").alias("k")).collect()}, percent)

    # entries of lists and subset keys with at least two classes
    table = spark.sparkContext.broadcast(levels)
    entries = texts.mapInArrow(_entries(table, light, percent), ENTRY)
    together = Window.partitionBy("key", "part")
    met = entries.withColumns({"low": F.min("cid").over(together), "top": F.max("cid").over(together),
                               "entries": F.count("*").over(together), "hub": F.max(F.struct("core", "cid", "n")).over(together)})
    met = met.withColumns({"first": F.col("info").bitwiseAND(1) == 1, "parts": F.shiftright(F.col("info"), 1).bitwiseAND(2**31 - 1), "position": F.shiftright("info", 32)})
    met = stored(met.filter("low != top or parts > 1").withColumn("long", F.expr(f"entries >= {LONG_LIST} or parts > 1")).drop("low", "top", "core", "info", "entries").dropDuplicates(["key", "part", "cid"]), "lists")
    table.unpersist()

    subsets = met.filter("part = -1")
    ends = subsets.groupBy("key").agg(F.min(F.struct("n", "cid")).alias("lo"), F.max(F.struct("n", "cid")).alias("hi"))
    subsets = subsets.join(ends, "key")
    same = subsets.filter("first and cid != hub.cid").select(*_pair("cid", "hub.cid"))
    other = F.when(F.col("n") == F.col("lo.n"), F.col("hi.cid")).otherwise(F.col("lo.cid"))
    unlike = subsets.filter("not first and lo.n < hi.n").withColumn("o", other).select(*_pair("cid", "o"))
    exact = same.unionByName(unlike).distinct()

    lists = met.filter("part >= 0").select("key", "part", "parts", "cid", "n", "first", "position", "long", "hub")
    own = Window.partitionBy("cid")
    before = own.orderBy("position", "key").rowsBetween(Window.unboundedPreceding, -1)
    kept = F.when(F.col("long"), F.count_if("long").over(before)).otherwise(F.count("*").over(before))
    marks = members.filter("n > 0").select("cid", *MARKS).dropDuplicates(["cid"])
    often = lists.withColumns({"lists": F.count("*").over(own), "most": F.col("n") - (F.col("position") - kept)})
    often = often.filter(F.col("lists") >= F.least(F.lit(MEETINGS), F.ceil(F.col("n") * percent / 100)))
    lists = stored(often.drop("lists", "position").join(marks, "cid"), "candidates")
    alike = lambda n, m: (n * 100 >= m * percent) & (m * 100 >= n * percent)
    to_hub = lists.filter((F.col("cid") != F.col("hub.cid")) & alike(F.col("n"), F.col("hub.n"))).select(*_pair("cid", "hub.cid"), "n")
    hubs = lists.filter("parts > 1").groupBy("key").agg(F.collect_set("hub").alias("hubs")).select(F.array_max("hubs").alias("m"), F.explode("hubs").alias("hub"))
    hubs = hubs.filter((F.col("m.cid") != F.col("hub.cid")) & alike(F.col("m.n"), F.col("hub.n"))).select(*_pair("m.cid", "hub.cid"), F.lit(MEETINGS).alias("n"))
    stars = to_hub.unionByName(hubs).groupBy("u", "v").agg(F.count("*").alias("k"), F.min("n").alias("n"))
    stars = stored(stars.filter(F.col("k") >= F.least(F.lit(MEETINGS), "n")).select("u", "v"), "stars")
    joined = components(exact.unionByName(verified(stars, texts, percent)))
    lists = lists.drop("hub", "parts")

    def may_link(n, m, a, b):
        """Sizes n and m, of which at most a and b are shared, are not too far apart for a link."""
        return alike(n, m) & ((n + m) * percent <= F.least(a, b) * (100 + percent))

    def named_lists() -> DataFrame:
        names = joined.select(F.col("u").alias("cid"), F.col("v").alias("c"))
        return lists.join(names, "cid", "left").withColumn("comp", F.coalesce("c", "cid")).drop("c")

    # neighbours in the orders of all min-hashes, in one pass over the lists
    follow = lambda mark: F.lead(F.struct("cid", "n", "comp", "most")).over(Window.partitionBy("key", "part").orderBy(mark, "cid"))
    walk = named_lists().withColumns({f"next{r}": follow(mark) for r, mark in enumerate(MARKS)})
    walk = walk.select("cid", "n", "comp", "most", F.posexplode(F.array(*(f"next{r}" for r in range(ROUNDS)))).alias("round", "next"))
    walk = walk.filter((F.col("comp") != F.col("next.comp")) & may_link(F.col("n"), F.col("next.n"), F.col("most"), F.col("next.most")))
    walk = walk.groupBy(*_pair("cid", "next.cid"), "round").agg(F.count("*").alias("k"), F.min(F.least("n", "next.n")).alias("n"))
    walk = walk.filter(F.col("k") >= F.least(F.lit(MEETINGS), "n")).select("u", "v").distinct()
    walk = stored(walk.join(stars, ["u", "v"], "left_anti"), "walked")
    if not walk.isEmpty():
        joined = components(joined.unionByName(verified(walk, texts, percent)))

    # what still meets across components
    named = named_lists().select("key", "cid", "n", "first", "comp", "most", "long")
    mixed = named.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b"), F.min("n").alias("smallest")).filter("a != b").select("key", "smallest")
    reaches = (F.col("n") + F.col("smallest")) * percent <= F.col("most") * (100 + percent)      # the smallest set of its list, at least
    open_ = stored(named.join(mixed, "key").filter(reaches).drop("smallest"), "open")
    index = F.when(F.col("n") < F.col("n2"), F.col("first")).when(F.col("n") > F.col("n2"), F.col("first2")).otherwise(F.col("first") | F.col("first2"))
    fits = index & may_link(F.col("n"), F.col("n2"), F.col("most"), F.col("most2"))
    sizes = open_.groupBy("key", "comp", "n").agg(F.max("most").alias("most"), F.bool_or("first").alias("first"))
    second = {c: f"{c}2" for c in ("comp", "cid", "n", "first", "most", "long")}
    meet = sizes.join(sizes.withColumnsRenamed(second), "key").filter((F.col("comp") < F.col("comp2")) & fits).select("key", "comp", "n", "comp2", "n2")
    cross = meet.join(open_, ["key", "comp", "n"]).join(open_.withColumnsRenamed(second), ["key", "comp2", "n2"]).filter(fits)
    least = F.ceil(percent * (F.col("n") + F.col("n2")) / (100 + percent))
    cross = cross.groupBy(*_pair("cid", "cid2")).agg(F.count("*").alias("k"), F.min(least).alias("least"), F.bool_and("long").alias("long"))
    cross = cross.filter(~F.col("long") | (F.col("k") >= F.least(F.lit(MEETINGS), "least"))).select("u", "v")
    cross = stored(cross.join(stars.unionByName(walk), ["u", "v"], "left_anti"), "pairs")
    if not cross.isEmpty():
        joined = components(joined.unionByName(verified(cross, texts, percent)))

    labelled = members.filter("n > 0").join(joined.select(F.col("u").alias("cid"), F.col("v").alias("c")), "cid", "left").select("doc_id", "n", F.coalesce("c", "cid").alias("comp"))
    names = labelled.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    out = labelled.join(names, "comp").select("doc_id", "n", "component_id")
    return out.unionByName(members.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))).select(
        F.col("doc_id").alias(doc_id), F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without near-copies: of every component the document with the smallest id stays.

    What goes is joined by id, so texts are shuffled only if that is much. Rows that repeat a
    document (id and text) become one; rows without an id can't be named and stay."""
    found = stored(similar_components(docs, doc_id, text), "found")
    stays = F.col(doc_id) == F.col("component_id")
    repeated = found.groupBy(doc_id).count().filter("count > 1").select(doc_id)
    once = docs.join(found.filter(~stays).select(doc_id).unionByName(repeated).distinct(), doc_id, "left_anti")
    several = docs.join(repeated, doc_id, "left_semi").join(found.filter(stays).select(doc_id).distinct(), doc_id, "left_semi")
    return once.select(*docs.columns).unionByName(several.dropDuplicates([doc_id, text]).select(*docs.columns))
