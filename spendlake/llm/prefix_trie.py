"""The trie of turn sequences, by van Emde Boas recursion over Spark shuffles.

A forest of height 2B is cut at half its height: the sequences' first halves make an upper trie, every
distinct half (a cut prefix) gets a name, and what follows each cut prefix makes a lower tree of height
B. Upper trie and lower trees are forests of height B again, and all forests of a height are handled
together as rows of one table, so a trie of depth D takes log2(D) steps in each direction:

1. *contents*: a digest of every aligned run of 1, 2, 4, ... turns, each from its two halves;
2. *names, downward*: the root of a lower tree is named by the name of the tree it was cut from and
   the contents of the half above it, until trees have height 1. Names are SHA-256 digests, so equal
   prefixes get equal names wherever they are computed, and no hot prefix is looked up;
3. *totals, upward*: trees of height B have the totals of their own subtrees; the root of a lower tree
   adds its totals to the B nodes above it in the upper trie. A node adds to log2(D) ranges of
   ancestors instead of to each of its D ancestors in one go per level.

A conversation is never put into one row or task: turns are rows, numbered within a conversation from
range partitions, and all joins go by (conversation, place). Texts leave the plan in the first scan (role
and text become a digest and a length). Sums by name are combined within map tasks first.

Input rows: a null role or text is empty, a null turn comes first, equal turns are ordered by role, then
by the digest of their text; repeated rows are turns of their own. Rows without a conversation id belong
to no conversation and are left out. Other columns are not read; an empty table gives an empty trie (no
root). Member ids of a node are digested in streams of ``CHUNK`` ids, so no row holds all ids of a hot node.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlake.llm.frames import ready, stored

CHUNK = 1 << 16
ROOT = b"root"


# --------------------------------------------------------------------------- #
# Sequences
# --------------------------------------------------------------------------- #
def numbered_turns(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, place, symbol, size): the turns of every conversation, numbered from 0.

    Partitions are ranges of (conversation, turn), so one conversation may span many of them. Each task
    numbers its own rows; what the partitions before hold of a conversation is added from a table of
    one row for each (partition, conversation) at a partition's border."""
    spark = ready(rows)
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    own = rows.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"),
        F.unhex(F.sha2(F.concat_ws(":", F.length(role).cast("string"), role, text).cast("binary"), 256)).alias("symbol"), F.length(text).cast("long").alias("size"))
    same = ["conv", "turn", "role", "symbol", "size"]
    own = own.groupBy(*same).agg(F.count("*").alias("times"))       # copies of a row travel as one
    order = [F.col(c).asc_nulls_first() for c in same]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, place = None, 0
        for batch in batches:
            first = []
            for conv, times in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                last, place = conv, place if conv == last else 0
                first.append(place)
                place += times
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first, pa.int64())], names=["conv", "symbol", "size", "times", "part", "first"])
    ranged = own.repartitionByRange(n, *order).sortWithinPartitions(*order).select("conv", "symbol", "size", "times", F.spark_partition_id().alias("part"))
    ranged = stored(ranged.mapInArrow(number, "conv long, symbol binary, size long, times long, part int, first long"), "numbered")
    held = ranged.groupBy("conv", "part").agg(F.sum("times").alias("held"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = held.withColumn("before", F.sum("held").over(earlier)).filter("before > 0").select("conv", "part", "before")   # at most one row a partition
    turns = ranged.join(F.broadcast(before), ["conv", "part"], "left").withColumn("first", F.col("first") + F.coalesce("before", F.lit(0)))
    return turns.select("conv", F.explode(F.expr("sequence(first, first + times - 1)")).alias("place"), "symbol", "size")


def rebuilt(turns: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """(conv, place, symbol, size): the first h turns of conversation c - c % ``group``, then c's own
    after its first h; h = crc32(c) % ``most``."""
    turns = stored(turns, "turns")
    heads = turns.filter(F.col("place") < most - 1)
    convs = turns.filter("place = 0").select("conv")
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    base = convs.select("conv", (F.col("conv") - F.col("conv") % group).alias("base"), h.alias("h"))
    taken = base.join(heads.withColumnRenamed("conv", "base"), "base").filter("place < h").select("conv", "place", "symbol", "size")
    kept = turns.withColumn("h", h).filter("place >= h").drop("h")
    # a base of fewer than h turns leaves a gap before c's own turns: they move up by it
    lengths = taken.groupBy("conv").agg(F.count("*").alias("n"))
    kept = kept.join(base.select("conv", "h").join(lengths, "conv", "left").select("conv", (F.col("h") - F.coalesce("n", F.lit(0))).alias("gap")), "conv")
    return taken.unionByName(kept.select("conv", (F.col("place") - F.col("gap")).alias("place"), "symbol", "size"))


# --------------------------------------------------------------------------- #
# The recursion
# --------------------------------------------------------------------------- #
def _contents(turns: DataFrame, levels: int) -> list[DataFrame]:
    """For k = 0 to ``levels`` - 1: (conv, run, digest) of the whole aligned runs of 2^k turns."""
    out = [turns.select("conv", F.col("place").alias("run"), F.col("symbol").alias("digest"))]
    for _ in range(levels - 1):
        odd = F.col("run") % 2 == 1
        halves = out[-1].groupBy("conv", F.shiftright("run", 1).alias("run")).agg(
            F.max(F.when(~odd, F.col("digest"))).alias("a"), F.max(F.when(odd, F.col("digest"))).alias("b"))
        out.append(stored(halves.filter("a IS NOT NULL AND b IS NOT NULL").select("conv", "run", F.unhex(F.sha2(F.concat("a", "b"), 256)).alias("digest")), "contents"))
    return out


def _names(convs: DataFrame, turns: DataFrame, levels: int) -> DataFrame:
    """(conv, depth, name): the names of all prefixes of every sequence."""
    runs = _contents(turns, levels)
    trees = convs.select("conv", F.lit(0).cast("long").alias("run"), F.lit(ROOT).alias("name"))
    for k in range(levels - 1, -1, -1):     # trees of height 2^(k+1) are cut into trees of height 2^k
        upper = trees.select("conv", (F.col("run") * 2).alias("run"), "name")
        lower = upper.join(runs[k].select("conv", "run", "digest"), ["conv", "run"]).select(
            "conv", (F.col("run") + 1).alias("run"), F.unhex(F.sha2(F.concat("name", "digest"), 256)).alias("name"))
        trees = stored(upper.unionByName(lower), "trees")
    return trees.select("conv", F.col("run").alias("depth"), "name")


def _grafted(totals: DataFrame, names: DataFrame, levels: int) -> DataFrame:
    """(name, leaves, saved) of whole subtrees from the nodes' own."""
    for k in range(levels):
        height = 1 << k
        # roots of lower trees of this height stand at odd multiples of it
        roots = totals.filter(F.shiftright("depth", k) % 2 == 1).filter(F.col("depth") % height == 0)
        above = names.select(F.col("conv").alias("first_conv"), F.shiftright("depth", k).alias("tree"), "depth", "name")
        added = roots.select("first_conv", (F.shiftright("depth", k) - 1).alias("tree"), "leaves", "saved").join(above, ["first_conv", "tree"])
        # each ancestor's own row keeps its depth and first conversation; what is added has none
        added = added.select("name", "leaves", "saved", F.lit(None).cast("long").alias("depth"), F.lit(None).cast("long").alias("first_conv"))
        both = totals.unionByName(added).groupBy("name").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("depth").alias("depth"), F.max("first_conv").alias("first_conv"))
        totals = stored(both, "totals")
    return totals.select("name", "leaves", "saved")


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each name's ids from chunks in order; the chunks of a name follow one another."""
    name, state = None, None

    def digests(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.binary()), pa.array([x[1] for x in done], pa.string())], names=["name", "ends_sha256"])
    for batch in batches:
        done = []
        for n, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if n == name:
                state.update(b"," + ids.encode())
            else:
                if name is not None:
                    done.append((name, state.hexdigest()))
                name, state = n, hashlib.sha256(ids.encode())
        yield digests(done)
    yield digests([(name, state.hexdigest())] if name is not None else [])


def ends(finished: DataFrame) -> DataFrame:
    """(name, ends_sha256) from (name, conv), the conversations that end at a node."""
    some = finished.groupBy("name", F.expr(f"conv div {CHUNK} - CASE WHEN conv % {CHUNK} < 0 THEN 1 ELSE 0 END").alias("chunk")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda x: x.cast("string")), ",").alias("ids"))
    return some.repartition("name").sortWithinPartitions("name", "chunk").select("name", "ids").mapInArrow(_end_digests, "name binary, ends_sha256 string")


def prefix_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row a node of the trie of ``turns`` (conv, place from 0, symbol, size) over all ``convs`` (conv):
    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    convs, turns = stored(convs.select("conv").distinct(), "convs"), stored(turns, "sequences")
    longest = turns.agg(F.max("place")).first()[0]
    levels = 0 if longest is None else int(longest + 1).bit_length()
    names = _names(convs, turns, levels) if levels else convs.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("name"))
    sizes = turns.select("conv", (F.col("place") + 1).alias("depth"), "size")
    members = stored(names.join(sizes, ["conv", "depth"], "left"), "members")
    nodes = members.groupBy("name").agg(F.min("conv").alias("first_conv"), F.max("depth").alias("depth"), F.count("*").alias("n_convs"), F.max("size").alias("size"))
    # a node's parent is what its first member passes one turn before
    above = members.select(F.col("conv").alias("first_conv"), (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    nodes = stored(nodes.join(above, ["first_conv", "depth"], "left"), "nodes")
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    last = members.groupBy("conv").agg(F.max(F.struct("depth", "name")).alias("last")).select("conv", "last.name")
    nodes = stored(nodes.join(children, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))).join(ends(last), "name", "left"), "nodes")
    own = nodes.select("name", "first_conv", "depth", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"),
                       ((F.col("n_convs") - 1) * F.coalesce("size", F.lit(0))).alias("saved"))
    totals = _grafted(stored(own, "totals"), members.select("conv", "depth", "name"), levels)
    # only a node with children is looked up as a parent
    parents = nodes.filter("n_children > 0").select(F.col("name").alias("parent"), F.col("first_conv").alias("parent_conv_id"))
    out = stored(nodes.join(totals, "name"), "nodes").join(parents, "parent", "left")
    return out.select(F.col("first_conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
                      F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))


def conversation_trie(rows: DataFrame, group: int = 100, most: int = 6, **columns) -> DataFrame:
    """The trie of rebuilt conversations (see ``rebuilt``) of a table of turns."""
    turns = stored(numbered_turns(rows, **columns), "turns")
    return prefix_trie(turns.filter("place = 0").select("conv"), rebuilt(turns, group, most))
