"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

Documents longer than a sequence are cut into whole sequences (the first piece may be shorter).
The other pieces are dealt by hash into shards of about ``SHARD`` pieces. Every shard is packed
by several islands, each a group of its own in Spark: a population of packings starts from
best-fit orders; crossover injects well-filled bins of one parent into another, bins that hold
an injected piece are taken apart (so nothing is there twice) and displaced pieces are best-fit
again, largest first. After each epoch an island's elite migrates to the next island. Bins of
the best packing that stay badly filled are opened and their pieces dealt anew into larger shards,
round by round.

Defined cases: a null text is empty and gives the closing id alone; an empty table gives no
pieces; repeated rows are pieces of their own (numbered once, in a written table); ties between
packings go to the smaller island and rank. Results depend on the rows and on how they lie in files.
"""
from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlake.llm import tokens
from spendlake.llm.frames import ready, stored

SEQUENCE = 1024
CLOSING_ID = 2
SHARD = 1500            # pieces packed together: bounds an island's memory
ISLANDS, POPULATION = 2, 4
EPOCHS, GENERATIONS = 2, 6
GOOD_FILL = (0.998, 0.995, 0.99, 0.0)   # by round: bins filled less are opened and their pieces dealt anew
GROWTH = 4              # shards double from round to round, up to so many times SHARD
SOLUTION = "shard long, island int, rank int, sizes array<int>, bins array<array<int>>"


# ------------------------------------------------------------------ packings of one shard

def best_fit(order: list[int], sizes: list[int], bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Put the pieces into the fullest bins that have room, in this order."""
    room = [capacity - sum(sizes[i] for i in b) for b in bins]
    free = sorted((r, k) for k, r in enumerate(room))
    for i in order:
        at = bisect_left(free, (sizes[i], -1))
        if at < len(free):
            r, k = free.pop(at)
        else:
            r, k = capacity, len(bins)
            bins.append([])
        bins[k].append(i)
        insort(free, (r - sizes[i], k))
    return bins


def fitness(bins: list[list[int]], sizes: list[int], capacity: int) -> float:
    """Mean squared fill: prefers few bins, and full ones beside nearly empty ones."""
    return sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins) / max(1, len(bins))


def crossover(a: list[list[int]], b: list[list[int]], sizes: list[int], capacity: int, rng) -> list[list[int]]:
    """Well-filled bins of ``b`` go into ``a`` whole; pieces of bins that they break up are best-fit."""
    ranked = sorted(b, key=lambda x: (-sum(sizes[i] for i in x), x))
    top = ranked[:max(1, len(ranked) // 2)]
    given = [top[i] for i in sorted(rng.choice(len(top), max(1, len(top) // 2), replace=False))]
    moved = {i for x in given for i in x}
    kept = [list(x) for x in a if moved.isdisjoint(x)]
    displaced = [i for x in a if not moved.isdisjoint(x) for i in x if i not in moved]
    return best_fit(sorted(displaced, key=lambda i: (-sizes[i], i)), sizes, kept + [list(x) for x in given], capacity)


def mutate(bins: list[list[int]], sizes: list[int], capacity: int, rng) -> list[list[int]]:
    """Take the worst bin and a few others apart and best-fit their pieces."""
    fill = [sum(sizes[i] for i in b) for b in bins]
    out = {int(np.argmin(fill)), *rng.choice(len(bins), min(len(bins), 3), replace=False).tolist()}
    loose = [i for k in sorted(out) for i in bins[k]]
    return best_fit(sorted(loose, key=lambda i: (-sizes[i], i)), sizes, [list(b) for k, b in enumerate(bins) if k not in out], capacity)


def evolve(population: list[list[list[int]]], sizes: list[int], capacity: int, rng, generations: int = GENERATIONS,
           size: int = POPULATION) -> list[list[list[int]]]:
    """The population after some generations, best first; ends early at the lower bound."""
    least = -(-sum(sizes) // capacity)
    score = lambda x: (len(x), -fitness(x, sizes, capacity))
    while len(population) < size:
        if not population:
            order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
        else:
            noise = rng.random(len(sizes)) * 0.3 * capacity
            order = sorted(range(len(sizes)), key=lambda i: (-(sizes[i] + noise[i]), i))
        population.append(best_fit(order, sizes, [], capacity))
        if len(population[0]) <= least:
            break
    population.sort(key=score)
    for _ in range(generations):
        if len(population[0]) <= least or len(population) < 2:
            break
        i, j = rng.choice(len(population), 2, replace=False)
        child = crossover(population[i], population[j], sizes, capacity, rng)
        other = crossover(population[j], population[i], sizes, capacity, rng)
        population = sorted([*population, child, mutate(other, sizes, capacity, rng)], key=score)[:size]
    return population


def _epoch(capacity: int, epoch: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        shard, island = int(key[0]), int(key[1])
        rows = rows.sort_values("rank")
        sizes = list(map(int, rows["sizes"].iloc[0]))
        population = [[list(map(int, b)) for b in x] for x in rows["bins"] if x is not None and len(x)]
        found = evolve(population, sizes, capacity, np.random.default_rng([shard & 0xFFFFFFFF, island, epoch]))
        return pd.DataFrame({"shard": shard, "island": island, "rank": range(len(found)), "sizes": [sizes] * len(found), "bins": found})
    return run


def _migrated(state: DataFrame) -> DataFrame:
    """Each island's best packing also joins the next island, in place of its worst."""
    elite = state.filter("rank = 0").select("shard", ((F.col("island") + 1) % ISLANDS).cast("int").alias("island"), F.lit(POPULATION - 1).alias("rank"), "sizes", "bins")
    return state.filter(F.col("rank") < POPULATION - 1).unionByName(elite)


def pack_round(items: DataFrame, capacity: int, seed: int, shard: int) -> DataFrame:
    """(uid, length, shard, bin, place, fill) of every item (uid, length) by the islands' best packing."""
    shards = max(1, -(-items.count() // shard))
    dealt = stored(items.select("uid", "length", F.pmod(F.xxhash64("uid", F.lit(seed)), F.lit(shards)).alias("shard")), "dealt")
    sizes = dealt.groupBy("shard").agg(F.array_sort(F.collect_list("length")).cast("array<int>").alias("sizes"))
    state = sizes.select("shard", F.explode(F.array(*map(F.lit, range(ISLANDS)))).alias("island"), F.lit(0).alias("rank"), "sizes",
                         F.lit(None).cast("array<array<int>>").alias("bins"))
    # islands are few rows but much work: they are not left to be coalesced by their bytes
    tasks = min(shards * ISLANDS, int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    for epoch in range(EPOCHS):
        state = state.repartition(tasks, "shard", "island").groupBy("shard", "island").applyInPandas(_epoch(capacity, epoch), SOLUTION)
        if epoch + 1 < EPOCHS:
            state = _migrated(stored(state, "islands"))
    order = F.struct(F.size("bins"), "island", "rank")
    best = state.groupBy("shard").agg(F.min_by(F.struct("sizes", "bins"), order).alias("b")).select("shard", "b.sizes", "b.bins")
    # pieces of equal length are alike: the n-th of a length takes the n-th place for it
    slots = best.select("shard", "sizes", F.posexplode("bins").alias("bin", "own"))
    slots = slots.select("shard", "bin", F.posexplode(F.transform("own", lambda i: F.col("sizes")[i])).alias("place", "length"), F.aggregate(
        F.transform("own", lambda i: F.col("sizes")[i]), F.lit(0), lambda s, x: s + x).alias("fill"))
    nth = lambda *by: F.row_number().over(Window.partitionBy("shard", "length").orderBy(*by)).alias("nth")
    return dealt.select("uid", F.col("length").cast("int").alias("length"), "shard", nth("uid")).join(
        slots.select("*", nth("bin", "place")), ["shard", "length", "nth"]).select("uid", "length", "shard", "bin", "place", "fill")


def pack(items: DataFrame, capacity: int = SEQUENCE, good_fill: tuple = GOOD_FILL) -> DataFrame:
    """(uid, sequence_id, offset) of every item (uid long, length); lengths are at most the capacity."""
    done, left = [], items.select("uid", "length")
    for r, good in enumerate(good_fill):
        placed = stored(pack_round(left, capacity, r, SHARD * min(GROWTH, 1 << r)), "packed")
        shut = placed.filter(F.col("fill") >= good * capacity)
        done.append(shut.withColumn("round", F.lit(r)))
        left = placed.filter(F.col("fill") < good * capacity).select("uid", "length")
        if not good or left.isEmpty():
            break
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    before = Window.partitionBy("round", "shard", "bin").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    number = (F.col("shard") * (1 << 16) + F.col("bin")) * 8 + F.col("round")     # a shard has far fewer bins
    return out.select("uid", number.alias("sequence_id"), F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset"))


# ------------------------------------------------------------------ pieces of documents

PIECES = "doc_id {0}, piece int, start long, length long, ids_crc32 long"


def _pieces(path: str, capacity: int, id_type: pa.DataType):
    closing = np.array([CLOSING_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokens.encoder(path)
        for batch in batches:
            rows, piece, start, length, crc = [], [], [], [], []
            for d, ids in enumerate(own.slices(batch.column(1))):
                raw = ids.tobytes() + closing
                n = len(raw) // 4
                at = 0
                for k in range(-(-n // capacity)):
                    size = (n - 1) % capacity + 1 if k == 0 else capacity
                    rows.append(d)
                    piece.append(k)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(raw[4 * at:4 * (at + size)]))
                    at += size
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(id_type).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                                              pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def pack_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = SEQUENCE) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    from pyspark.sql.pandas.types import to_arrow_type
    ready(docs)
    kind = docs.schema[doc_id].dataType
    pieces = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(_pieces(path, capacity, to_arrow_type(kind)), PIECES.format(kind.simpleString()))
    pieces = stored(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    whole = pieces.filter(F.col("length") == capacity).withColumns({"sequence_id": -1 - F.col("uid"), "offset": F.lit(0).cast("long")})
    placed = pieces.join(pack(pieces.filter(F.col("length") < capacity), capacity), "uid").unionByName(whole)
    return placed.select(F.col("doc_id").alias(doc_id), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
