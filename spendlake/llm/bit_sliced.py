"""Exact top-k by inner product over a bit-sliced index.

Index: the rows are dealt into blocks of at most ``BLOCK`` rows. Of every dimension a block keeps the
``BITS`` highest bits of the values (less the block's smallest value there) as bit slices: one bitmap
over the block's rows for each bit. Whole values are kept beside them for the boundary rows.

Search of a query in a block, by bitmaps alone until the last step:

1. a query's weights are taken apart into powers of two; slices of one power (complemented where the
   weight is negative) are added three at a time by bitwise full adders until one bitmap a power is
   left: the bits of the quantised score of all rows at once;
2. the k highest quantised scores are selected from the most significant slice downward;
3. the bits left out can change a score by at most ``slack``. Rows whose quantised score is within it
   of the k-th, and of the k-th exact score so far, are selected by a second walk down the slices, and
   only these boundary rows get exact scores.

Nothing is left out: a row that is not scored exactly is proven to be below the k-th. Queries go in
passes of at most ``PASS_BYTES`` (broadcast, a size set beforehand); every pass reads all blocks, each
task keeps k rows a query, and the k of all tasks are merged in a shuffle by query.

Rows: components become floor(256 * x) with x as double. A vector that is null, or holds a null or
non-finite component, or one whose integer reaches 2^53, takes no part. Vectors of different lengths
are compared as if the shorter ended in zeros; an empty vector scores 0 everywhere. A query is a
row: two rows with one vec_id are two queries, each the other's candidate, and their results come twice.
A null vec_id is never a query and comes last in ties. Scores beyond 64 bits are computed
exactly and returned as the nearest long. Other columns are not read; an empty table gives no rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlake.llm.frames import ready, stored
from spendlake.session import scratch_path

BLOCK = 1 << 13
BITS = 6
PASS_BYTES = 32 << 20
LIMIT = float(1 << 53)
INDEX = "block long, n int, dims int, used int, shift int, ids binary, known binary, low binary, slices binary, whole binary"
FOUND = "query_id long, query_block long, query_row int, vec_id long, block long, row int, score decimal(38,0)"
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


# --------------------------------------------------------------------------- #
# Bitmap arithmetic
# --------------------------------------------------------------------------- #
def packed(flags: np.ndarray) -> np.ndarray:
    """Flags over rows (last axis) as 64-bit words."""
    wide = np.zeros((*flags.shape[:-1], -(-flags.shape[-1] // 64) * 64), bool)
    wide[..., :flags.shape[-1]] = flags
    return np.packbits(wide, axis=-1, bitorder="little").view("<u8")


def unpacked(bitmap: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(bitmap.view(np.uint8), bitorder="little")[:n].view(bool)


def count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def add_up(stacks: list[list[np.ndarray]], words: int) -> list[np.ndarray]:
    """Bitmaps to be added, by power of two, reduced to one bitmap a power by full adders."""
    out, power = [], 0
    while power < len(stacks):
        rest = np.concatenate(stacks[power]) if stacks[power] else np.zeros((0, words), np.uint64)
        while len(rest) > 1:
            third = len(rest) // 3
            if third:
                a, b, c = rest[:third], rest[third:2 * third], rest[2 * third:3 * third]
                either = a ^ b
                total, carry = either ^ c, (a & b) | (either & c)
                rest = np.concatenate([total, rest[3 * third:]])
            else:
                total, carry = rest[:1] ^ rest[1:], rest[:1] & rest[1:]
                rest = total
            if power + 1 == len(stacks):
                stacks.append([])
            stacks[power + 1].append(carry)
        out.append(rest[0] if len(rest) else np.zeros(words, np.uint64))
        power += 1
    return out


def kth_highest(sums: list[np.ndarray], among: np.ndarray, k: int) -> int:
    """The k-th highest sum of the rows in ``among`` (or their lowest), from the top slice down."""
    k = min(k, count(among))
    alike, value, above = among, 0, 0
    for power in range(len(sums) - 1, -1, -1):
        with_bit = alike & sums[power]
        n = count(with_bit)
        if above + n >= k:
            alike, value = with_bit, value | 1 << power
        else:
            above += n
            alike = alike & ~sums[power]
    return value


def at_least(sums: list[np.ndarray], among: np.ndarray, bound: int) -> np.ndarray:
    """The rows of ``among`` whose sum reaches ``bound``."""
    if bound <= 0:
        return among
    if bound >> len(sums):
        return np.zeros_like(among)
    more, alike = np.zeros_like(among), among
    for power in range(len(sums) - 1, -1, -1):
        if bound >> power & 1:
            alike = alike & sums[power]
        else:
            more |= alike & sums[power]
            alike = alike & ~sums[power]
    return more | alike


# --------------------------------------------------------------------------- #
# Index
# --------------------------------------------------------------------------- #
class Block:
    """One block of the index, as stored in a row."""

    def __init__(self, row: dict):
        self.n, self.dims, self.shift, self.block = row["n"], row["dims"], row["shift"], row["block"]
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.known = np.frombuffer(row["known"], bool)
        self.low = np.frombuffer(row["low"], "<i8")
        words = -(-self.n // 64)
        self.slices = np.frombuffer(row["slices"], "<u8").reshape(self.dims, row["used"], words)
        self.whole = np.frombuffer(row["whole"], "<i8").reshape(self.n, self.dims)
        self.rows = packed(np.ones(self.n, bool))
        self.both = np.stack([self.slices, self.slices ^ ONES])     # as they are; complemented

    def sums(self, weights: np.ndarray) -> list[np.ndarray]:
        """The slices of the quantised scores: sums of |weight| * (value, or its complement)."""
        size, sign = np.abs(weights), (weights < 0).astype(np.intp)
        stacks: list[list[np.ndarray]] = [[] for _ in range(int(size.max(initial=0)).bit_length() + self.slices.shape[1])]
        for bit in range(int(size.max(initial=0)).bit_length()):
            dims = np.flatnonzero(size >> bit & 1)
            for k in range(self.slices.shape[1] if len(dims) else 0):
                stacks[bit + k].append(self.both[sign[dims], dims, k])
        return add_up(stacks, len(self.rows))

    def top(self, query: np.ndarray, k: int, own: int | None, floor: int | None):
        """(rows, exact scores) of all rows that may be among the k highest, ``own`` left out.

        ``floor``: a score that k rows elsewhere have reached already."""
        weights = np.zeros(self.dims, np.int64)
        weights[:len(query)] = query[:self.dims]
        among = self.rows
        if own is not None:
            among = among.copy()
            among[own >> 6] &= ~(np.uint64(1) << np.uint64(own & 63))
        if not among.any():
            return np.zeros(0, np.int64), []
        sums = self.sums(weights)
        size = [int(x) for x in np.abs(weights)]
        slack = ((1 << self.shift) - 1) * sum(size)
        bound = kth_highest(sums, among, k) - (slack >> self.shift) - 1 if slack else kth_highest(sums, among, k)
        if floor is not None:
            # score = sum * 2^shift + constant + what the bits left out add, from -slack to slack
            top = (1 << self.slices.shape[1]) - 1
            constant = sum(int(w) * int(b) for w, b in zip(weights, self.low)) - (sum(s for s, w in zip(size, weights) if w < 0) * top << self.shift)
            bound = max(bound, (floor - constant - slack) >> self.shift)
        rows = np.flatnonzero(unpacked(at_least(sums, among, bound), self.n))
        return rows, exact_scores(self.whole[rows], weights)


def exact_scores(vectors: np.ndarray, weights: np.ndarray):
    """Inner products as Python integers, whatever their size."""
    reach = int(np.abs(vectors).max(initial=0)) * int(np.abs(weights).max(initial=0)) * max(1, vectors.shape[1])
    if reach < 1 << 62:
        return (vectors @ weights).tolist()
    return (vectors.astype(object) @ weights.astype(object)).tolist()


def block_row(block: int, ids: list, vectors: list[np.ndarray], bits: int) -> dict:
    dims = max(map(len, vectors))
    whole = np.zeros((len(vectors), dims), np.int64)
    for i, v in enumerate(vectors):
        whole[i, :len(v)] = v
    low = whole.min(axis=0) if dims else np.zeros(0, np.int64)
    above = whole - low
    width = int(above.max(initial=0)).bit_length()
    shift = max(0, width - bits)
    used = max(1, width - shift)
    quantised = (above >> shift).T
    slices = packed((quantised[:, None, :] >> np.arange(used)[None, :, None] & 1).astype(bool))
    known = np.array([x is not None for x in ids])
    return {"block": block, "n": len(ids), "dims": dims, "used": used, "shift": shift, "ids": np.array([x or 0 for x in ids], "<i8").tobytes(), "known": known.tobytes(),
            "low": low.astype("<i8").tobytes(), "slices": slices.astype("<u8").tobytes(), "whole": whole.astype("<i8").tobytes()}


def _integers(values) -> np.ndarray | None:
    if values is None or any(x is None for x in values):
        return None
    with np.errstate(over="ignore"):
        scaled = np.floor(np.asarray(values, np.float64) * 256)
    return scaled.astype(np.int64) if np.isfinite(scaled).all() and (np.abs(scaled) < LIMIT).all() else None


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK, bits: int = BITS) -> DataFrame:
    """The stored index of every row that takes part; a row of it is a block."""
    spark = ready(vectors)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    schema = to_arrow_schema(_parse_datatype_string(INDEX))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        ids, ready_rows = [], []
        for batch in batches:
            for i, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = _integers(values)
                if own is not None:
                    ids.append(i)
                    ready_rows.append(own)
                if len(ids) == block:
                    yield pa.RecordBatch.from_pylist([block_row(number, ids, ready_rows, bits)], schema=schema)
                    number, ids, ready_rows = number + 1, [], []
        if ids:
            yield pa.RecordBatch.from_pylist([block_row(number, ids, ready_rows, bits)], schema=schema)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    # few small partitions would make blocks of few rows: join neighbours, without a shuffle
    rows = rows.coalesce(max(1, -(-rows.count() // block)))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return stored(rows.mapInArrow(run, INDEX), "bit-slices")


# --------------------------------------------------------------------------- #
# Search
# --------------------------------------------------------------------------- #
def _queries_of(divisor: int):
    """(block, n, bytes) and the queries themselves: rows whose id is divisible by ``divisor``."""
    def pick(row: dict):
        ids, known = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["known"], bool)
        rows = np.flatnonzero(known & (ids % divisor == 0))
        whole = np.frombuffer(row["whole"], "<i8").reshape(row["n"], row["dims"])
        return ids[rows], rows, whole[rows]
    return pick


def passes(index: DataFrame, divisor: int, limit: int = PASS_BYTES) -> Iterator[list[tuple[int, int, int, np.ndarray]]]:
    """Queries in lists of at most ``limit`` bytes (or those of one row of a block): (id, block, row, vector).

    The queries are taken from the index as stored, so that a query's own row is known by its place."""
    pick = _queries_of(divisor)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, rows, vectors = pick(row)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array([row["block"]] * len(ids), pa.int64()), pa.array(rows.astype(np.int32)),
                                                  pa.array([v.tobytes() for v in vectors], pa.binary())], names=["id", "block", "row", "v"])
    found = stored(index.mapInArrow(run, "id long, block long, row int, v binary"), "queries")
    group, size = [], 0
    for r in found.toLocalIterator():       # one partition at a time; a pass is handed on before the next is read
        if group and size + len(r["v"]) + 64 > limit:
            yield group
            group, size = [], 0
        group.append((r["id"], r["block"], r["row"], np.frombuffer(bytes(r["v"]), "<i8")))
        size += len(r["v"]) + 64
    if group:
        yield group


def _search(index: DataFrame, queries: list, k: int, path: str) -> None:
    """Append the k best rows of each query in each task to ``path``."""
    sent = index.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal
        best: list[list] = [[] for _ in sent.value]     # (-score, id unknown, id, block, row), sorted
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                for own, (_, at, place, vector) in zip(best, sent.value):
                    floor = -own[k - 1][0] if len(own) >= k else None
                    rows, scores = block.top(vector, k, place if at == block.block else None, floor)
                    if len(rows):
                        ids, known = block.ids[rows].tolist(), block.known[rows].tolist()
                        own.extend(zip([-s for s in scores], [not x for x in known], ids, [block.block] * len(rows), rows.tolist()))
                        own.sort()
                        del own[k:]
        out = [(q[0], q[1], q[2], None if unknown else i, at, r, Decimal(-s)) for q, own in zip(sent.value, best) for s, unknown, i, at, r in own]
        columns = list(zip(*out)) or [[]] * 7
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.decimal128(38, 0)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["query_id", "query_block", "query_row", "vec_id", "block", "row", "score"])
    index.mapInArrow(run, FOUND).write.mode("append").parquet(path)
    sent.unpersist()


def top_k(vectors: DataFrame, divisor: int = 50, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK, bits: int = BITS, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest of every row whose id ``divisor`` divides."""
    spark = ready(vectors)
    index = build_index(vectors, id_col, vector_col, block, bits)
    path = scratch_path(spark, "found")
    spark.createDataFrame([], FOUND).write.parquet(path)
    for queries in passes(index, divisor, pass_bytes):
        _search(index, queries, k, path)
    found = spark.read.schema(FOUND).parquet(path)
    best = Window.partitionBy("query_block", "query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "block", "row")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    widest = F.lit(2 ** 63 - 1).cast("decimal(38,0)")
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.greatest(F.least("score", widest), -widest - 1).cast("long").alias("score"))
