"""Hashed count tables of a fixed size, filled by all tasks and summed by segments.

A table has a fixed number of counters. Each task adds up its own, emits those of a segment as one
row, and the rows of a segment are summed one after the other, so no task holds more than the
table. What reaches the driver is one byte a counter (a logarithm): 4 MB for 22 bits.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 22
SEGMENT = 1 << 16
SCHEMA = "segment int, counts binary"


class Counts:
    """One task's counters."""

    def __init__(self, size: int = 1 << BITS):
        self.table = np.zeros(size, np.uint32)

    def add(self, places: np.ndarray, by: np.ndarray | int = 1) -> None:
        np.add.at(self.table, places, np.broadcast_to(np.asarray(by, np.uint32), places.shape))

    def rows(self) -> tuple[list[int], list[bytes]]:
        parts = self.table.reshape(-1, min(SEGMENT, len(self.table)))
        used = [i for i in range(len(parts)) if parts[i].any()]
        return used, [zlib.compress(parts[i].astype("<u4").tobytes(), 1) for i in used]


def place(hashes: np.ndarray, bits: int = BITS) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def level(counts: np.ndarray) -> np.ndarray:
    """A count as one byte: 8 steps to every doubling."""
    return np.minimum(255, np.rint(np.log2(1.0 + counts) * 8)).astype(np.uint8)


def count_at(levels: np.ndarray) -> np.ndarray:
    """About the count that a level stands for."""
    return np.exp2(levels / 8.0) - 1


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for s, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            more = np.frombuffer(zlib.decompress(raw), "<u4").astype(np.int64)
            total[s] = total[s] + more if s in total else more
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([level(x).tobytes() for x in total.values()], pa.binary())], names=["segment", "counts"])


def summed(parts: DataFrame, size: int = 1 << BITS, tasks: int | None = None) -> np.ndarray:
    """The levels of the whole table from the tasks' rows, by a task a segment or by ``tasks``."""
    width = min(SEGMENT, size)
    out = np.zeros(size, np.uint8)
    for s, raw in parts.repartition(tasks or size // width, F.col("segment")).mapInArrow(_sum, SCHEMA).collect():
        out[s * width:(s + 1) * width] = np.frombuffer(raw, np.uint8)
    return out


def _one_column(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = Counts()
    for batch in batches:
        own.add(place(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)))
    used, raw = own.rows()
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(raw, pa.binary())], names=["segment", "counts"])


def filter_of(values: DataFrame) -> np.ndarray:
    """A bit table of one column of (well mixed) longs: true for every one of them, mostly false else."""
    return summed(values.mapInArrow(_one_column, SCHEMA)) > 0
