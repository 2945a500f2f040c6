"""Vectorised words, word hashes and word windows over Arrow string columns.

A text column is handled as one byte buffer with offsets. Words are maximal runs of bytes
outside a separator class, so every multi-byte UTF-8 character is a word character. All
arrays are bounded by ``SLICE`` bytes of text (or by one text, if that is longer).
"""
from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE = 1 << 20     # bytes of text handled at once
BLOCK = 1 << 18     # bytes hashed at once
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: After lower-casing A-Z: everything in ASCII but digits and letters.
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (in place): every input bit reaches every output bit."""
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_R = 0x9E3779B97F4A7C15
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(_R))
_ODD = mix(np.arange(1, 65, dtype=np.uint64) * _U(_R)) | _U(1)
_UP = np.cumprod(np.full(BLOCK + 1, _R, np.uint64))
_DOWN = np.cumprod(np.full(BLOCK + 1, pow(_R, -1, 1 << 64), np.uint64))


class Words(NamedTuple):
    """``first[d]:first[d + 1]`` are the words of text d; starts and ends are byte places."""
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string column; a null text is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    buffers = col.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``size`` bytes, or of one text."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def find_words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE) -> Words:
    gap = separators[data]
    cut = np.unique(offsets[(offsets > 0) & (offsets < len(data))])
    before, after = np.ones(len(data), bool), np.ones(len(data), bool)
    before[1:], after[:-1] = gap[:-1], gap[1:]
    before[cut], after[cut - 1] = True, True
    start = np.flatnonzero(~gap & before)
    return Words(start, np.flatnonzero(~gap & after) + 1, np.searchsorted(start, offsets))


def word_hashes(data: np.ndarray, words: Words) -> np.ndarray:
    """A 64-bit hash of every word's bytes, by differences of a running polynomial."""
    out = np.empty(len(words.start), np.uint64)
    lo, n = 0, len(out)
    while lo < n:
        base = words.start[lo]
        hi = max(lo + 1, int(np.searchsorted(words.end, base + BLOCK, side="right")))
        if words.end[hi - 1] - base > BLOCK:    # one very long word
            out[lo] = xxhash.xxh3_64_intdigest(data[base:words.end[lo]].tobytes())
        else:
            block = _BYTE[data[base:words.end[hi - 1]]]
            block *= _UP[:len(block)]
            total = np.zeros(len(block) + 1, np.uint64)
            np.cumsum(block, out=total[1:])
            a, b = words.start[lo:hi] - base, words.end[lo:hi] - base
            out[lo:hi] = (total[b] - total[a]) * _DOWN[a] + (b - a).astype(np.uint64) * _U(_R)
        lo = hi
    return mix(out)


def windows(hashes: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of the k words from each place on (texts not regarded)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, seed * 64 + k, np.uint64)
    for j in range(k):
        out += hashes[j:j + n] * _ODD[j % 64]
    return mix(out)


def text_of_word(words: Words) -> np.ndarray:
    return np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))


def sums_by_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags each text has."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its k-word shingles, A-Z lower-cased.

    A text of fewer words, but not none, has its whole sequence as its one shingle."""
    data = LOWER[data]
    words = find_words(data, offsets)
    hashes = word_hashes(data, words)
    whole = windows(hashes, k)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(whole[a:b - k + 1]))
        else:
            out.append(windows(hashes[a:b], b - a) if b > a else whole[:0])
    return out
