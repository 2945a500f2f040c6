"""Quality rules by compression bands.

A text is compressed with zstandard as a whole and in fixed chunks. Text that repeats itself
compresses far below, and noise far above, what prose of the same length does, so each length
class has its own band of allowed ratios (compressed bytes / bytes), for the whole and for its
chunks. Counts of words, symbols, repeated lines and repeated windows go with it.

Defined cases: a null text counts as an empty one; an empty text has ratios of null, no words
and fails the base rule. A very long text is compressed chunk by chunk and as a whole stream.
Each row is judged by itself, so ties, repeated rows and hot keys need no care, and columns
with the names of the result are replaced.
"""
from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from spendlake.llm import text as X
from spendlake.llm.frames import map_batches, ready, with_columns

LEVEL = 3
CHUNK = 4096
WINDOW = 8
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


class Band(NamedTuple):
    """Allowed ratios of texts of at least ``min_bytes`` (the last that fits holds)."""
    min_bytes: int
    low: float
    high: float


#: Upper limits by size: just above the highest ratio of clean texts cut to that size, in the four languages of the
#: tables, and below the ratio of random base64 at the next size. Under 128 bytes the two can't be told apart.
HIGH = ((0, 1.60), (128, 1.00), (144, 0.97), (160, 0.95), (192, 0.91), (256, 0.83), (384, 0.78), (512, 0.73), (768, 0.69),
        (1024, 0.65), (1536, 0.62), (16384, 0.60))
#: Lower limits by size, of whole texts and of chunks.
WHOLE_LOW = ((0, 0.35), (512, 0.28), (2048, 0.23), (16384, 0.20))
CHUNK_LOW = ((0, 0.0), (512, 0.28), (2048, 0.22))


def bands(low: tuple, high: tuple) -> tuple[Band, ...]:
    """A band for each size at which one of the limits changes."""
    at = lambda limits, size: [x for least, x in limits if least <= size][-1]
    return tuple(Band(size, at(low, size), at(high, size)) for size in sorted({x[0] for x in low + high}))


#: Whole texts. Prose of any length lies well inside: a short text has little to refer back to,
#: a long one approaches the entropy of its language.
WHOLE_BANDS = bands(WHOLE_LOW, HIGH)
#: Chunks of CHUNK bytes (the last may be shorter); a share of up to MAX_BAD_CHUNKS may lie outside.
CHUNK_BANDS = bands(CHUNK_LOW, ((0, 9.0), *HIGH[1:]))
#: A share of a text's bytes; the last chunk counts by its size.
MAX_BAD_CHUNKS = 0.10

COLUMNS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, whole_ratio double, n_chunks long, n_bad_chunks long, band string, kept boolean")


def outside(ratio: float, size: int, bands: tuple[Band, ...]) -> str:
    """``low`` or ``high`` if the ratio lies outside the band of this size, else empty."""
    band = [b for b in bands if b.min_bytes <= size][-1]
    return "low" if ratio < band.low else "high" if ratio > band.high else ""


def repeated_words(hashes: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a window which the text has more than once."""
    grams = X.windows(hashes, window)
    if len(grams) < 2:
        return 0
    _, place, count = np.unique(grams, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(count[place] > 1)
    if not len(twice):
        return 0
    step = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(step, twice, 1)
    np.add.at(step, twice + window, -1)
    return int((np.cumsum(step[:-1]) > 0).sum())


def judge(raw: bytes, squeeze) -> tuple[float | None, int, int, str]:
    """Ratio of the whole, chunks, chunks outside their band, and the verdict's reason."""
    if not raw:
        return None, 0, 0, "empty"
    whole = squeeze(raw) / len(raw)
    chunks = [raw[i:i + CHUNK] for i in range(0, len(raw), CHUNK)]
    found = [outside(whole if len(chunks) == 1 else squeeze(c) / len(c), len(c), CHUNK_BANDS) for c in chunks]
    bad = sum(map(bool, found))
    reason = outside(whole, len(raw), WHOLE_BANDS)
    if not reason and sum(len(c) for c, x in zip(chunks, found) if x) > MAX_BAD_CHUNKS * len(raw):
        reason = "chunks " + max(("low", "high"), key=found.count)
    return whole, len(chunks), bad, reason


def quality_rules(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the counts, ratios and verdict of every text."""
    ready(docs)
    kept = [c for c in (docs.columns if keep is None else keep) if c not in {x.split()[0] for x in COLUMNS.split(", ")}]
    schema = with_columns(docs.select(*kept), COLUMNS)

    def run(batch: pa.RecordBatch) -> dict:
        data, offsets = X.utf8(batch.column(batch.schema.get_field_index(text)))
        squeeze_with = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        squeeze = lambda raw: len(squeeze_with.compress(raw))
        out = {name: [] for name in schema.names if name not in kept}
        for lo, hi in X.slices(offsets):
            part, offs = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
            words = X.find_words(part, offs)
            hashes = X.word_hashes(part, words)
            inside = ~X.SPACE[part] & ((part & 0xC0) != 0x80)
            chars, symbols = X.sums_by_text(inside, offs), X.sums_by_text(SYMBOLS[part], offs)
            for d in range(hi - lo):
                raw = part[offs[d]:offs[d + 1]].tobytes()
                own = hashes[words.first[d]:words.first[d + 1]]
                lines = [x for x in raw.split(b"\n") if x.strip()]
                again = repeated_words(own)
                failed = len(own) < 20 or 100 * again > 30 * len(own)
                whole, n, bad, reason = judge(raw, squeeze)
                for name, value in (("n_words", len(own)), ("word_chars", int(chars[d])), ("n_symbols", int(symbols[d])),
                                    ("n_dup_lines", len(lines) - len(set(lines))), ("n_repeat_words", again),
                                    ("base_failed", failed), ("whole_ratio", whole), ("n_chunks", n),
                                    ("n_bad_chunks", bad), ("band", reason), ("kept", not failed and not reason)):
                    out[name].append(value)
        return out | {c: batch.column(batch.schema.get_field_index(c)) for c in kept}

    return map_batches(docs.select(*dict.fromkeys([*kept, text])), run, schema)
