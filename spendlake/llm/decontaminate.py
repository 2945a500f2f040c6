"""Benchmark decontamination by a broadcast hash set of test n-grams.

Every benchmark item gives its windows of ``n`` consecutive words (an item of fewer words is
one window). The windows are broadcast as a dictionary behind a bit table of their hashes;
training texts are scanned window by window, a place whose hash is set is verified word by
word, and the words inside verified windows are hit. ``remove_spans`` cuts them out or drops
texts that are mostly hit.

Size bound: at most ``max_windows`` windows are broadcast at once. A larger benchmark is dealt
into groups of that size, each group is one pass over the texts, and the hits found so far are
written between passes, so neither the driver nor a task ever holds more than one group.

Defined cases: a null or empty text has no words and no hits; items with a null id or text, or
without a word, have no windows; an item id that occurs in several rows has the windows of all
of them; each text row is judged by itself, so repeated rows give repeated results; columns
with the names of the result are replaced.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm import text as X
from spendlake.llm.frames import map_batches, ready, stored, with_columns

MAX_WINDOWS = 1_000_000
TABLE_BITS = 22
_FOUND = "_hit_from array<int>, _hit_to array<int>, _hit_items array<string>"
COLUMNS = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def item_windows(data: np.ndarray, words: X.Words, n: int) -> list[bytes]:
    """Windows of the one text in ``data`` (already lower-cased), as words joined by spaces."""
    own = [data[a:b].tobytes() for a, b in zip(words.start.tolist(), words.end.tolist())]
    return [b" ".join(own[i:i + n]) for i in range(max(1, len(own) - n + 1))] if own else []


class WindowSet:
    """Verified lookup of windows: bit tables by window length, then the words themselves."""

    def __init__(self, items: list[tuple[str, str]], n: int):
        self.items: dict[bytes, set[str]] = {}
        self.tables: dict[int, np.ndarray] = {}
        for item_id, text in items:
            data = X.LOWER[np.frombuffer(text.encode(), np.uint8)]
            words = X.find_words(data, np.array([0, len(data)]), X.NOT_ALNUM)
            keys = item_windows(data, words, n)
            for key in keys:
                self.items.setdefault(key, set()).add(item_id)
            if keys:
                k = min(n, len(words.start))
                table = self.tables.setdefault(k, np.zeros(1 << TABLE_BITS, bool))
                table[X.windows(X.word_hashes(data, words), k) >> np.uint64(64 - TABLE_BITS)] = True

    def hits(self, data: np.ndarray, words: X.Words, hashes: np.ndarray):
        """(text, first word, end word, items) of every occurrence, texts ascending per length."""
        owner = X.text_of_word(words)
        for k, table in self.tables.items():
            at = np.flatnonzero(table[X.windows(hashes, k) >> np.uint64(64 - TABLE_BITS)])
            at = at[owner[at] == owner[at + k - 1]] if len(at) else at
            for i in at.tolist():
                key = b" ".join(data[a:b].tobytes() for a, b in zip(words.start[i:i + k].tolist(), words.end[i:i + k].tolist()))
                if found := self.items.get(key):
                    yield int(owner[i]), i - int(words.first[owner[i]]), i - int(words.first[owner[i]]) + k, found


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scan(docs: DataFrame, windows, text: str, keep: list[str], last: bool) -> DataFrame:
    """One pass: hits so far joined with those of one group of windows."""
    schema = with_columns(docs.select(*keep), _FOUND + ", _n_words long")

    def run(batch: pa.RecordBatch) -> dict:
        got = {c: batch.column(batch.schema.get_field_index(c)) for c in batch.schema.names}
        data, offsets = X.utf8(got[text])
        before = [got[c].to_pylist() if c in got else [[]] * len(batch) for c in ("_hit_from", "_hit_to", "_hit_items")]
        spans = [list(zip(a, b)) for a, b in zip(*before[:2])]
        items = [set(x) for x in before[2]]
        counts = []
        for lo, hi in X.slices(offsets):
            part, offs = X.LOWER[data[offsets[lo]:offsets[hi]]], offsets[lo:hi + 1] - offsets[lo]
            words = X.find_words(part, offs, X.NOT_ALNUM)
            counts += np.diff(words.first).tolist()
            for d, a, b, found in windows.value.hits(part, words, X.word_hashes(part, words)):
                spans[lo + d].append((a, b))
                items[lo + d] |= found
        spans = [_merge(x) for x in spans]
        out = {"_hit_from": [[a for a, _ in x] for x in spans], "_hit_to": [[b for _, b in x] for x in spans],
               "_hit_items": [sorted(x) for x in items], "_n_words": counts}
        return out | {c: got[c] for c in keep if c not in out}

    return map_batches(docs, run, schema)


def find_hits(docs: DataFrame, bench: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
              n: int = 10, max_windows: int = MAX_WINDOWS, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (its columns ``keep``) with merged hit word ranges, items that occur and word counts."""
    spark = ready(docs)
    keep = [c for c in (docs.columns if keep is None else keep) if not c.startswith("_hit_") and c != "_n_words"]
    docs = docs.select(*dict.fromkeys([*keep, text]))
    bench = bench.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("text")).dropna().distinct()
    # at most one window starts at a character
    total = bench.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    groups = 1 if total <= max_windows else -(-2 * total // max_windows)
    for g in range(groups):
        own = bench if groups == 1 else bench.filter(F.pmod(F.xxhash64("id", "text"), F.lit(groups)) == g)
        held = spark.sparkContext.broadcast(WindowSet([tuple(r) for r in own.collect()], n))
        last = g == groups - 1
        docs = _scan(docs, held, text, keep if last else [c for c in docs.columns if not c.startswith("_")], last)
        if not last:
            docs = stored(docs, "hits")
            held.unpersist()
    return docs


def contamination(docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", **kwargs) -> DataFrame:
    """Per text: words, hit words, items that occur, a digest of their ids, and whether any word is hit."""
    found = find_hits(docs, bench, keep=[doc_id], **kwargs)
    hit = F.aggregate(F.zip_with("_hit_from", "_hit_to", lambda a, b: b - a), F.lit(0), lambda s, x: s + x).cast("long")
    return found.select(doc_id, F.col("_n_words").alias("n_words"), hit.alias("n_hit"),
                        F.size("_hit_items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "_hit_items"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans and without what lies between them."""
    raw = text.encode()
    data = X.LOWER[np.frombuffer(raw, np.uint8)]
    words = X.find_words(data, np.array([0, len(data)]), X.NOT_ALNUM)
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at:words.start[a]])
        at = int(words.end[b - 1])
    return b"".join([*out, raw[at:]]).decode()


def remove_spans(docs: DataFrame, bench: DataFrame, text: str = "text", max_hit_share: float = 0.5, **kwargs) -> DataFrame:
    """``docs`` with hit words cut out of their texts; a text with more than ``max_hit_share`` of
    its words hit is dropped as a document. Texts without hits stay byte for byte; columns stay."""
    columns = docs.columns
    found = find_hits(docs, bench, text=text, keep=columns, **kwargs)
    schema = found.schema

    def run(batch: pa.RecordBatch) -> dict:
        got = {c: batch.column(batch.schema.get_field_index(c)) for c in batch.schema.names}
        spans = [list(zip(a, b)) for a, b in zip(got["_hit_from"].to_pylist(), got["_hit_to"].to_pylist())]
        touched = [i for i, s in enumerate(spans) if s]
        if not touched:
            return got
        texts = got[text].to_pylist()
        for i in touched:
            texts[i] = cut(texts[i], spans[i])
        return got | {text: texts}

    hit = F.aggregate(F.zip_with("_hit_from", "_hit_to", lambda a, b: b - a), F.lit(0), lambda s, x: s + x)
    return map_batches(found.filter(hit <= F.col("_n_words") * F.lit(max_hit_share)), run, schema).select(*columns)


def items_digest(ids: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
