"""Phrases that occur often, by Toivonen's sampling, and their collocation scores.

A sample of the texts, counted at a lowered threshold, proposes the phrases S. One pass over all
texts then counts S and its negative border (phrases outside S whose parts of one word less are
all in S; every word outside S). A border phrase that turns out to be frequent is a failure: it
joins S, and S is closed over it: phrases that have thereby come into the border are taken to be
frequent too, as are those that then come into it, and so on. One expansion pass counts this closure.
A frequent phrase that the first pass has not counted contains a failure and has only frequent
parts, so it is in the closure: then all frequent phrases have been met, whatever the sample was. A
last pass counts the frequent ones word by word.

Border phrases are many and nearly all rare, so up to the last pass they travel as hashes: a slice of
text sends the distinct hashes and their counts (up to the threshold) as arrays, one row a bucket of
the hash space, and buckets are added up array-wise. Buckets grow in number with the text, so one holds
about ``BUCKET`` words' hashes. Phrases that share a hash can only be counted too often there; the last
pass, by exact words, decides.

S reaches the tasks as bit tables over phrase hashes, one for each length, of ``SLOTS_A_PHRASE``
slots a phrase up to 2^``MAX_BITS`` (16 MB). A slot shared by two phrases only makes S larger: more
is counted and nothing is lost, so results do not depend on the tables' size.

Texts: A-Z are lower-cased; ``[.,;:!?\\x0A-\\x0D]`` cut a text into pieces, and words
``[^\\x20\\x09]+`` never combine across pieces. A null text has no words; a null language is
``und``. Ties in score go to the more frequent phrase, then to the smaller one in byte order.
Repeated rows count as often as they occur. Columns other than the text, the language and the id
are not read, so clashing names can't matter; an empty table gives no rows. A text of any length is
counted whole, in ranges of words.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlake.llm import text as X
from spendlake.llm.frames import ready, stored

SAMPLE = 0.25           # share of the documents that propose phrases
SLACK = 0.5             # threshold in the sample, as a share of the expected count
SLICE = 4 << 20         # bytes of text counted at once
BUCKET = 1 << 21        # words a bucket of hashes stands for
RANGE = 1 << 19         # words counted at once
SLOTS_A_PHRASE = 16
MIN_BITS, MAX_BITS = 20, 27
COUNTS = "lang string, n int, phrase string, f long"
HASHED = "bucket int, n int, low binary, times binary"

_PIECE = np.zeros(256, bool)
_PIECE[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = True
_GAP = _PIECE.copy()
_GAP[[0x20, 0x09]] = True

_U = np.uint64


class BitTable:
    """A set of hashes: false for none of its members."""

    def __init__(self, bits: int, packed: np.ndarray):
        self.bits, self.packed = bits, packed

    def has(self, hashes: np.ndarray) -> np.ndarray:
        slot = (hashes >> _U(64 - self.bits)).astype(np.int64)
        return (self.packed[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def bit_table(hashes: DataFrame) -> BitTable:
    """The table of one column ``h`` of (well mixed) longs: bitmaps made and merged by Spark.

    At most 2^MAX_BITS slots, so at most 16 MB reach the driver."""
    n = hashes.count()
    bits = min(MAX_BITS, max(MIN_BITS, int(n * SLOTS_A_PHRASE).bit_length()))
    slot = F.shiftrightunsigned("h", 64 - bits)
    maps = hashes.select(F.shiftright(slot, 15).alias("bucket"), slot.bitwiseAND(F.lit(32767)).alias("place"))
    maps = maps.groupBy("bucket").agg(F.bitmap_construct_agg("place").alias("bitmap"))
    packed = np.zeros(1 << (bits - 3), np.uint8)
    for bucket, bitmap in maps.collect():      # at most 4,096 bitmaps of 4 kB
        packed[bucket << 12:(bucket + 1) << 12] = np.frombuffer(bitmap, np.uint8)
    return BitTable(bits, packed)


def _lang_hash(lang: str) -> int:
    import xxhash
    return xxhash.xxh3_64_intdigest(lang.encode())


class _Slice:
    """The words of some texts: places, hashes and whether the next word follows in the same piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: list[str]):
        self.data = data = X.LOWER[data]
        self.words = words = X.find_words(data, offsets, _GAP)
        self.names = sorted(set(langs))
        code = {x: i for i, x in enumerate(self.names)}
        text = X.text_of_word(words)
        self.lang = np.array([code[x] for x in langs], np.int64)[text]
        self.size = len(words.start)
        self.hashes = X.word_hashes(data, words)
        self.hashes += np.array([_lang_hash(x) for x in self.names], np.uint64)[self.lang]
        cuts = np.zeros(len(data) + 1, np.int32 if len(data) < 1 << 31 else np.int64)
        np.cumsum(_PIECE[data], out=cuts[1:])
        self.follows = np.zeros(self.size, bool)
        self.follows[:-1] = (cuts[words.start[1:]] == cuts[words.end[:-1]]) & (text[1:] == text[:-1])

    def ranges(self, most: int) -> Iterator[tuple[int, int, int]]:
        """(first, last, end): phrases that begin in first:last lie within first:end."""
        for a in range(0, self.size, RANGE):
            b = min(self.size, a + RANGE)
            yield a, b, min(self.size, b + most - 1)

    def strings(self) -> pa.Array:
        sizes = np.zeros(self.size + 1, np.int64)
        np.cumsum(self.words.end - self.words.start, out=sizes[1:])
        inside = np.zeros(len(self.data) + 1, np.int8)
        inside[self.words.start] += 1
        inside[self.words.end] -= 1
        kept = self.data[np.cumsum(inside[:-1], dtype=np.int8) > 0]
        return pa.LargeStringArray.from_buffers(self.size, pa.py_buffer(sizes), pa.py_buffer(kept))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[_Slice]:
    """About ``SLICE`` bytes of (lang, text) at a time, or one longer text."""
    held: list[pa.RecordBatch] = []

    def cut():
        rows = pa.Table.from_batches(held).combine_chunks()
        langs, (data, offsets) = rows.column(0).to_pylist(), X.utf8(rows.column(1))
        for lo, hi in X.slices(offsets, SLICE):
            yield _Slice(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], langs[lo:hi])
    for batch in batches:
        held.append(batch)
        if sum(x.nbytes for x in held) >= SLICE:
            yield from cut()
            held = []
    if held:
        yield from cut()


def _hash(own: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
    out = np.full(len(start), n, np.uint64)
    for k in range(n):
        out += own[start + k] * X._ODD[k]
    return X.mix(out)


def _hashed(part: _Slice, least: int, most: int, bits: int, limit: int, tables, old) -> Iterator[pa.RecordBatch]:
    """Counts by hash of the phrases of ``least`` to ``most`` words that are in S or its border.

    ``tables`` holds, at place n, the BitTable of S's phrases of n words. With ``old``, the tables of
    the pass before, S is closed over what it has gained, and only what that pass has not counted counts."""
    for a, b, end in part.ranges(most):
        own, follows = part.hashes[a:end], part.follows[a:end]
        at = np.arange(len(own))                    # where phrases of the present length may begin
        h = _hash(own, at, 1)
        counted = np.full(len(own), old is not None)    # by the earlier pass
        for n in range(1, most + 1):
            new = ~counted & (at < b - a)
            if n >= least and new.any():
                yield _bucketed(h[new], n, bits, limit)
            if n == most:
                break
            member = tables[n].has(h)               # in S, or taken to be so
            if old is not None:
                before = counted & old[n].has(h)
                member |= ~counted
            # a phrase is in S or the border if its first and its last n words are in S
            place = np.full(len(own) + 1, -1, np.int32)
            place[at[member]] = np.flatnonzero(member)
            at = at[member]
            at = at[follows[np.minimum(at + n - 1, len(own) - 1)] & (at + n < len(own))]
            at = at[place[at + 1] >= 0]
            if not len(at):
                break
            counted = before[place[at]] & before[place[at + 1]] if old is not None else np.zeros(len(at), bool)
            h = _hash(own, at, n + 1)


def _bucketed(hashes: np.ndarray, n: int, bits: int, limit: int) -> pa.RecordBatch:
    """Distinct hashes and their counts, one row a bucket (a hash's highest ``bits`` bits)."""
    h, times = np.unique(hashes, return_counts=True)
    low = (h >> _U(32 - bits)).astype("<u4")
    times = np.minimum(times, limit).astype("<u4" if limit > 255 else np.uint8)
    edges = np.searchsorted(h >> _U(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)) if bits else np.array([0, len(h)])
    used = [i for i in range(1 << bits) if edges[i] < edges[i + 1]]
    return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([n] * len(used), pa.int32()),
                                       pa.array([low[edges[i]:edges[i + 1]].tobytes() for i in used], pa.binary()),
                                       pa.array([times[edges[i]:edges[i + 1]].tobytes() for i in used], pa.binary())], names=["bucket", "n", "low", "times"])


def _add_buckets(bits: int, limit: int):
    kind = "<u4" if limit > 255 else np.uint8

    def total(key, parts) -> pa.RecordBatch:
        low, times = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        order = np.argsort(low, kind="stable")
        low, times = low[order], times[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        often = np.add.reduceat(times, first) >= limit
        h = (np.uint64(key[0]) << _U(64 - bits) if bits else _U(0)) | low[first[often]].astype(np.uint64) << _U(32 - bits)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(h), key[1], np.int32)), pa.array(h.view(np.int64))], names=["n", "h"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a bucket and length follow one another."""
        key, parts = None, []
        for batch in batches:
            for bucket, n, low, times in zip(*(c.to_pylist() for c in batch.columns)):
                if key != (bucket, n):
                    if parts:
                        yield total(key, parts)
                    key, parts = (bucket, n), []
                parts.append((np.frombuffer(low, "<u4"), np.frombuffer(times, kind)))
        if parts:
            yield total(key, parts)
    return run


def _often(texts: DataFrame, least: int, most: int, limit: int, bits: int, tables, old=None) -> DataFrame:
    """(n, h): hashes of the counted phrases of ``texts`` (lang, text) that occur ``limit`` times; stored."""
    sc = texts.sparkSession.sparkContext
    sent = sc.broadcast((tables, old))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            yield from _hashed(part, least, most, bits, limit, *sent.value)
    rows = texts.mapInArrow(run, HASHED).repartition("bucket", "n").sortWithinPartitions("bucket", "n")
    out = stored(rows.mapInArrow(_add_buckets(bits, limit), "n int, h long"), "often")
    sent.unpersist()
    return out


def _exact(part: _Slice, most: int, wanted) -> Iterator[pa.RecordBatch]:
    """Counts of the phrases whose hash is wanted, by their words; n = 0 counts the words of a language."""
    yield _batch(pa.array(part.names), 0, pa.array([""] * len(part.names)), np.bincount(part.lang, minlength=len(part.names)))
    strings, named = part.strings(), pa.array(part.names)
    for a, b, end in part.ranges(most):
        coded = strings.slice(a, end - a).dictionary_encode()
        ids, vocabulary = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
        own, follows, lang = part.hashes[a:end], part.follows[a:end], part.lang[a:end]
        at = np.arange(b - a)
        for n in range(1, most + 1):
            if n > 1:
                at = at[(at + n - 1 < len(own)) & follows[np.minimum(at + n - 2, len(own) - 1)]]
            h = _hash(own, at, n)
            hit = wanted[n].has(h)
            at, h = at[hit], h[hit]     # a frequent phrase begins with a frequent one
            if not len(at):
                break
            if n == 1:                  # the ids of words are small: no sort
                word = lang[at] * len(vocabulary) + ids[at]
                times = np.bincount(word)
                start = np.zeros(len(times), np.int64)
                start[word[::-1]] = at[::-1]
                start, times = start[times > 0], times[times > 0]
            else:
                _, first, group, times = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
                start = at[first]
                words = [ids[at + k] for k in range(n)] + [lang[at]]
                if any((w != w[first][group]).any() for w in words):    # two phrases of one hash: group by the words
                    _, first, times = np.unique(np.stack(words, 1), axis=0, return_index=True, return_counts=True)
                    start = at[first]
            phrase = vocabulary.take(pa.array(ids[start]))
            if n > 1:
                phrase = pc.binary_join_element_wise(phrase, *[vocabulary.take(pa.array(ids[start + k])) for k in range(1, n)], pa.scalar(" ", pa.large_string()))
            yield _batch(named.take(pa.array(lang[start])), n, phrase, times)


def _batch(lang, n, phrase, f) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([lang.cast(pa.string()), pa.array(np.full(len(f), n, np.int32)), phrase.cast(pa.string()), pa.array(f.astype(np.int64))], names=["lang", "n", "phrase", "f"])


def frequent_phrases(docs: DataFrame, min_count: int = 30, max_words: int = 4, sample: float = SAMPLE,
                     slack: float = SLACK, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, n, phrase, f): every phrase of 1 to ``max_words`` words that occurs ``min_count`` times
    in its language, with its exact count; the row n = 0 of a language counts its words."""
    ready(docs)
    everything = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("k"))
    texts = everything.select("lang", "text")
    drawn = everything.filter(F.pmod(F.xxhash64("k"), F.lit(1_000_000)) < int(sample * 1_000_000)).select("lang", "text")
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(31, max(0, int(n_bytes // 6 // BUCKET).bit_length()))
    lowered = max(2, int(min_count * sample * slack))
    tables: list[BitTable | None] = [None] * max_words
    for n in range(1, max_words):       # level by level: a phrase is proposed only if its parts are
        tables[n] = bit_table(_often(drawn, n, n, lowered, bits, tables).select("h"))
    often = _often(texts, 1, max_words, min_count, bits, tables)
    grown = _with_failures(often, tables, max_words)
    if grown is not None:
        often = often.unionByName(_often(texts, 2, max_words, min_count, bits, grown, tables))
    sent = docs.sparkSession.sparkContext.broadcast([None] + [bit_table(often.filter(f"n = {n}").select("h")) for n in range(1, max_words + 1)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            if part.size:
                yield from _exact(part, max_words, sent.value)
    counts = texts.mapInArrow(run, COUNTS).groupBy("lang", "n", "phrase").agg(F.sum("f").alias("f"))
    out = stored(counts.filter(f"f >= {min_count} OR n = 0"), "counted")
    sent.unpersist()
    return out


def _with_failures(often: DataFrame, tables, max_words: int):
    """The tables with the frequent phrases that were not in them, or None if there are none."""
    sent = often.sparkSession.sparkContext.broadcast(tables)

    def outside(batches):
        for batch in batches:
            n, h = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            out = np.zeros(len(n), bool)
            for k in range(1, max_words):
                out |= (n == k) & ~sent.value[k].has(h)
            yield batch.filter(pa.array(out))
    failures = stored(often.filter(f"n < {max_words}").mapInArrow(outside, "n int, h long"), "failures")
    lengths = {r["n"] for r in failures.select("n").distinct().collect()}
    sent.unpersist()
    if not lengths:
        return None
    grown = list(tables)
    for n in lengths:
        grown[n] = _merged(tables[n], bit_table(failures.filter(f"n = {n}").select("h")))
    return grown


def _merged(a: BitTable, b: BitTable) -> BitTable:
    """The union, in the larger of the two sizes: a slot of the smaller covers a run of slots there."""
    bits = max(a.bits, b.bits)

    def widened(t: BitTable) -> np.ndarray:
        if t.bits == bits:
            return t.packed
        return np.packbits(np.repeat(np.unpackbits(t.packed, bitorder="little"), 1 << (bits - t.bits)), bitorder="little")
    return BitTable(bits, widened(a) | widened(b))


def collocations(docs: DataFrame, top: int = 2000, min_count: int = 30, max_words: int = 4, subsumed_percent: int = 80, **columns) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of every language.

    A phrase is scored by its weakest cut, floor(2000000 * a / (l + r)); one that lies inside a
    longer candidate with ``subsumed_percent`` of its count is left out. All arithmetic is in
    decimals of 38 digits."""
    found = frequent_phrases(docs, min_count, max_words, **columns)
    whole = lambda c: F.col(c).cast("decimal(38,0)")
    freq = found.filter("n >= 1").select("lang", "phrase", "f", "n")
    candidates = freq.filter("n >= 2").withColumn("w", F.split("phrase", " "))
    part = lambda start, size: F.array_join(F.slice("w", start, size), " ")
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), "n", "w", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
    asked = cuts.select("lang", "phrase", "a", "k", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), part(1, F.col("k")).alias("part")),
        F.struct(F.lit(1).alias("side"), part(F.col("k") + 1, F.col("n") - F.col("k")).alias("part")))).alias("p")).select("lang", "phrase", "a", "k", "p.*")
    parts = freq.select("lang", F.col("phrase").alias("part"), "f")
    met = stored(asked.join(parts, ["lang", "part"]), "cuts")
    cut = met.groupBy("lang", "phrase", "a", "k").agg(F.max(F.when(F.col("side") == 0, F.col("f"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("f"))).alias("r"))
    cut = cut.withColumn("score", F.expr("cast(2000000 * cast(a as decimal(38,0)) div (cast(l as decimal(38,0)) + r) as bigint)"))
    scored = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c")).select("lang", "phrase", "a", "c.l", "c.r", "c.score")
    longer = candidates.filter("n >= 3").select("lang", "f", "n", "w", F.explode(F.expr("sequence(2, n - 1)")).alias("m"))
    longer = longer.select("lang", "f", "w", "m", F.explode(F.expr("sequence(1, n - m + 1)")).alias("i")).select("lang", "f", part(F.col("i"), F.col("m")).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    kept = scored.join(longer, ["lang", "phrase"], "left").filter(F.col("most").isNull() | (100 * whole("most") < F.lit(subsumed_percent) * whole("a")))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    totals = found.filter("n = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
