"""Language identification by compression.

For each language a raw-content zstandard dictionary of at most ``DICTIONARY`` bytes is filled
from a bounded sample of labelled texts, in pieces of a few words in hashed order, so that it has
the words of the language and not whole passages (which other languages' texts may quote). A
text is encoded in blocks with every dictionary; the language with the smallest total wins, and
a text whose winner leads by little is rejected. Matches may be as short as four bytes, because
most of what a word shares with a dictionary is short.

The sample is the only thing fitted: at most ``SAMPLE_TEXTS`` unlike texts a language, chosen by a
hash over all labelled rows, ``SNIPPET`` characters each. Labels may have at most ``MAX_LANGUAGES``
values, which bounds what is broadcast.

Defined cases: null text or one without a letter is ``und`` with score 0 and is rejected; rows
with a null label teach nothing; with no labelled row at all, every text is ``und``; equal sizes
go to the first language by name; very long texts are encoded whole, block by block.
"""
from __future__ import annotations

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlake.llm.frames import crc32_mod, map_batches, ready, with_columns

DICTIONARY = 65_536
SAMPLE_TEXTS = 400
SNIPPET = 2_000
MAX_LANGUAGES = 256
PIECE = 3           # words of a dictionary piece
BLOCK = 2_048
MIN_MARGIN = 0.01   # the runner-up must be this much larger, as a share of its own size
UNKNOWN = "und"


def sampled(rows: DataFrame, counts: dict[str, int]) -> DataFrame:
    """(lang, s, h) of at most SAMPLE_TEXTS unlike texts a language, by their hash ``h``; ties go by the text's digest.

    Copies are dropped and each task keeps its own first ones, before the rows of a language meet."""
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, SAMPLE_TEXTS / n))])
    drawn = rows.filter(F.pmod("h", F.lit(1_000_003)) < F.element_at(share, F.col("lang")) * 1_000_003)
    unlike = drawn.select("lang", F.substring("text", 1, SNIPPET).alias("s"), "h").distinct()
    first = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1_000_003)), F.xxhash64("s"), "s", "h")
    return unlike.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= SAMPLE_TEXTS).drop("nth")


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> dict[str, bytes]:
    """Dictionary content per language from a bounded sample of ``labelled``."""
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"),
                           F.xxhash64(F.col(doc_id).cast("string"), F.length(text)).alias("h")).dropna(subset=["lang", "text"])
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages among the labels")
    if not counts:
        return {}
    snippets: dict[str, dict[str, int]] = {k: {} for k in counts}
    for r in sorted(sampled(rows, counts).collect(), key=lambda r: (r["h"], r["s"])):
        snippets[r["lang"]].setdefault(r["s"].lower(), r["h"])
    out = {}
    for name, found in snippets.items():
        words = [s.split() for s in sorted(found, key=lambda s: (found[s], s))]
        pieces = {" ".join(w[i:i + PIECE]).encode() for w in words for i in range(0, len(w), PIECE)}
        raw = b" ".join(sorted(pieces, key=xxhash.xxh3_64_intdigest))
        out[name] = raw[:DICTIONARY] or name.encode()
    return out


class Classifier:
    def __init__(self, content: dict[str, bytes]):
        self.names = sorted(content)
        self.with_dictionary = [self.prepared(content[n]) for n in self.names]
        self.plain = self.prepared(b" ")

    @staticmethod
    def prepared(raw: bytes) -> zstandard.ZstdCompressor:
        how = zstandard.ZstdCompressionParameters.from_level(
            3, dict_size=len(raw), source_size=BLOCK, write_content_size=False, min_match=4, search_log=3, strategy=zstandard.STRATEGY_GREEDY)
        held = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(compression_params=how)
        return zstandard.ZstdCompressor(dict_data=held, compression_params=how)

    def judge(self, text: str | None) -> tuple[str, float]:
        """The language and the margin: how much smaller it is than the runner-up (0 to 1)."""
        if not self.names or not text or not any(c.isalpha() for c in text):
            return UNKNOWN, 0.0
        raw = text.lower().encode()
        blocks = [raw[i:i + BLOCK] for i in range(0, len(raw), BLOCK)]
        sizes = [sum(len(c.compress(b)) for b in blocks) for c in self.with_dictionary]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        others = [s for i, s in enumerate(sizes) if i != best] or [sum(len(self.plain.compress(b)) for b in blocks)]
        return self.names[best], max(0.0, 1.0 - sizes[best] / min(others))


def identify(docs: DataFrame, content: dict[str, bytes], text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (its columns ``keep``) with lang_pred, score and whether the text is rejected."""
    spark = ready(docs)
    extra = "lang_pred string, score double, lang_rejected boolean"
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score", "lang_rejected")]
    schema = with_columns(docs.select(*kept), extra)
    held = spark.sparkContext.broadcast(content)
    made: list[Classifier] = []

    def run(batch: pa.RecordBatch) -> dict:
        if not made:
            made.append(Classifier(held.value))
        got = [made[0].judge(t) for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
        return {c: batch.column(batch.schema.get_field_index(c)) for c in kept} | {
            "lang_pred": [n for n, _ in got], "score": [m for _, m in got],
            "lang_rejected": [n == UNKNOWN or m < MIN_MARGIN for n, m in got]}

    return map_batches(docs.select(*dict.fromkeys([*kept, text])), run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents whose labels are never learned from."""
    return crc32_mod(F.col(doc_id), 3) == 1


def language_id(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Learn from the documents that are not held out, then judge every document."""
    return identify(docs, learn(docs.filter(~held_out())), keep=keep)
