import random
import zlib

import numpy as np
import pytest

from spendlake.llm import packing as P
from spendlake.llm import tokens
from spendlake.llm.queries import QUERIES
from tests.llm.helpers import SF, docs, prose

PATH = tokens.vocabulary("byte_bpe_50k.json")


def check(found, texts):
    """texts: (id, text) rows. Every row is cut as it should be, and every sequence is gapless and fits."""
    own = tokens.Encoder(PATH)
    closing = np.array([2], "<u4").tobytes()
    want = []
    for (i, _), raw in zip(texts, own.plain([t or "" for _, t in texts])):
        raw += closing
        n, at = len(raw) // 4, 0
        sizes = [(n - 1) % 1024 + 1] + [1024] * ((n - 1) // 1024)
        for k, size in enumerate(sizes):
            want.append((i, k, at, size, zlib.crc32(raw[4 * at:4 * (at + size)])))
            at += size
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == sorted(want)
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    return len(sequences), -(-sum(w[3] for w in want) // 1024)


def test_whole_table(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    used, least = check(QUERIES["op5_genetic_packing"](spark, SF).collect(), texts)
    assert used <= least * 1.02 + 1


def test_edges(spark):
    texts = [None, "", "a", "a", prose(3000, 1), prose(40, 2), "<|endoftext|> x"]
    df = docs(spark, texts).withColumnRenamed("lang", "piece").withColumnRenamed("source", "uid")
    df = df.unionByName(df)
    check(P.pack_documents(df, PATH).collect(), list(enumerate(texts)) * 2)
    assert P.pack_documents(df.limit(0), PATH).collect() == []


def test_several_shards_and_rounds_stay_near_the_bound(spark, monkeypatch):
    monkeypatch.setattr(P, "SHARD", 60)
    rng = random.Random(4)
    sizes = [rng.randint(1, 1023) for _ in range(700)]
    items = spark.createDataFrame(list(enumerate(sizes)), "uid long, length long")
    got = P.pack(items).join(items, "uid").collect()
    fill, count = {}, 0
    for r in got:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
        count += 1
    assert count == 700 and max(fill.values()) <= 1024 and sum(fill.values()) == sum(sizes)
    assert len(fill) <= 1.03 * sum(sizes) / 1024 + 1


def whole(bins, n):
    return sorted(i for b in bins for i in b) == list(range(n))


@pytest.mark.parametrize("seed", range(5))
def test_crossover_and_mutation_keep_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 500, 120).tolist()
    a = P.best_fit(list(range(120)), sizes, [], 1000)
    b = P.best_fit(sorted(range(120), key=lambda i: -sizes[i]), sizes, [], 1000)
    for child in (P.crossover(a, b, sizes, 1000, rng), P.mutate(a, sizes, 1000, rng)):
        assert whole(child, 120) and all(sum(sizes[i] for i in x) <= 1000 for x in child)
    assert whole(a, 120) and whole(b, 120)     # parents are left as they were


def test_evolution_never_gets_worse():
    rng = np.random.default_rng(1)
    sizes = rng.integers(200, 700, 90).tolist()
    first = len(P.best_fit(sorted(range(90), key=lambda i: -sizes[i]), sizes, [], 1000))
    assert len(P.evolve([], sizes, 1000, rng, generations=30)[0]) <= first
    assert P.evolve([], [], 1000, rng)[0] == []
