import random
import re
from collections import Counter, defaultdict

import numpy as np

from spendlake.llm import phrases as P
from tests.llm.helpers import SF

SCHEMA = "doc_id long, text string, lang string, f long, phrase string"


def brute(rows, min_count, top=2000, max_words=4):
    """The contract by plain counting; rows are (text, lang)."""
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = (text or "").translate({i: i + 32 for i in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in range(1, max_words + 1):
                counts[lang].update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        scored = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in cand.items()):
                continue
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def run(spark, rows, **more):
    df = spark.createDataFrame([(i, t, l, 1, "x") for i, (t, l) in enumerate(rows)], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in P.collocations(df, **more).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def made(seed, n=150, sizes=(0, 60)):
    rng = random.Random(seed)
    vocabulary = ["a", "bb", "C", "dé", "e f", "中", "g", "H", "I", "jj"]
    sep = [" ", "  ", "\t", " ", " ", ", ", ".\n", "\x0c", "!"]
    return [("".join(rng.choice(vocabulary[:rng.randint(3, 10)]) + rng.choice(sep) for _ in range(rng.randint(*sizes))), rng.choice(["en", "fr", None, "und"])) for _ in range(n)]


def test_equals_brute_force_with_failures_of_the_border(spark, monkeypatch):
    passes = []
    inner = P._often
    monkeypatch.setattr(P, "_often", lambda *a, **k: passes.append(a[6] if len(a) > 6 else None) or inner(*a, **k))
    rows = made(1)
    want = brute(rows, 8)
    assert want and run(spark, rows, min_count=8) == want
    passes.clear()      # a tiny sample at a high threshold proposes next to nothing: the border must find the rest
    assert run(spark, rows, min_count=8, sample=0.02, slack=20.0) == want
    assert sum(p is not None for p in passes) == 1      # the expansion pass ran


def test_small_tables_of_bits_and_ranges_change_nothing(spark, monkeypatch):
    rows = made(2, 120)
    want = brute(rows, 6)
    monkeypatch.setattr(P, "MIN_BITS", 15)
    monkeypatch.setattr(P, "MAX_BITS", 15)
    assert run(spark, rows, min_count=6) == want
    monkeypatch.setattr(P, "BUCKET", 50)    # many buckets
    assert run(spark, rows, min_count=6) == want


def test_phrases_that_share_a_hash_are_counted_apart(monkeypatch):
    rows = made(4, 30)
    data, offsets = P.X.utf8(P.pa.array([t for t, _ in rows]))
    part = P._Slice(data, offsets, [l or "und" for _, l in rows])
    everything = P.BitTable(15, np.full(1 << 12, 255, np.uint8))
    monkeypatch.setattr(P, "_hash", lambda own, start, n: np.zeros(len(start), np.uint64))
    got = Counter()
    for batch in P._exact(part, 3, [None] + [everything] * 3):
        for r in batch.to_pylist():
            if r["n"]:
                got[r["lang"], r["phrase"]] += r["f"]
    want = Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.translate({i: i + 32 for i in range(65, 91)})):
            w = re.findall(r"[^\x20\x09]+", piece)
            for n in (1, 2, 3):
                want.update((lang or "und", " ".join(w[i:i + n])) for i in range(len(w) - n + 1))
    assert got == want


def test_long_text_ties_copies_and_subsumed_phrases(spark):
    rng = random.Random(5)
    long = " ".join(rng.choice("uvwxyz") for _ in range(700_000))
    assert len(P.X.find_words(P.X.utf8(P.pa.array([long]))[0], P.X.utf8(P.pa.array([long]))[1]).start) > P.RANGE
    rows = [(long, "en")] + [("one two three four", "en")] * 40 + [("x y", None), ("x y", "und")] * 15
    got = run(spark, rows, min_count=30, top=50)
    assert got == brute(rows, 30, top=50)
    said = {r[2] for r in got if r[0] == "en"}
    assert "two three" not in said and [r[2:] for r in got if r[0] == "und"] == [("x y", 30, 30, 30, 60, 1000000)]


def test_nulls_empty_texts_and_empty_tables(spark):
    assert run(spark, [(None, "en"), ("", None), (" \t.,", "fr")], min_count=1) == []
    assert run(spark, [], min_count=1) == []
    assert run(spark, [("A a", "en"), (None, None)], min_count=1) == [("en", 1, "a a", 1, 2, 2, 2, 500000)]


def test_scores_beyond_64_bits(spark, monkeypatch):
    big = 9_000_000_000_000
    rows = [("en", 0, "", 3 * big), ("en", 1, "p", big + 7), ("en", 1, "q", big), ("en", 2, "p q", big - 1)]
    monkeypatch.setattr(P, "frequent_phrases", lambda *a, **k: spark.createDataFrame(rows, "lang string, n int, phrase string, f long"))
    got = P.collocations(spark.createDataFrame([], SCHEMA)).collect()
    assert [r["score"] for r in got] == [2000000 * (big - 1) // (2 * big + 7)]


def test_whole_smallest_table(spark):
    from spendlake.llm.queries import QUERIES
    got = sorted(tuple(r) for r in QUERIES["op12_collocations"](spark, SF).collect())
    rows = [(r["text"], r["lang"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got == brute(rows, 30)
