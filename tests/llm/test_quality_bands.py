import random
import string

import zstandard

from spendlake.llm import quality_bands as Q
from spendlake.llm.queries import QUERIES
from tests.llm.helpers import SF, docs, prose, rows

import re


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    count = {}
    for g in grams:
        count[g] = count.get(g, 0) + 1
    covered = {j for i, g in enumerate(grams) if count[g] > 1 for j in range(i, i + 8)}
    lines, dup = set(), 0
    for x in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in lines
            lines.add(x)
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    squeeze = zstandard.ZstdCompressor(level=Q.LEVEL, write_content_size=False)
    ratio, n, bad, reason = Q.judge(text.encode(), lambda b: len(squeeze.compress(b)))
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered), failed, not failed and not reason)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def test_whole_table(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op2_quality_bands"](spark, SF).collect():
        assert tuple(r[c] for c in COLUMNS) == brute(texts[r["doc_id"]])


def test_edges_and_clashing_columns(spark):
    texts = [None, "", " \n\t", "a", "a b c d e f g h " * 9, "x|y\n\nx|y\n x|y\nx|y", prose(400, 1), prose(30_000, 2), "é ü " * 30, "a\x00b c"]
    df = docs(spark, texts + texts[:2]).withColumnRenamed("lang", "kept").withColumnRenamed("source", "band")
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in Q.quality_rules(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts + texts[:2])}
    assert Q.quality_rules(df.limit(0)).collect() == []


def test_repetition_and_noise_are_rejected_and_prose_stays(spark):
    rng = random.Random(1)
    noise = " ".join("".join(rng.choice(string.ascii_letters + string.digits + "+/") for _ in range(30)) for _ in range(100))
    loop = " ".join(f"{a} {b}" for a in "alpha beta gamma delta".split() for b in ("one", "two") for _ in range(100))
    kept = dict(rows(Q.quality_rules(docs(spark, [noise, loop, prose(60, 3), prose(600, 4), prose(9000, 5)]), keep=["doc_id"]), "doc_id", "kept"))
    assert kept == {0: False, 1: False, 2: True, 3: True, 4: True}


def test_noise_of_any_length_and_mixed_documents_are_rejected(spark):
    rng = random.Random(2)
    letters = string.ascii_letters + string.digits + "+/"
    noise = lambda n, width=20: " ".join("".join(rng.choice(letters) for _ in range(width)) for _ in range(n // width + 1))[:n]
    clean = lambda n, seed: prose(n, seed)[:n]
    bad = [noise(300, 12)] + [noise(n) for n in (600, 1200, 2000, 2040)]
    bad += [clean(8192, 3) + noise(4096), clean(6144, 4) + noise(4096) + clean(2048, 5), clean(4096, 6) + noise(480)]
    good = [clean(n, 7 + n) for n in (150, 300, 600, 1200, 2000, 4500, 8600, 12_288)]
    kept = dict(rows(Q.quality_rules(docs(spark, bad + good), keep=["doc_id"]), "doc_id", "kept"))
    assert [kept[i] for i in range(len(bad + good))] == [False] * len(bad) + [True] * len(good)
