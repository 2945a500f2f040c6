import hashlib
import random
import re

import pytest

from spendlake.llm import decontaminate as D
from tests.llm.helpers import DOCS, docs, prose, rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall((t or "").translate({i: i + 32 for i in range(65, 91)}))


def brute(texts, items, n=10):
    found = {}
    for item, t in items:
        w = words(t)
        if item is not None and t is not None:
            for i in range(max(1, len(w) - n + 1) if w else 0):
                found.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    out = []
    for i, t in texts:
        w, hit, ids = words(t), set(), set()
        for k in {len(g) for g in found}:
            for a in range(len(w) - k + 1):
                if g := found.get(tuple(w[a:a + k])):
                    hit |= set(range(a, a + k))
                    ids |= g
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def fixture(seed):
    rng = random.Random(seed)
    items = [(i, prose(rng.choice([3, 9, 10, 11, 30]), 50 * seed + i)) for i in range(25)]
    items += [(3, prose(15, 777)), (90, "Short One"), (91, None), (None, "x y z"), (92, ""), (93, "!!"), (94, items[0][1].upper() + "!"), (95, "né ü")]
    texts = [None, "", " - ", "short one, SHORT-ONE", "a né, Ü né ü"]
    for i in range(40):
        t = prose(rng.randint(5, 120), 10_000 * seed + i).split()
        for _ in range(rng.randint(0, 3)):
            w = (rng.choice(items)[1] or "q").split()
            a = rng.randint(0, len(t))
            t[a:a] = w[rng.randint(0, 2):]
        texts.append(rng.choice([" ", "; ", "\n"]).join(t))
    return texts + texts[5:8], items


@pytest.mark.parametrize("seed,most", [(1, D.MAX_WINDOWS), (2, 500)])
def test_matches_brute_force(spark, seed, most):
    texts, items = fixture(seed)
    df = docs(spark, texts).withColumnRenamed("lang", "item_id").withColumnRenamed("source", "n_words")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert rows(D.contamination(df, bench, max_windows=most)) == brute(list(enumerate(texts)), items)


def test_empty_tables(spark):
    df, bench = docs(spark, ["a b c", None]), spark.createDataFrame([], "item_id long, text string")
    assert rows(D.contamination(df, bench)) == brute([(0, "a b c"), (1, None)], [])
    assert D.contamination(df.limit(0), bench).collect() == [] and D.remove_spans(df.limit(0), bench).collect() == []


def test_spans_are_removed_and_clean_texts_stay(spark):
    item = prose(25, 5)
    clean, leak = prose(100, 1) + " é.\n", prose(80, 2) + "\n" + item.upper() + " -- " + prose(40, 3)
    df = spark.createDataFrame([(0, clean, "x", "y", 1), (1, leak, "x", "y", 1), (2, "Look: " + item, "x", "y", 1), (3, None, "x", "y", 1)], DOCS)
    got = {r["doc_id"]: r["text"] for r in D.remove_spans(df, spark.createDataFrame([(0, item)], "item_id long, text string")).collect()}
    assert set(got) == {0, 1, 3} and got[0] == clean and got[3] is None
    assert got[1] == prose(80, 2) + "\n" + " -- " + prose(40, 3)


def test_very_long_text(spark):
    item = prose(40, 5)
    text = prose(150_000, 1) + " " + item + " " + prose(150_000, 2)
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = D.contamination(docs(spark, [text]), bench).first()
    assert got["n_words"] == 300_040 and got["n_hit"] == 40 and got["n_items"] == 1
