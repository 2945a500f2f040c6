"""Small fixtures and brute-force versions shared by the tests of the training-data operators."""
from __future__ import annotations

import random
import re

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and to in is that it was for on are with his they at be this from".split()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


def prose(n, seed, letters="abcdefghijklmnoprstu"):
    rng = random.Random(seed)
    made = lambda: rng.choice(WORDS) if rng.random() < 0.4 else "".join(rng.choice(letters) for _ in range(rng.randint(3, 9)))
    return " ".join(made() for _ in range(n))


def docs(spark, texts, start=0):
    return spark.createDataFrame([(start + i, t, "en", "src", len(t or "")) for i, t in enumerate(texts)], DOCS)


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) if columns else tuple(r) for r in df.collect()), key=repr)
