import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from spendlake.llm import components as CC
from spendlake.llm import jaccard_join as J
from tests.llm.helpers import DOCS, docs, prose, rows, words


def shingles(t):
    w = words(t)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(texts):
    """texts: (id, text) rows; components by links of at least 80 of 100."""
    sets, parent = [shingles(t) for _, t in texts], list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in combinations(range(len(texts)), 2):
        k = len(sets[a] & sets[b])
        if k and 100 * k >= 80 * (len(sets[a]) + len(sets[b]) - k):
            parent[root(b)] = root(a)
    names = {}
    for i, (d, _) in enumerate(texts):
        if d is not None:
            names[root(i)] = min(names.get(root(i), d), d)
    return sorted(((d, len(s), names.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(texts, sets))), key=repr)


def varied(base, rng, n):
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(rng.randint(1, max(1, len(w) // 20))):
            w[rng.randrange(len(w))] = rng.choice(["xx", "yy", "zz"])
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_matches_brute_force_on_groups_of_all_sizes(spark, seed):
    rng = random.Random(seed)
    texts = []
    for size in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 14, 17, 20, 25, 30, 45, 80):
        base = prose(size, 100 * seed + size)
        texts += varied(base, rng, 6) + [base + " " + rng.choice("pqr"), base]
    passage = prose(50, 999)
    texts += [prose(rng.randint(1, 90), i + 1000 * seed) + " " + passage for i in range(25)]
    rng.shuffle(texts)
    found = J.similar_components(docs(spark, texts))
    assert rows(found) == brute(list(enumerate(texts)))


def test_light_sets_by_enumeration_alone(spark, monkeypatch):
    """With a high boundary all these sets are light and no list is scanned."""
    monkeypatch.setattr(J, "boundary", lambda sizes, percent=80: 16)
    rng = random.Random(5)
    texts = [t for n in range(5, 14) for t in varied(prose(n + 4, n), rng, 5) + [prose(n + 4, n), prose(n + 4, n) + " q", prose(n + 4, n) + " q r"]]
    assert rows(J.similar_components(docs(spark, texts))) == brute(list(enumerate(texts)))


def test_salted_lists(spark, monkeypatch):
    monkeypatch.setattr(J, "HOT_LIST", 4)
    rng = random.Random(6)
    texts = varied(prose(60, 1), rng, 40) + varied(prose(60, 2), rng, 20)
    assert rows(J.similar_components(docs(spark, texts))) == brute(list(enumerate(texts)))


def test_edges(spark):
    long = prose(20_000, 8)
    texts = [(0, None), (1, ""), (2, " \n"), (3, "one"), (4, "ONE"), (4, "one"), (None, "one"), (None, "alone here"), (5, long), (6, long + " more"), (7, "a b c d"), (8, "a b c d e")]
    df = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in texts], DOCS.replace("lang", "cid").replace("source", "key").replace("n_chars", "n"))
    assert rows(J.similar_components(df)) == brute(texts)
    assert J.similar_components(df.limit(0)).collect() == []


def test_one_of_each_keeps_the_smallest_id(spark):
    a, b = prose(100, 1), prose(100, 2)
    df = docs(spark, [a, b, a + " end", None, "", b, prose(100, 3)]).unionByName(docs(spark, [a]))
    got = J.one_of_each(df)
    assert got.columns == df.columns and rows(got, "doc_id") == [(0,), (1,), (3,), (4,), (6,)]


def test_need_and_partners():
    for a in range(1, 40):
        for b in range(a, 60):
            most = a >= J.need(a, b)
            assert most == (b in J.partners(a)) and (a in J.partners(b)) == (b in J.partners(a))


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7)]
    random.Random(1).shuffle(edges)
    got = rows(CC.components(spark.createDataFrame(edges, "u long, v long")))
    assert got == sorted([(i, 0) for i in range(1, 61)] + [(100 + i, 100) for i in range(1, 40)], key=repr)


def test_no_pairs_within_a_group_of_near_copies(spark):
    """Members that are not all alike: the verified pairs grow with the group, not with its square."""
    rng = random.Random(2)
    base = prose(150, 1).split()
    texts = []
    for i in range(200):
        w = list(base)
        for _ in range(1 + i % 2):
            w[rng.randrange(150)] = f"new{rng.randrange(10_000)}"
        texts.append(" ".join(w))
    seen, real = [], J.verified

    def counted(pairs, texts_, percent=80):
        seen.append(pairs.count())
        return real(pairs, texts_, percent)
    J.verified = counted
    try:
        found = rows(J.similar_components(docs(spark, texts)))
    finally:
        J.verified = real
    assert found == brute(list(enumerate(texts))) and sum(seen) < 200 * 200 / 4


def test_no_pair_is_verified_twice_and_sets_are_made_for_verified_pairs_alone(spark, monkeypatch):
    """Groups that share a passage: neighbours in several orders are mostly the pairs that hubs have tried."""
    rng = random.Random(3)
    passage = prose(60, 7)
    texts = [t for g in range(6) for t in varied(prose(80, 50 + g) + " " + passage, rng, 6)] + [prose(40, 200 + i) + " " + passage for i in range(20)]
    seen, made = [], []
    real, real_sets = J.verified, J.sets_of

    def counted(pairs, texts_, percent=80):
        seen.append({(r["u"], r["v"]) for r in pairs.collect()})
        return real(pairs, texts_, percent)

    def sets(classes, texts_):
        made.append({r["cid"] for r in classes.collect()})
        return real_sets(classes, texts_)
    monkeypatch.setattr(J, "verified", counted)
    monkeypatch.setattr(J, "sets_of", sets)
    assert rows(J.similar_components(docs(spark, texts))) == brute(list(enumerate(texts)))
    assert sum(map(len, seen)) == len(set().union(*seen)) > 0
    assert made == [{c for pair in pairs for c in pair} for pairs in seen]
