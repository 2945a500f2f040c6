import hashlib
import random
import zlib
from collections import defaultdict

from spendlake.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, depth long, name string"


def brute(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((t is not None, t or 0, role, hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).digest(), text))
    own = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in own.items()}
    nodes = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
        for d in range(len(whole) + 1):
            nodes[whole[:d]].append((c, d == len(whole)))
    children = defaultdict(int)
    for n in nodes:
        if n:
            children[n[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for n, members in nodes.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += n not in children
            saved[n[:d]] += (len(members) - 1) * len(n[-1][1]) if n else 0
    out = []
    for n, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c, end in members if end))
        out.append((min(members)[0], len(n), min(nodes[n[:-1]])[0] if n else None, len(members), children[n], leaves[n], saved[n], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], SCHEMA).repartition(4)
    return sorted((tuple(r) for r in P.conversation_trie(df).collect()), key=repr)


def made(seed, convs, longest, symbols):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"]), rng.choice(symbols)) for c in convs for t in range(rng.randint(1, longest))]


def test_equals_brute_force(spark):
    rows = made(1, [*range(0, 40), *range(100, 130), 307, 308], 9, ["", "a", "bb", "é中"])
    assert run(spark, rows) == brute(rows)


def test_long_sequences_and_a_hot_conversation(spark):
    rows = [(0, t, "user", "x" * (t % 3)) for t in range(300)] + [(c, t, "user", "x" * (t % 3)) for c in (1, 2, 103) for t in range(c * 7 % 64)]
    assert run(spark, rows) == brute(rows)


def test_nulls_ties_repeats_and_turnless_conversations(spark):
    rows = [(0, None, None, None), (0, 0, "user", "b"), (0, 0, "user", "b"), (0, 0, "user", "a"), (0, 0, "assistant", "z"), (None, 0, "user", "lost"),
            (1, 5, "user", "b"), (900, 1, "user", "q" * 100_000), (901, 1, "user", "one"), (902, 1, None, ""), (1203, 0, "", None)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert any(r[1] == 0 and r[3] == 6 for r in got)
    turnless = [c for c in (901, 902, 1203) if zlib.crc32(str(c).encode()) % 6 and c == 1203]
    assert turnless     # 1203 has no base and loses its only turn: it is a member of the root alone


def test_empty_table(spark):
    assert run(spark, []) == []


def test_members_are_digested_over_chunks_in_order(spark, monkeypatch):
    monkeypatch.setattr(P, "CHUNK", 4)
    ids = [-9, -4, -1, 0, 3, 4, 5, 8, 21]
    df = spark.createDataFrame([(b"n", c) for c in ids] + [(b"m", 7)], "name binary, conv long").repartition(3)
    got = {bytes(r["name"]): r["ends_sha256"] for r in P.ends(df).collect()}
    assert got == {b"n": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), b"m": hashlib.sha256(b"7").hexdigest()}
