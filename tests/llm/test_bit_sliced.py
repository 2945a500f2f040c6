import math
import random

import numpy as np
import pytest

from spendlake.llm import bit_sliced as B

SCHEMA = "vec_id long, embedding array<double>, score long, block string"


def brute(rows, k=5, divisor=50):
    whole = []
    for i, v in rows:
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ints = [math.floor(256 * x) for x in v]
        if all(abs(x) < 2 ** 53 for x in ints):
            whole.append((i, ints))
    out = []
    for a, (i, q) in enumerate(whole):
        if i is None or i % divisor:
            continue
        best = sorted((-sum(x * y for x, y in zip(q, v)), j is None, j or 0) for b, (j, v) in enumerate(whole) if b != a)[:k]
        out += [(i, n, None if unknown else j, max(-2 ** 63, min(2 ** 63 - 1, -s))) for n, (s, unknown, j) in enumerate(best, 1)]
    return sorted(out, key=repr)


def run(spark, rows, **more):
    df = spark.createDataFrame([(i, v, 7, "x") for i, v in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in B.top_k(df, **more).collect()), key=repr)


def vectors(n, dims, seed, scale=0.3):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, scale) for _ in range(dims)]) for i in range(n)]


@pytest.mark.parametrize("bits", [1, 3, 6, 12])
def test_equals_brute_force_at_any_number_of_slices(spark, bits):
    rows = vectors(700, 16, 3)
    assert run(spark, rows, bits=bits, block=128) == brute(rows)


def test_ties_copies_repeated_ids_and_passes(spark):
    rows = vectors(60, 8, 5) + [(100 + i, [0.5, -0.25] * 4) for i in range(200)] + [(50, [0.5, -0.25] * 4), (50, [0.1] * 8), (None, [0.9] * 8), (None, [0.9] * 8)]
    want = brute(rows)
    assert run(spark, rows, block=64) == want
    assert run(spark, rows, block=64, pass_bytes=300) == want


def test_nulls_odd_components_lengths_and_sizes(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, []), (6, [1.5]), (7, [1.0, 2.0, -3.0]),
            (8, [1e300, 0.0]), (9, [-3e13, 3e13]), (50, [2e13, 3e13]), (100, []), (-50, [-1.0, -0.001]), (None, [5.0, 5.0])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == [] and run(spark, [(0, [1.0])]) == [] and run(spark, [(1, [1.0]), (2, [1.0])]) == []


def test_extreme_weights_of_one_sign(spark):
    rows = [(i, [-1.0 - i % 7, 0.0, -1e-9]) for i in range(130)] + [(150, [0.0, 0.0, 0.0])]
    assert run(spark, rows, bits=2, block=50) == brute(rows)


def test_bitmap_arithmetic():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 50, (9, 200))
    stacks = [[B.packed(values >> p & 1 == 1)] for p in range(6)]
    sums = B.add_up(stacks, 4)
    total = values.sum(axis=0)
    assert (sum(B.unpacked(s, 200).astype(int) << p for p, s in enumerate(sums)) == total).all()
    among = B.packed(np.arange(200) % 3 > 0)
    some = total[np.arange(200) % 3 > 0]
    for k in (1, 5, 60, 133, 500):
        assert B.kth_highest(sums, among, k) == sorted(some)[-min(k, len(some))]
    for bound in (-3, 0, 1, 100, 230, 10 ** 6):
        assert (B.unpacked(B.at_least(sums, among, bound), 200) == ((total >= bound) & (np.arange(200) % 3 > 0))).all()


def test_only_boundary_rows_get_exact_scores(spark, monkeypatch):
    rng = np.random.default_rng(2)
    row = B.block_row(0, list(range(4000)), list((rng.normal(0, 0.1, (4000, 32)) * 256).astype(np.int64)), 6)
    block = B.Block(row)
    rows, scores = block.top(block.whole[0], 5, 0, None)
    assert 5 <= len(rows) < 400
    want = np.argsort(-(block.whole @ block.whole[0]), kind="stable")
    assert set(want[want != 0][:5]) <= set(rows.tolist())
