"""Mining against all pairs, and residue arithmetic against Python's integers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import hard_negatives as hn

FIELDS = "vec_id long, embedding array<double>, label int, row string, shard string, parts string"


def brute(rows, positives=5, negatives=10):
    whole = [
        (i, key, [math.floor(256 * x) for x in v], label)
        for i, (key, v, label, *_) in enumerate(rows)
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for i, key, q, label in whole:
        if key is None or key % 3:
            continue
        best = sorted(((-score(q, v), o is None, o or 0, j) for j, o, v, l in whole if l == label and j != i))[:positives]
        for ps, no_id, p, _ in best:
            window = [
                (-s, o is None, o or 0)
                for _, o, v, l in whole
                if l != label and 30 * -ps <= 100 * (s := score(q, v)) <= 90 * -ps
            ]
            for rank, (ns, none, o) in enumerate(sorted(window)[:negatives], 1):
                out.append((key, None if no_id else p, rank, None if none else o, -ps, -ns))
    return sorted(out, key=str)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], FIELDS)
    return sorted((tuple(r) for r in hn.mine(df, F.col("id") % 3 == 0, **options).collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    grid = seed == 1  # many ties
    rows = [
        (i, [rng.choice([-1.0, 0.0, 0.5]) if grid else rng.gauss(0.2, 1) for _ in range(6)], rng.choice([0, 1, 1, 1, 2]))
        for i in range(90)
    ]
    want = brute(rows)
    assert len(want) > 100
    assert mined(spark, rows, shard_rows=20, anchor_rows=7) == want


def test_odd_rows(spark):
    rows = [
        (0, [1.0, -2.0], 1), (0, [1.0, -2.0], 1), (3, [0.5, 0.0], 2), (3, [], 1), (None, [1.0, -1.0], 1), (6, None, 1),
        (9, [float("nan"), 1.0], 1), (12, [float("inf")], 1), (15, [None, 1.0], 1), (18, [0.5, 0.5, 4.0], 2), (7, [0.9], None),
        (None, [0.5, -1.0], 2), (8, [0.5, -1.0], 3), (8, [0.5, -1.0], 3),
    ]
    want = brute(rows)
    assert want and mined(spark, rows) == want
    assert mined(spark, rows[:1]) == []
    assert mined(spark, []) == []


def test_scores_are_exact():
    rng = np.random.default_rng(3)
    for largest, width in ((3, 1), (200, 64), (10**6, 3000), (2**40, 5), (2**62, 7)):
        a, b = (rng.integers(-largest, largest + 1, (n, width)) for n in (9, 11))
        exact = a.astype(object) @ b.astype(object).T
        want = np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)
        assert (hn.scores(a, b) == want).all()
    ends = np.array([[-(2**63)], [2**63 - 1], [0]])
    assert (hn.scores(ends, np.array([[1], [-1]])) == [[-(2**63), 2**63 - 1], [2**63 - 1, -(2**63) + 1], [0, 0]]).all()


def test_float32_products_stay_exact():
    p = hn.primes()[0]
    worst = np.full((1, 5000), p // 2)
    assert hn.product_modulo(worst, worst, p)[0, 0] == (p // 2) ** 2 * 5000 % p
    for bound in (0, 1, 10**3, 10**18, 2**140):
        assert math.prod(hn.moduli(bound)) > 2 * bound


def test_windows_are_closed():
    assert hn.window_of(10, (30, 100), (90, 100)) == (3, 9)
    assert hn.window_of(11, (30, 100), (90, 100)) == (4, 9)
    assert hn.window_of(0, (30, 100), (90, 100)) == (0, 0)
    low, high = hn.window_of(-10, (30, 100), (90, 100))
    assert low > high
