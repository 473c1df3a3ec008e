"""Search against all pairs, for vectors of all kinds."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tarmac.llm import maxscore

FIELDS = "vec_id long, embedding array<double>, score string"


def best(rows, k):
    """(query id, rank, id, score) from all pairs of rows."""
    whole = [
        (i, key, [math.floor(256 * x) for x in v])
        for i, (key, v, *_) in enumerate(rows)
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, key, q in whole:
        if key is None or key % 3:
            continue
        found = [(sum(a * b for a, b in zip(q, v)), other) for j, other, v in whole if j != i]
        found.sort(key=lambda f: (-f[0], f[1] is None, f[1] or 0))
        out += [(key, n + 1, other, score) for n, (score, other) in enumerate(found[:k])]
    return sorted(out, key=str)


def search(spark, rows, k, **options):
    df = spark.createDataFrame(rows, FIELDS)
    return sorted((tuple(r) for r in maxscore.search(df, F.col("id") % 3 == 0, k, **options).collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    grid = seed == 1  # many ties
    rows = [
        (i, [rng.choice([-1.0, 0.0, 0.5]) if grid else rng.gauss(0, 1) for _ in range(6)], "x") for i in range(90)
    ]
    assert search(spark, rows, 5, shard_rows=20, query_rows=7) == best(rows, 5)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, -2.0], "a"), (0, [1.0, -2.0], "a"), (3, [0.0, 0.0], "b"), (3, [], "c"), (None, [1.0, 1.0], "d"), (6, None, "e"),
        (9, [float("nan"), 1.0], "f"), (12, [float("inf")], "g"), (15, [None, 1.0], "h"), (18, [0.5, 0.5, 4.0], "i"), (7, [-1e-9], "j"),
    ]
    assert search(spark, rows, 4) == best(rows, 4)
    assert search(spark, rows[:1], 4) == []
    assert search(spark, [], 4) == []


def test_large_components_saturate(spark):
    rows = [(0, [1e300], "a"), (1, [1e300], "b"), (2, [-1e300], "c")]
    assert search(spark, rows, 2) == [(0, 1, 1, 2**63 - 1), (0, 2, 2, -(2**63))]


def test_pruning_keeps_what_counts():
    import numpy as np

    rng = np.random.default_rng(1)
    vectors = rng.integers(-50, 50, (400, 12))
    shard = maxscore.Shard(np.arange(400), np.arange(400), np.zeros(400, dtype=bool), vectors)
    for q in range(0, 400, 40):
        scores = vectors @ vectors[q]
        want = sorted(((-int(s), i) for i, s in enumerate(scores) if i != q))[:5]
        assert shard.best(q, vectors[q], 5) == [(i, -s) for s, i in want]
