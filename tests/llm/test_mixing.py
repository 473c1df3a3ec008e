"""Targets against a plain computation, and odd rows."""

import random
from fractions import Fraction

import pytest

from tarmac.llm import mixing


def level(sizes, weights, share, most):
    """Stop every source above its cap, share the rest again, until none is above."""
    budget, stopped = share * sum(sizes), {}
    while len(stopped) < len(sizes):
        open_ = [i for i in range(len(sizes)) if i not in stopped]
        each = (budget - sum(stopped.values())) / sum(weights[i] for i in open_)
        above = {i: Fraction(most * sizes[i]) for i in open_ if each * weights[i] > most * sizes[i]}
        if not above:
            return [stopped.get(i, each * weights[i]) for i in range(len(sizes))]
        stopped |= above
    return [stopped[i] for i in range(len(sizes))]


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_taken_words(spark, seed):
    rng = random.Random(seed)
    sources = ["b", "a", "é", "Z", None]
    rows = [(i, "w " * rng.randrange(40), sources[min(int(rng.expovariate(0.7)), 4)]) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    measured = mixing.measure(df)
    out = mixing.assign(measured, mixing.plan(measured)).collect()
    ordered = [s for s in ["Z", "a", "b", "é", None] if any(r[2] == s for r in rows)]
    sizes = [sum(len(t.split()) for _, t, x in rows if x == s) for s in ordered]
    want = level(sizes, [(3, 1, 2)[i % 3] for i in range(len(ordered))], Fraction(3, 2), 2)
    assert len(out) == len(rows)
    for s, size, target in zip(ordered, sizes, want):
        own = [r for r in out if r.source == s]
        assert {r.source_size for r in own} == {size}
        assert all(r.target == pytest.approx(float(target)) for r in own)
        assert abs(sum(r.size * r.copies for r in own) - target) <= max(r.size for r in own) / 2
        assert max(r.copies for r in own) <= 2


def test_larger_budgets_take_supersets(spark):
    df = spark.createDataFrame([(i, "a b c", "s" if i % 2 else "t") for i in range(200)], "doc_id long, text string, source string")
    measured = mixing.measure(df)
    taken = []
    for share in (Fraction(1, 4), Fraction(1, 2), Fraction(3, 4)):
        rows = mixing.assign(measured, mixing.plan(measured, share=share)).collect()
        taken.append({r.doc_id for r in rows if r.copies})
    assert taken[0] < taken[1] < taken[2]


def test_odd_rows(spark):
    rows = [(1, None, None, 7), (None, "", "s", 8), (2, "x y", "s", 9), (2, "x y", "s", 9), (None, "z " * 100_000, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, target int")
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    out = mixed.collect()
    assert {tuple(r) for r in out} <= set(rows)
    # Identical rows fall together.
    assert len([r for r in out if r.doc_id == 2]) % 2 == 0


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(df).collect() == []
    blank = spark.createDataFrame([(1, "", "s")], "doc_id long, text string, source string")
    measured = mixing.measure(blank)
    assert [(r.size, r.target) for r in mixing.assign(measured, mixing.plan(measured)).collect()] == [(0, 0.0)]
