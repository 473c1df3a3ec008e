"""Best fit against a plain search, matrices read back, and odd rows."""

import random
from array import array

import numpy as np
import pytest

from tarmac.llm import packing


def test_pack_is_best_fit_longest_first():
    rng = random.Random(2)
    for _ in range(200):
        capacity = rng.randint(1, 50)
        lengths = [rng.randint(1, capacity) for _ in range(rng.randrange(80))]
        rows = packing.pack(lengths, capacity)
        assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
        free = []
        for n in sorted(lengths, reverse=True):
            fit = min((f for f in free if f >= n), default=None)
            if fit is not None:
                free.remove(fit)
            free.append((capacity if fit is None else fit) - n)
        assert sorted(capacity - sum(lengths[i] for i in r) for r in rows) == sorted(free)


def frame(spark, docs):
    return spark.createDataFrame([(d, None if x is None else array("I", x).tobytes(), "r") for d, x in docs], "doc_id long, ids binary, row string")


def test_round_trip_with_splits_and_resets(spark):
    rng = random.Random(3)
    docs = [(i, [rng.randrange(1, 50_000) for _ in range(rng.randrange(90))]) for i in range(40)] + [(40, list(range(1, 1001))), (41, []), (42, None)]
    index = packing.write(frame(spark, docs), capacity=64, end=50_256, batch_tokens=500)
    held = {}
    for r in packing.read(index).collect():
        held.setdefault(r.doc_id, []).append((r.first, list(array("I", bytes(r.ids)))))
    assert {d: sum((p for _, p in sorted(parts)), []) for d, parts in held.items()} == {d: [*(x or []), 50_256] for d, x in docs}
    for r in index.collect():
        ids, positions = packing.load(f"{r.file}.ids.npy"), packing.load(f"{r.file}.positions.npy")
        assert ids.shape == positions.shape and ids.dtype == np.uint16 and r.n_tokens == r.cumulative[-1] <= 64
        want = [k for a, b in zip(r.cumulative, r.cumulative[1:]) for k in range(b - a)]
        assert positions[r.row].tolist() == want + [0] * (64 - len(want))
        begins, ends = packing.load(f"{r.file}.begins.npy"), packing.load(f"{r.file}.cumulative.npy")
        assert ends[begins[r.row] :][: len(r.cumulative)].tolist() == r.cumulative


def test_null_keys_repeated_rows_and_no_rows(spark):
    docs = [(None, [1, 2]), (2**60 + 1, [3]), (2**60 + 1, [3]), (5, [])]
    rows = packing.read(packing.write(frame(spark, docs))).collect()
    assert sorted((r.doc_id, list(array("I", bytes(r.ids)))) for r in rows if r.doc_id) == [(2**60 + 1, [3])] * 2
    assert [list(array("I", bytes(r.ids))) for r in rows if r.doc_id is None] == [[1, 2]]
    assert packing.write(frame(spark, docs).limit(0)).collect() == []


def test_ids_that_do_not_fit(spark):
    df = frame(spark, [(1, [70_000])])
    assert packing.write(df, wide=True).first().n_tokens == 1
    with pytest.raises(Exception, match="write it wide"):
        packing.write(df)
