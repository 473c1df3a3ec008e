"""The stages one after the other, each against a plain reading of what it must do."""

import os

import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from tarmac.llm import order_minhash, pii

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not there")


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "tokens":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        held[name] = docs.collect()
    first, good, one, safe, mixed, last = held.values()
    texts = {r.doc_id: r.text for r in first}
    assert {r.doc_id for r in good} < set(texts) and all(set(r.text.split("\n")) <= set(texts[r.doc_id].split("\n")) for r in good)
    assert all(r.n_chars == len(r.text) for r in good + safe)
    words = {r.doc_id: order_minhash.words_of(r.text) for r in good}
    kept = {r.doc_id for r in one}
    for d in set(words) - kept:
        assert any(order_minhash.similarity(words[d], w) >= 0.8 for e, w in words.items() if e != d)
    assert all(order_minhash.similarity(words[a], words[b]) < 0.8 for a in kept for b in kept if a < b)
    assert {r.doc_id for r in safe} == kept
    assert all(not pii.seeds(r.text) for r in safe) and any(pii.seeds(r.text) for r in one)
    counts = {r.doc_id: 0 for r in safe}
    for r in mixed:
        counts[r.doc_id] += 1
    assert set(counts.values()) <= {0, 1, 2}
    total, taken = (sum(len(r.text.split()) for r in rows) for rows in (safe, mixed))
    assert abs(taken - 1.5 * total) <= 0.1 * total
    assert len(last) == len(mixed) and all(r.round_trip and len(r.ids) == 4 * r.n_tokens for r in last)


def test_registered():
    assert "pipeline" in entry_point.queries()
    numbers = {int(n[2:].split("_")[0]) for n in entry_point.queries() if n.startswith("op") and n[2].isdigit()}
    assert numbers == set(range(1, 14))
