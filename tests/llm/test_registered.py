"""Registered queries against their SQL, or against a plain computation over the same small tables."""

import base64
import hashlib
import os
import re
import zlib
from array import array

import duckdb
import public_tokenizers
import pytest
import tiktoken

from tarmac.llm import order_minhash, paragraphs
from tarmac.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not there")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = duck.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert sorted(map(tuple, df.select(*columns).collect()), key=str) == sorted(
        (tuple(r[i] for i in order) for r in want.fetchall()), key=str
    )


@pytest.mark.parametrize("name", ["op1_source_mix", "op4_line_quality", "op13_virtual_slots"])
def test_native(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


def test_reruns_of_the_mix_agree(spark):
    one, two = (sorted(map(tuple, QUERIES["op1_source_mix"](spark, SF).collect())) for _ in range(2))
    assert one == two


def test_byte_bpe_equals_the_library(spark, texts):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = QUERIES["op2_byte_bpe"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = plain.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_repeated_passages_are_found_and_the_rest_is_left_alone(spark, texts):
    rows = QUERIES["op3_paragraphs"](spark, SF).collect()
    words = {d: re.findall(r"\w+", t.lower()) for d, t in texts.items()}

    def sharing(n):
        holders = {}
        for d, w in words.items():
            for i in range(len(w) - n + 1):
                holders.setdefault(tuple(w[i : i + n]), set()).add(d)
        return set().union(*(h for h in holders.values() if len(h) > 1))

    found = {r.doc_id for r in rows}
    certain = sharing(60)
    assert len(certain - found) <= 0.05 * len(certain)
    assert found <= sharing(paragraphs.LEAST_WORDS // 2)


def test_packed_rows_hold_every_token_once(spark):
    rows = QUERIES["op5_packing"](spark, SF).collect()
    sizes = {r.doc_id: r.n_tokens + 1 for r in QUERIES["op2_byte_bpe"](spark, SF).collect()}
    held = {}
    for r in rows:
        assert r.n_tokens == r.cumulative[-1] <= 2048 and r.n_segments == len(r.doc_ids) == len(r.cumulative) - 1
        for d, first, a, b in zip(r.doc_ids, r.firsts, r.cumulative, r.cumulative[1:]):
            held.setdefault(d, []).append((first, b - a))
    for d, parts in held.items():
        at = 0
        for first, n in sorted(parts):
            assert first == at
            at += n
        assert at == sizes.pop(d)
    assert not sizes


def test_classes_equal_all_pairs(spark, texts):
    got = {r.doc_id: r.class_id for r in QUERIES["op9_order_minhash"](spark, SF).collect()}
    words = {d: order_minhash.words_of(t) for d, t in texts.items()}
    parent = {d: d for d in texts}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if words[a] and words[b] and order_minhash.similarity(words[a], words[b]) >= 0.8:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    assert got == {d: root(d) for d in ids}
    assert len(set(got.values())) < len(got)


def test_shards_hold_every_document_once(spark, duck):
    rows = QUERIES["op13_virtual_slots"](spark, SF).collect()
    texts = duck.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall()
    want = sorted((d, len(t.encode()) + 1, zlib.crc32(t.encode())) for d, t in texts)
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    held = {}
    for r in rows:
        assert r.law == "bytes" and r.grown_shard is None
        held.setdefault(r.shard, []).append(r)
    assert sorted(held) == list(range(8))
    assert all(sorted(r.slot for r in rs) == list(range(len(rs))) for rs in held.values())
    # The largest document is larger than an equal share less the rest can even out.
    share, largest = sum(w[1] for w in want) / 8, max(w[1] for w in want)
    assert max(sum(r.size for r in rs) for rs in held.values()) < max(1.05 * share, largest + 1)
