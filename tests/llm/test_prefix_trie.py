"""The trie against a plain one."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tarmac.llm import prefix_trie as pt

FIELDS = "conv_id long, turn long, role string, text string, place string, `_row` string"


def plain(rows):
    talks = {}
    for c, turn, role, text in rows:
        if c is not None:
            talks.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    talks = {c: [t[2:] for t in sorted(ts, key=lambda t: (t[:3], hashlib.sha256(f"{len(t[2])}:{t[2]}{t[3]}".encode()).hexdigest()))] for c, ts in talks.items()}
    built = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 6
        rest = c % 100 if c >= 0 else -(-c % 100)
        built[c] = tuple(talks.get(c - rest, [])[:h] + own[h:])
    members = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    children = {n: 0 for n in members}
    for n in members:
        if n:
            children[n[:-1]] += 1
    out = []
    for n, ms in members.items():
        below = [m for m in members if m[: len(n)] == n]
        ends = sorted(c for c in ms if built[c] == n)
        saved = sum((len(members[m]) - 1) * len(m[-1][1]) for m in below if m)
        out.append(
            (
                min(ms), len(n), min(members[n[:-1]]) if n else None, len(ms), children[n], sum(not children[m] for m in below), saved,
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def built(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], FIELDS)
    nodes = pt.build(df).drop("from_conv", "from_place")
    return sorted(map(tuple, nodes.collect()), key=str)


def talks(seed, convs=260, words=3):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-150, 500), convs):
        for turn in range(rng.randrange(1, 9)):
            rows.append((c, turn, ["user", "assistant"][turn % 2], "w" * rng.randrange(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_equals_a_plain_trie(spark, seed):
    rows = talks(seed)
    want = plain(rows)
    assert len(want) > 50 and any(w[6] for w in want)
    assert built(spark, rows) == want


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "lost"), (0, None, None, None), (0, None, "b", "x"), (0, 2, "user", "a"), (0, 2, "user", "a"), (0, 2, "assistant", "é" * 9),
        (1, 5, "user", None), (1, 5, "user", ""), (7, 1, "user", "y" * 50_000), (305, 1, "user", "only"), (-3, 1, "a", "b"),
    ]
    assert built(spark, rows) == plain(rows)
    assert built(spark, []) == []
    assert built(spark, rows[:1]) == []


def test_turnless_conversations_have_a_root(spark):
    # One turn of their own, which the opening replaces, and no conversation that lends one.
    short = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6][:5]
    rows = [(c, 1, "user", "x") for c in short]
    assert built(spark, rows) == plain(rows) and len(plain(rows)) == 1


def test_one_long_conversation_and_many_copies_spread_over_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(200, t, "user", str(t)) for t in range(400)]
        rows += [(c, t, "user", "same") for c in range(301, 399) for t in range(8)] + talks(5, 60)
        df = spark.createDataFrame([(*r, "x", "y") for r in rows], FIELDS)
        assert sorted(map(tuple, pt.build(df).drop("from_conv", "from_place").collect()), key=str) == plain(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_pieces_of_ends(spark, monkeypatch):
    monkeypatch.setattr(pt, "PIECE", 3)
    ends = [(9, e) for e in (5, 40, 3, 100, 7, 11, 12)] + [(2, 1)]
    got = {r.conv: r.ends_sha256 for r in pt.end_hashes(spark.createDataFrame(ends, "seq long, end long")).collect()}
    assert got == {9: hashlib.sha256(b"3,5,7,11,12,40,100").hexdigest(), 2: hashlib.sha256(b"1").hexdigest()}


def test_carried_over_many_partitions(spark):
    df = spark.range(1000).select(F.lit(4).cast("long").alias("k"), "id", (F.col("id") * 7919 % 64).alias("h"))
    df = df.unionByName(spark.range(3).select(F.lit(9).cast("long").alias("k"), "id", F.col("id").alias("h")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = sorted((r.k, r.id, r.place, r.x, r.s) for r in pt.carried(df, "k", [F.col("id")], {"x": "h"}, {"s": "h"}).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    x = s = n = 0
    for i, (k, id_, place, xr, sm) in enumerate(rows):
        if i == 1000:
            x = s = n = 0
        h = id_ * 7919 % 64 if k == 4 else id_
        x, s, n = x ^ h, s + h, n + 1
        assert (place, xr, sm) == (n, x, s)


def test_texts_of_nodes(spark):
    rows = talks(3, 80)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], FIELDS)
    got = {(r.conv_id, r.depth): (r.role, r.text) for r in pt.with_texts(pt.build(df), df).collect()}
    own = {}
    for c, turn, role, text in rows:
        own.setdefault(c, {})[turn] = (role, text)
    for (c, d), said in got.items():
        h = zlib.crc32(str(c).encode()) % 6
        lender = own.get(c - (c % 100 if c >= 0 else -(-c % 100)), {})
        whole = [lender[t] for t in sorted(lender)][:h] + [own[c][t] for t in sorted(own[c])][h:]
        assert said == (whole[d - 1] if d else (None, None))
