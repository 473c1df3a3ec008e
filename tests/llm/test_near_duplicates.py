"""Components, sketches, alignment, paragraphs and odd rows."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import components, order_minhash, paragraphs


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for u, v in edges:
        x, y = root(u), root(v)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 40)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    edges += [(5, 5), (300, 300)]
    nodes = {n for e in edges[:-2] for n in e if e[0] != e[1]}
    got = {r.node: r.least for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = roots(nodes, edges[:-2])
    # The least node of a component has no row of its own.
    assert got == {n: r for n, r in want.items() if n != r}


def naive(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_alignment_equals_the_table():
    rng = random.Random(3)
    for _ in range(1500):
        a = [rng.randrange(5) for _ in range(rng.randrange(1, 25))]
        b = list(a)
        for _ in range(rng.randrange(6)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(2)] = [rng.randrange(5)] * rng.randrange(2)
        least, exact = rng.randrange(1, len(a) + 1), naive(a, b)
        assert order_minhash.aligned(a, b, least) == (exact if exact >= least else 0)


def test_sketches_meet_in_proportion():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    near = list(words)
    for at in rng.sample(range(400), 5):
        near[at] = "x"
    assert order_minhash.similarity(words, near) >= 0.8
    a, b = (order_minhash.sketches(order_minhash.runs_of(w)) for w in (words, near))
    assert len(a) == 2 * order_minhash.FUNCTIONS
    short = sum(x == y for x, y in zip(a[::2], b[::2]))
    assert short >= 3 and short >= sum(x == y for x, y in zip(a[1::2], b[1::2]))
    # Order counts: the same runs in another order share no sketch that spans the swap.
    halves = words[200:] + words[:200]
    c = order_minhash.sketches(order_minhash.runs_of(halves))
    assert sum(x == y for x, y in zip(a[1::2], c[1::2])) == 0


def family(rng, n):
    """Texts around one base, with more and more words changed, and strangers."""
    base = [f"b{i}" for i in range(120)]
    out = [(0, " ".join(base))]
    for i in range(1, n):
        words = list(base)
        for at in rng.sample(range(120), i % 9):
            words[at] = f"c{rng.randrange(10**6)}"
        out.append((i, " ".join(words)))
    return out + [(1000 + i, " ".join(f"s{rng.randrange(10**6)}" for _ in range(80))) for i in range(10)]


def test_classes_of_a_family_equal_all_pairs(spark):
    rows = family(random.Random(6), 40)
    got = {r.doc_id: (r.class_id, r.class_size) for r in order_minhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    words = {d: t.split() for d, t in rows}
    links = [(a, b) for a in words for b in words if b < a and order_minhash.similarity(words[a], words[b]) >= 0.8]
    want = roots(words, links)
    sizes = {r: list(want.values()).count(r) for r in want.values()}
    assert got == {d: (r, sizes[r]) for d, r in want.items()}


def test_odd_rows_and_one_of_each_class(spark):
    long = " ".join(f"w{i % 5000}" for i in range(60_000))
    rows = [
        (5, "one two three", "a"), (2, "One, two; THREE!", "b"), (None, "one two three", "c"), (3, None, "d"), (4, "", "e"), (4, "", "e"),
        (9, long, "f"), (8, long + " end", "g"), (7, "x y z u v w", "h"), (7, "x y z u v w", "h"), (6, "one two four", "i"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, class_id string")
    found = sorted(((r.doc_id, r.class_id, r.class_size) for r in order_minhash.classes(df).collect()), key=str)
    assert found == sorted(
        [(5, 2, 3), (2, 2, 3), (None, 2, 3), (3, 3, 1), (4, 4, 1), (4, 4, 1), (9, 8, 2), (8, 8, 2), (7, 7, 2), (7, 7, 2), (6, 6, 1)], key=str
    )
    kept = order_minhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.class_id for r in kept.collect()) == ["b", "d", "e", "e", "g", "h", "i"]


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert order_minhash.classes(df).collect() == [] and order_minhash.keep_one(df).collect() == []
    assert paragraphs.repeated(df).collect() == []


def test_bands_are_tuned_for_recall():
    assert paragraphs.tuned(paragraphs.BANDS, paragraphs.ROWS) >= 0.95


def prose(rng, n):
    words = [f"{rng.choice('abcdefgh')}{rng.randrange(10**5)}" for _ in range(n)]
    return "".join(w + (". " if rng.random() < 0.12 else " ") for w in words).strip() + "."


def test_passages_inside_paragraphs(spark):
    rng = random.Random(8)
    rows, holders = [], {}
    for p in range(12):
        passage = prose(rng, 60)
        for k in range(rng.randrange(2, 5)):
            doc = len(rows)
            # In the middle of a line, in the middle of a sentence.
            rows.append((doc, f"{prose(rng, 70)[:-1]} {passage} {prose(rng, 90)}"))
            holders.setdefault(p, []).append(doc)
    rows += [(1000 + i, prose(rng, 200) + "\nOf.\nA line they all have.") for i in range(12)]
    rows += [(2000, None), (2001, ""), (2002, "Again and again. " * 50)]
    found = paragraphs.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    flagged = {r.doc_id for r in found}
    planted = {d for ds in holders.values() for d in ds}
    assert flagged <= planted and len(flagged) >= 0.9 * len(planted)
    firsts = {d: min(ds) for ds in holders.values() for d in ds}
    text = dict(rows)
    for r in found:
        assert r.first_doc_id in holders[next(p for p, ds in holders.items() if r.doc_id in ds)]
        assert r.remove == (r.doc_id != r.first_doc_id)
        assert r.words == len(re.findall(r"\w+", text[r.doc_id][r.start : r.end]))
    assert firsts


@pytest.mark.parametrize("text", ["", "\n\n", "...", "a" * 1000, "word " * 5000, "One. Two! Three? 4.0 is five.\nSix", "é. ß! 漢字。"])
def test_paragraphs_hold_every_word_once(text):
    found = paragraphs.paragraphs(text)
    assert sum(len(h) for _, _, h in found) == len(re.findall(r"\w+", text))
    assert all(len(re.findall(r"\w+", text[s:e])) == len(h) for s, e, h in found)
    assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))


def test_texts_read_together_fall_into_the_same_paragraphs():
    sentence = re.compile(r"[^\n.!?…]+(?:[.!?…](?![\x20\x09-\x0D]|\Z)[^\n.!?…]*)*[.!?…]*|[.!?…]+")
    rng = random.Random(16)
    texts = ["".join(rng.choice("ab. .!?…\n\t\x0b é9_Σ İ漢ǅ²") for _ in range(rng.randrange(0, 300))) for _ in range(300)]
    texts += ["", prose(rng, 500), "x" * 10_000 + " " + "Y" * 9_000, "..a b", "4.0 is. five.\n\n...six"]

    def expected(text):
        out, held, start, end = [], 0, 0, 0
        for m in sentence.finditer(text):
            if not (n := len(re.findall(r"\w+", m.group()))):
                continue
            if held and (n > paragraphs.LONG_SENTENCE or "\n" in text[end : m.start()]):
                out.append((start, end))
                held = 0
            if n > paragraphs.LONG_SENTENCE:
                out.append((m.start(), m.end()))
                continue
            start = start if held else m.start()
            held, end = held + n, m.end()
            if n >= paragraphs.ENDING_WORDS:
                out.append((start, end))
                held = 0
        return out + [(start, end)] * bool(held)

    r = paragraphs.read(texts)
    firsts, begins, ends = paragraphs.cut(r)
    owner = np.searchsorted(r.firsts, firsts, "right") - 1
    hashes = {}
    for i, text in enumerate(texts):
        words = [w.lower() for w in re.findall(r"\w+", text)]
        for w, h in zip(words, r.ids[r.firsts[i] : r.firsts[i + 1]].tolist(), strict=True):
            assert hashes.setdefault(w, h) == h
        own = [(int(b - r.offsets[i]), int(e - r.offsets[i])) for b, e in zip(begins[owner == i], ends[owner == i])]
        assert own == [p[:2] for p in paragraphs.paragraphs(text)]
        # Pieces of a long sentence hold its words, without the marks at its end.
        whole = [p for p in expected(text) if len(re.findall(r"\w+", text[slice(*p)])) <= paragraphs.LONG_SENTENCE]
        long = [p for p in expected(text) if p not in whole]
        assert [p for p in own if not any(a <= p[0] and p[1] <= b for a, b in long)] == whole
    assert len(set(hashes.values())) == len(hashes)


def test_only_keys_of_different_paragraphs_come_back(spark):
    rng = random.Random(17)
    rows = [(i, prose(rng, 120)) for i in range(40)]
    # Copies meet in their block; a word at the edge of a sentence makes a near copy.
    rows += [(100 + i, t) for i, t in rows[:20]] + [(200 + i, re.sub(r"\. (\w+)", r". Other", t)) for i, t in rows[:10]]
    rows += [(300, None), (301, "..."), (302, "one two")]
    _, sketches, _ = paragraphs.measure(spark.createDataFrame(rows, "doc_id long, text string"))
    holders = {}
    for r in sketches.collect():
        counts = paragraphs.counted(np.array(r.words), paragraphs.BANDS, paragraphs.LEAST).tolist()
        assert len(r["keys"]) == sum(counts)
        keys = iter(r["keys"])
        for node, n in zip(r.nodes, counts):
            for _ in range(n):
                holders.setdefault(next(keys), set()).add(node)
    expected = sorted((k, n) for k, ns in holders.items() if len(ns) > 1 for n in ns)
    assert expected
    assert sorted(map(tuple, paragraphs._met(sketches, paragraphs.BANDS, paragraphs.LEAST).collect())) == expected


def test_sketches_are_dropped_once_read(spark):
    from tarmac import session

    before = len(session._STAGES)
    rng = random.Random(18)
    shared = prose(rng, 60)
    df = spark.createDataFrame([(i, f"{prose(rng, 40)} {shared} {prose(rng, 40)}") for i in range(6)], "doc_id long, text string")
    found = paragraphs.repeated(df)
    # Keys and windows are most of what is stored; passages are read from the rest.
    stored = [spark.read.parquet(p) for p in session._STAGES[before:]]
    assert not [x for x in stored if "windows" in x.columns and not x.where("windows is not null").isEmpty()]
    assert sorted((r.doc_id, r.first_doc_id, r.remove) for r in found.collect()) == [(i, 0, i > 0) for i in range(6)]


def test_keys_are_dropped_before_texts_are_dealt(spark, monkeypatch):
    from tarmac import session

    before, seen = len(session._STAGES), []
    words = paragraphs._words

    def stored(column):
        kinds = [x for p in session._STAGES[before:] for x in [spark.read.parquet(p)] if column in x.columns]
        return sum(x.where(F.col(column).isNotNull()).count() for x in kinds)

    def watched(*args):
        seen.append((stored("keys"), stored("nodes"), stored("windows")))
        return words(*args)

    monkeypatch.setattr(paragraphs, "_words", watched)
    rng = random.Random(19)
    shared = prose(rng, 60)
    df = spark.createDataFrame([(i, f"{prose(rng, 40)} {shared} {prose(rng, 40)}") for i in range(6)], "doc_id long, text string")
    found = paragraphs.repeated(df)
    # Keys are most of what is stored; nodes and windows are still to be read.
    assert seen == [(0, 6, 6)]
    assert sorted((r.doc_id, r.first_doc_id, r.remove) for r in found.collect()) == [(i, 0, i > 0) for i in range(6)]


def test_every_passage_of_51_words_is_found_whole(spark):
    rng = random.Random(11)
    word = lambda: f"{rng.choice('abcdefgh')}{rng.randrange(10**5)}"
    rows, at = [], []
    for p in range(40):
        # Long sentences around and within the passage; marks and lines differ between its two places.
        passage = [word() for _ in range(51)]
        for _ in range(2):
            before, after = ([word() for _ in range(33)] for _ in range(2))
            marked = [w + rng.choice(["", "", "", "", ",", ".", "\n"]) for w in passage]
            rows.append((len(rows), " ".join([*before, *marked, *after]) + "."))
            at.append(passage)
    found = {}
    for r in paragraphs.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        found.setdefault(r.doc_id, []).append(re.findall(r"\w+", rows[r.doc_id][1][r.start : r.end]))
    assert found == {d: [passage] for d, passage in enumerate(at)}


def test_equal_windows_against_all_windows():
    rng = np.random.default_rng(5)
    size, half = paragraphs.LEAST_WORDS, (paragraphs.LEAST_WORDS + 1) // 2
    for n in (0, 24, 25, 40, 300):
        ids = rng.integers(0, 9, n).astype(np.uint64)
        hashed = paragraphs.windows(ids, size)
        assert len(hashed) == max(0, n - size + 1)
        by_words = {}
        for i, h in enumerate(hashed.tolist()):
            assert by_words.setdefault(tuple(ids[i : i + size].tolist()), h) == h
        assert len(set(by_words.values())) == len(by_words)
        begins = paragraphs.chosen(ids, size).tolist()
        assert all(b - a <= half for a, b in zip(begins, begins[1:]))
        assert n < size + half - 1 or begins[0] < half


def test_siblings_on_a_template_meet(spark):
    rng = random.Random(12)
    word = lambda: f"{rng.choice('abcdefgh')}{rng.randrange(10**5)}"
    rows = []
    for _ in range(4):
        core = [[word() for _ in range(19)] for _ in range(2)]
        for _ in range(20):
            # Two are 0.81 alike, others of the template 0.65; no run of 25 words is equal.
            inner = [[word(), *c, word()] for c in core]
            for _ in range(2):
                rows.append((len(rows), " ".join(" ".join([word(), *i, word()]) + "." for i in inner)))
    found = {r.doc_id: r.words for r in paragraphs.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # At 0.81, 0.17 % of the paragraphs' pairs share no key.
    assert set(found.values()) == {46} and len(found) >= 0.97 * len(rows)


def test_members_of_a_short_bucket_meet_without_its_least(spark):
    rng = random.Random(13)
    pair = [f"w{i}" for i in range(200)]
    other = pair[:-4] + ["x", "y", "z", "end"]
    node = lambda words: hashlib.blake2b(" ".join(words).encode(), digest_size=16).digest()
    unlike = pair
    while node(unlike) >= min(node(pair), node(other)):
        unlike = [f"u{rng.randrange(10**6)}" for _ in range(200)]
    rows = [(i, " ".join(words)) for i, words in enumerate([pair, other, unlike])]
    measured = order_minhash.measure(spark.createDataFrame(rows, "doc_id long, text string"))
    # All three share the short key alone, and its least member is unlike the others.
    keys = F.array(F.lit(1).cast("long"), F.xxhash64("node"))
    found = order_minhash.links(measured.withColumn("sketches", keys)).collect()
    assert [(bytes(r.node), bytes(r.least)) for r in found] == [tuple(sorted([node(pair), node(other)], reverse=True))]


def test_counts_never_rule_out_similar_texts():
    rng = random.Random(14)
    for _ in range(300):
        a = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(1, 300))]
        b = [w if rng.random() > 0.03 else "x" for w in a]
        one, two = (
            np.frombuffer(order_minhash.counts_of(order_minhash.labelled(order_minhash.runs_of(w))), dtype="<u4")[None, :] for w in (a, b)
        )
        assert order_minhash.similarity(a, b) < 0.8 or order_minhash.may_match(one, two)[0]


def template(rng, n, length=150, edits=(1, 12, 15, 18)):
    """Texts on one template, most of them too far from it and from each other, and pairs of siblings among these."""
    base = [f"t{i}" for i in range(length)]
    rows = []
    for i in range(n):
        words = list(base)
        for at in rng.sample(range(length), edits[i % 4]):
            words[at] = f"c{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
        if i % 10 == 1:
            words[rng.randrange(length)] = "x"
            rows.append((1000 + i, " ".join(words[: length - rng.randrange(15)])))
    return rows


def test_members_on_a_template_do_not_all_meet(spark, monkeypatch):
    # So long that counts by parts of the hashes rule out nothing.
    rows = template(random.Random(15), 80, 3000, (1, 75, 80, 85))
    words = {d: t.split() for d, t in rows}
    linked = [(a, b) for a in words for b in words if b < a and order_minhash.similarity(words[a], words[b]) >= 0.8]
    want = roots(words, linked)
    sizes = {r: list(want.values()).count(r) for r in want.values()}
    met, verified = [], order_minhash.verified
    monkeypatch.setattr(order_minhash, "verified", lambda pairs, *rest: met.append(pairs.count()) or verified(pairs, *rest))
    got = {r.doc_id: (r.class_id, r.class_size) for r in order_minhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: (r, sizes[r]) for d, r in want.items()}
    # After the stars, and with 8 pairs of siblings to find.
    assert sum(met[1:]) < 2 * len(rows)


def test_pairs_by_their_differences_from_a_pivot_equal_all_pairs(spark):
    rows = template(random.Random(16), 60)
    measured = order_minhash.measure(spark.createDataFrame(rows, "doc_id long, text string"))
    bodies = measured.select("node", "body")
    for pivot in (0, 1, 2):
        u = measured.where(F.col("doc_id") == pivot).select(F.col("node").alias("u"))
        against = order_minhash.compared(u.crossJoin(bodies.select(F.col("node").alias("v"))), bodies)
        found = order_minhash._unlike_pivot(against, components.components(against.where("alike").select("u", "v")), order_minhash.LEAST)
        texts = {bytes(r.node): rows_ for r in measured.collect() for rows_ in [dict(rows)[r.doc_id].split()]}
        home = {bytes(r.v) for r in against.where("alike").collect()} | {bytes(u.first().u)}
        pairs = {(bytes(r.u), bytes(r.v)) for r in found.collect()}
        assert all(a < b and not {a, b} <= home for a, b in pairs)
        want = {(a, b) for a in texts for b in texts if a < b and not {a, b} <= home and order_minhash.similarity(texts[a], texts[b]) >= 0.8}
        assert want and want <= pairs


def test_members_bring_no_more_runs_than_tell_them_apart(spark):
    rng = random.Random(17)
    word = lambda: f"o{rng.randrange(10**6)}"
    # One long repeated passage, a part that half of the members share, then a text of their own; every fifth has a sibling.
    passage, half, rows = ["is", "on"] * 60, [word() for _ in range(20)], [(0, " ".join(["is", "on"] * 60 + ["end", *(word() for _ in range(30))]))]
    for i in range(1, 60):
        words = passage + (half if i % 2 else []) + [word() for _ in range(50)]
        rows.append((i, " ".join(words)))
        if i % 5 == 0:
            words[-rng.randrange(1, 9)] = "x"
            rows.append((1000 + i, " ".join(words + [word()])))
    texts = {d: t.split() for d, t in rows}
    node = {d: hashlib.blake2b(t.encode(), digest_size=16).digest() for d, t in rows}
    bodies = order_minhash.measure(spark.createDataFrame(rows, "doc_id long, text string")).select("node", "body")
    pivot = bodies.where(F.col("node") == F.lit(node[0])).select(F.col("node").alias("u"))
    against = order_minhash.compared(pivot.crossJoin(bodies.select(F.col("node").alias("v"))), bodies)
    named = {d: set(order_minhash.labelled(order_minhash.runs_of(w)).view(np.int64).tolist()) for d, w in texts.items()}
    assert {bytes(r.v): set(r.own) for r in against.collect()} == {node[d]: named[d] - named[0] for d in texts}
    met, placed = [], order_minhash._rarest_first
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(order_minhash, "_rarest_first", lambda each: met.append(placed(each)) or met[0])
        found = order_minhash._unlike_pivot(against, spark.createDataFrame([], "node binary, least binary"), order_minhash.LEAST)
    pairs = {(bytes(r.u), bytes(r.v)) for r in found.collect()}
    want = {
        tuple(sorted((node[a], node[b]))) for a in texts for b in texts
        if 0 < a < b and order_minhash.similarity(texts[a], texts[b]) >= 0.8
    }
    assert len(want) == 11 and want <= pairs and len(pairs) < 3 * len(rows)
    brought = met[0].groupBy("v").agg(F.count("*").alias("n"), F.first("size").alias("size")).collect()
    assert all(r.n <= 0.2 * r.size + 1 for r in brought)
    assert sum(r.n for r in brought) < 0.7 * sum(len(named[d] - named[0]) for d in texts)
