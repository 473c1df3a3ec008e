"""Fixed patterns against plain regular expressions, learnt contexts, masking and odd rows."""

import hashlib
import random
import re
import time

import pytest

from tarmac.llm import pii
from tarmac.llm.queries import QUERIES

#: The contract's patterns.
PLAIN = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
]


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += (d * 2 - 9 if d > 4 else d * 2) if i % 2 else d
    return total % 10 == 0


def plain(text):
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = (
                True, kind == 1 and all(int(p) <= 255 for p in m.group().split(".")),
                14 <= len(digits) <= 19 and luhn(digits), 10 <= len(digits) <= 15,
            )
            if good[kind]:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_seeds_equal_plain_patterns():
    rng, n = random.Random(5), 0
    for i in range(30_000):
        text = "".join(rng.choice(rng.choice(["0123456789", "@.+- ()", "ab.%_é\n"])) for _ in range(rng.randrange(40)))
        text = text.replace("a", "4").replace("b", " ") if i % 4 == 0 else text
        want = plain(text)
        assert [(s.start, s.kind, s.end) for s in pii.seeds(text)] == want
        n += len(want)
    assert n > 100


@pytest.mark.parametrize("part", ["1", "a", "1.", "+1((", "a@", "1 ", "a1-", "+", "1234567 ", "(at)", "a.b@c "])
def test_long_texts_take_linear_time(part):
    text, began = part * (300_000 // len(part)), time.time()
    pii.candidates(text, pii.seeds(text))
    assert time.time() - began < 10


def test_contexts_find_unseen_identifiers(spark):
    rows = [(i, f"text {i} call me at +1 (310) 555-{1000 + i} soon") for i in range(6)]
    rows += [(100, "please call me at 310 555 9999 soon"), (101, "page 310 555 8888 of it"), (102, "so 1 310-555-1003 again")]
    found = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [tuple(s) for s in found[100].spans] == [(18, 3, 30)] and found[100].base == []
    assert found[101].spans == []
    # The characters of a seed, written otherwise.
    assert [tuple(s) for s in found[102].spans] == [(3, 3, 17)]
    assert all(found[i].spans == found[i].base != [] for i in range(6))


def test_found_identifiers_teach_new_contexts(spark):
    rows = [(i, f"call me at +1 (310) 555-{1000 + i} soon") for i in range(5)]
    rows += [(10 + i, f"call me at 310 555 {2000 + i} soon") for i in range(1)]
    rows += [(20, "my line is 310 555 2000 now"), (21, "my line is +1 (310) 555-7001 now"), (22, "my line is +1 (310) 555-7002 now"),
             (23, "my line is +1 (310) 555-7003 now"), (24, "my line is 444 555 6666 now")]
    found = {r.doc_id: len(r.spans) for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string"), sure=0.6).collect()}
    assert found[10] == found[20] == found[24] == 1


def test_masking_and_odd_rows(spark):
    rows = [
        (1, "mail a.b@c.org now", 18, "x"), (None, None, None, "x"), (2, "", 0, "x"), (1, "mail a.b@c.org now", 18, "x"),
        (3, "é 1.2.3.4 " * 20_000, 1, "long"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, spans string")
    out = pii.redact(df, length="n_chars")
    assert out.columns == df.columns
    got = sorted((tuple(r) for r in out.collect()), key=str)
    one = (1, "mail [EMAIL] now", 16, "x")
    assert got == sorted([one, one, (None, None, None, "x"), (2, "", 0, "x"), (3, "é [IP] " * 20_000, 140_000, "long")], key=str)
    assert sorted(pii.find(df).columns) == ["base", "doc_id", "n_chars", "spans"]
    assert pii.find(df.limit(0)).collect() == [] and pii.redact(df.limit(0)).collect() == []


def test_spans_are_told_in_order(spark):
    text = "+1 (310) 555-1001 a@b.co 4111 1111 1111 1111"
    row = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).select(pii.told("spans").alias("t")).first()
    assert row.t == "phone:0:17,email:18:24,card:25:44"


def test_rounds_go_on_until_nothing_new_is_found(spark):
    # Pattern k holds ten instances of level k and one of each ten of level k + 1, known a round later.
    rows = [(f"p{k}-{j}", f"id{k}-{i}", 0 if k == 0 else -1) for k in range(6) for j in range(10) for i in range(10)]
    rows += [(f"p{k}-{j}", f"id{k + 1}-{j}", -1) for k in range(5) for j in range(10)]
    found = pii.bootstrap(spark.createDataFrame(rows, "pattern string, instance string, kind int")).collect()
    assert {r.instance for r in found} == {f"id{k}-{i}" for k in range(1, 6) for i in range(10)}


def test_the_query_counts_each_kind_wherever_it_stands(spark, tmp_path):
    rng = random.Random(7)
    parts = ["a.b@c.org", "x@y.example.com", "10.0.0.1", "300.1.1.1", "4111 1111 1111 1111", "4111111111111112", "+1 (310) 555-1001", "é 😀", "so"]
    texts = ["two a@b.co and c@d.co", "+44 20 7946 0958 or 1.2.3.4", None, ""]
    texts += [" ".join(rng.choices(parts, k=rng.randrange(1, 12))) for _ in range(60)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:6] for r in QUERIES["op8_pii"](spark, str(tmp_path)).collect()}
    want = {}
    for i, text in enumerate(texts):
        spans = plain(text or "")
        told = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        counts = [sum(k == kind for _, k, _ in spans) for kind in range(4)]
        want[i] = (*counts, hashlib.sha256(told.encode()).hexdigest())
    assert got == want
