"""Line rules and counts on odd texts; the query is compared with SQL elsewhere."""

import random
import time

from pyspark.sql import functions as F

from tarmac.llm import line_quality


def test_repeated_windows_equal_a_plain_count(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randrange(30)))) for i in range(60)]
    out = line_quality.judge(spark.createDataFrame(rows, "doc_id long, text string"))
    for r in out.collect():
        w = r.text.split()
        places = {}
        for i in range(len(w) - 2):
            places.setdefault(tuple(w[i : i + 3]), []).append(i)
        covered = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(3)}
        assert (r.n_words, r.n_repeat_words) == (len(w), len(covered))


def test_rules_line_by_line(spark):
    good = "This is a line of prose that ends as it should."
    bad = ["Home | News | Sport | Contact. ", "Home", "Read more", "a### b$$$ c&&& d%%%.", "BUY!! NOW!! CHEAP!!", "no end here", "All rights reserved."]
    df = spark.createDataFrame([(i, x) for i, x in enumerate([good, *bad])], "doc_id long, line string")
    got = {r.doc_id: r.fails for r in df.select("doc_id", line_quality.line_fails(df.line).alias("fails")).collect()}
    assert got == {0: False, **{i: True for i in range(1, len(bad) + 1)}}


def test_cleaned_text_and_rejection(spark):
    prose = [" ".join(f"w{i}x{j}" for j in range(12)) + "." for i in range(10)]
    few, many = "\n".join([*prose, "Home", "Menu"]), "\n".join(x + " | | |" if i > 3 else x for i, x in enumerate(prose))
    rows = [(1, few, 0, "keep"), (2, many, 0, "reject"), (3, None, 0, "null"), (4, "", 0, "empty"), (1, few, 0, "keep")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, kept string")
    out = line_quality.clean(df, length="n_chars")
    assert out.dtypes == df.dtypes
    text = "\n".join(prose)
    assert [tuple(r) for r in out.collect()] == [(1, text, len(text), "keep")] * 2


def test_nulls_long_texts_and_no_rows(spark):
    long = "word " * 200_000
    out = {r.doc_id: r for r in line_quality.judge(spark.createDataFrame([(1, None), (2, long), (None, " \t\r\n")], "doc_id long, text string")).collect()}
    assert (out[1].n_words, out[1].base_failed, out[1].kept) == (0, True, False)
    assert (out[2].n_words, out[2].n_repeat_words, out[2].kept) == (200_000, 200_000, False)
    assert (out[None].n_words, out[None].n_dup_lines, out[None].word_chars) == (0, 0, 0)
    assert line_quality.judge(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_marks_are_counted_in_about_the_same_time(spark):
    text = "Plain words » of a line | with marks • and é 😀 too <b>. " * 4000
    df = spark.createDataFrame([(text,)] * 24, "text string").repartition(4).localCheckpoint()

    def seconds(marks):
        best = []
        for _ in range(3):
            began = time.time()
            got = {r[0] for r in df.select(line_quality._count(F.col("text"), marks)).collect()}
            best.append(time.time() - began)
            assert got == {sum(c in marks for c in text)}
        return min(best)

    assert seconds(line_quality.SEPARATORS) < 4 * seconds(line_quality.SYMBOLS) + 0.1
