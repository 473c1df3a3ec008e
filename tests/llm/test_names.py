"""Input columns named like an operator's helper columns come through as they are."""

import pytest

from tarmac.llm import line_quality, mixing, order_minhash, pii

HELPERS = [
    "_hash", "_mix", "_rounds", "_cut", "_copies", "_copy", "_source", "_id", "_raw", "_digest", "_of", "_added", "_text", "_searched",
    "_base", "_mentions", "_clean", "_words", "_lines", "_lost", "_row", "_kind", "_part", "_start", "_bucket", "kept0",
]
TEXT = "Write to ann.lee@example.org or call +44 20 7946 0958 about the long report. "
TEXT += " ".join(f"River{i} carries boat{i} past town{i} in year{i}." for i in range(20))


def rows(spark):
    texts = [TEXT, TEXT, TEXT + "It was read by many.", None, "short"]
    data = [(i, t, f"s{i % 2}", *[f"{h}-{i}" for h in HELPERS]) for i, t in enumerate(texts)]
    return spark.createDataFrame(data, ", ".join(["doc_id long", "text string", "source string", *[f"`{h}` string" for h in HELPERS]]))


OPERATORS = {
    "mix": lambda df: mixing.mix(df),
    "keep_one": lambda df: order_minhash.keep_one(df),
    "find": lambda df: pii.find(df),
    "redact": lambda df: pii.redact(df),
    "judge": lambda df: line_quality.judge(df),
    "clean": lambda df: line_quality.clean(df),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_helper_names_are_free(spark, name):
    plain = rows(spark).select("doc_id", "text", "source")
    out = OPERATORS[name](rows(spark))
    assert set(HELPERS) <= set(out.columns)
    found = out.collect()
    assert found and all(r[h] == f"{h}-{r.doc_id}" for r in found for h in HELPERS)
    rest = [c for c in out.columns if c not in HELPERS]
    assert sorted(map(str, out.select(*rest).collect())) == sorted(map(str, OPERATORS[name](plain).select(*rest).collect()))


def test_named_columns_may_begin_with_an_underscore(spark):
    df = rows(spark).select("doc_id", "text", "source").toDF("_id", "_text", "_source")
    kept = order_minhash.keep_one(df, key="_id", text="_text")
    assert kept.columns == ["_id", "_text", "_source"]
    assert sorted(r["_id"] for r in kept.collect()) == sorted(r.doc_id for r in order_minhash.keep_one(rows(spark)).collect())
    assert pii.redact(df, "_text").where("_text LIKE '%@example%'").count() == 0
    assert mixing.mix(df, "_id", "_text", "_source").columns == df.columns
