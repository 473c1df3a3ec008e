"""One-hot codes by a dictionary table."""

import pytest
from pyspark.sql import functions as F

from tarmac.operators import encode
from tests.test_models import encode as by_pipeline

DDL = "id int, c string, n int"


def slots(spark, train, test, **options):
    codes = encode.dictionary(spark.createDataFrame(train, DDL), ["c", "n"], **options)
    coded = encode.one_hot(spark.createDataFrame(test, DDL), codes, ["c", "n"])
    return {r.id: r.slots for r in coded.collect()}


def test_slots_run_through_the_columns(spark):
    train = [(0, "b", 10), (1, "a", 9), (2, None, 10), (3, "b", None)]
    test = [(0, "a", 10), (1, "b", 9), (2, "new", 9), (3, None, None), (4, "a", 77)]
    # Values are text: "10" stands before "9".
    assert slots(spark, train, test) == {0: [0, 2], 1: [1, 3], 2: [3], 3: [], 4: [0]}
    assert slots(spark, train, test, drop_first=True) == {0: [], 1: [0, 1], 2: [1], 3: [], 4: []}
    assert slots(spark, train, test, descending=True) == {0: [1, 3], 1: [0, 2], 2: [2], 3: [], 4: [1]}
    assert slots(spark, [], test) == {i: [] for i in range(5)}


@pytest.mark.parametrize("drop_first", [False, True])
def test_equals_the_pipeline(spark, drop_first):
    train, test = ["b", "a", "c", "b", "d"], ["a", "b", "c", "d", "new"]
    dense = by_pipeline(spark, train, test, drop_first)
    rows = spark.createDataFrame(list(enumerate(test)), "id int, c string")
    codes = encode.dictionary(spark.createDataFrame([(v,) for v in train], "c string"), ["c"], drop_first, descending=drop_first)
    coded = {r.id: r.slots for r in encode.one_hot(rows, codes, ["c"]).collect()}
    assert [coded[i] for i in range(5)] == [[k for k, x in enumerate(v) if x] for v in dense]


def test_many_categories_stay_in_the_tasks(spark, monkeypatch):
    rows = spark.range(300_000).select("id", F.md5(F.col("id").cast("string")).alias("c"), F.lit("odd").alias("value"))

    def refused(self, *args, **kwargs):
        raise AssertionError("rows were fetched")

    with monkeypatch.context() as m:
        for name in ("collect", "toPandas", "take", "head", "first", "toLocalIterator"):
            m.setattr(type(rows), name, refused)
        codes = encode.dictionary(rows, ["c"])
        coded = encode.one_hot(rows, codes, ["c"])
    told = coded.agg(F.count("*").alias("n"), F.countDistinct(F.col("slots")[0]).alias("d"), F.max(F.col("slots")[0]).alias("m")).first()
    assert (told.n, told.d, told.m) == (300_000, 300_000, 299_999)
    assert coded.columns == ["id", "c", "value", "slots"]
