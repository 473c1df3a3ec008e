import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.operators import impute, profile, shape
from tarmac.schemas import FLIGHT


def test_flatten(spark):
    df = spark.createDataFrame(
        [(1, {"a": 1, "b": {"c": "x"}}, [1, 2]), (2, None, None)], "id int, s STRUCT<a: INT, b: STRUCT<c: STRING>>, l ARRAY<INT>"
    )
    flat = shape.flatten(df)
    assert flat.columns == ["id", "s_a", "s_b_c", "l"]
    assert [tuple(r) for r in flat.collect()] == [(1, 1, "x", [1, 2]), (2, None, None, None)]
    assert [r.s_b_present for r in shape.flatten(df, presence_flags=True).collect()] == [True, False]


def test_flatten_whole_flight_document(spark):
    columns = shape.flatten(spark.createDataFrame([], FLIGHT)).columns
    assert {"departure_iata", "flight_codeshared_flight_iata", "live_is_ground", "airline_name"} <= set(columns)
    assert len(columns) == len(set(columns))


def test_column_selection(spark):
    df = spark.createDataFrame([("x", 1, "y", "z")], "b_Date string, a int, actual_runway string, d string")
    assert shape.keep_existing(df, ["d", "nope", "a"]).columns == ["d", "a"]
    assert shape.drop_containing(df, "date", "runway").columns == ["a", "d"]
    assert shape.drop_listed(df, ["a", "nope"], ["d"]).columns == ["b_Date", "actual_runway"]
    assert shape.columns_of(df, T.StringType) == ["b_Date", "actual_runway", "d"]
    features, target = shape.split_target(df, "a")
    assert features.columns == ["b_Date", "actual_runway", "d"] and target.columns == ["a"]


def test_maps(spark, rows):
    df = spark.createDataFrame([({"F1": "x", "F2": None},)], "m map<string,string>")
    assert rows(shape.map_rows(df, "m", "code", "info")) == [("F1", "x"), ("F2", None)]
    codes = spark.createDataFrame([("F1",), ("F1",), ("F2",)], "flight_iata string")
    assert rows(shape.empty_delay_map(codes)) == [("F1", None), ("F2", None)]


@pytest.fixture
def gaps(spark):
    return spark.createDataFrame(
        [("b", 1.0, None), ("a", None, None), (None, 3.0, None), ("a", 5.0, None), ("b", None, "z"), (None, None, None)],
        "c string, x double, total string",
    )


def test_null_profile(gaps, rows):
    assert rows(profile.null_counts(gaps)) == [("c", 2, 6), ("total", 5, 6), ("x", 3, 6)]
    assert [tuple(r) for r in profile.null_summary(gaps).collect()] == [("total", 5, 83.33), ("x", 3, 50.0), ("c", 2, 33.33)]
    assert profile.sparse_columns(gaps, 33.33) == ["total", "x"]
    assert profile.drop_sparse(gaps, 50.0).columns == ["c", "x"]
    assert tuple(profile.missing_share(gaps, "x").first()) == (3, 6, 50.0)
    assert tuple(profile.shape(gaps).first()) == (6, 3)


def test_counts(gaps, rows):
    assert [tuple(r) for r in profile.value_counts(gaps, "c").collect()] == [("a", 2), ("b", 2)]
    assert rows(profile.value_counts(gaps, "c", nulls=True)) == [(None, 2), ("a", 2), ("b", 2)]
    assert rows(profile.row_counts({"g": gaps, "h": gaps.limit(2)})) == [("g", 6), ("h", 2)]


def test_inventory(spark, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS inv")
    spark.sql("DROP TABLE IF EXISTS inv.t")
    spark.sql("CREATE TABLE inv.t USING parquet AS SELECT id FROM range(4)")
    assert ("inv.t", 4) in rows(profile.inventory(spark))


def test_modes_take_the_smallest_on_ties(gaps, rows):
    assert rows(profile.modes(gaps, ["c", "total"])) == [("c", "a"), ("total", "z")]


def test_fill(spark, gaps):
    filled = impute.fill_with_mode(gaps, ["c", "total"]).collect()
    assert [r.c for r in filled].count("a") == 4 and all(r.total == "z" for r in filled)
    assert [r.x for r in impute.fill_with_mean(gaps, ["x"]).collect()] == [1.0, 3.0, 3.0, 5.0, 3.0, 3.0]
    blank = spark.createDataFrame([(None,)], "c string")
    assert impute.fill_with_mode(blank, ["c"]).first()[0] is None


def test_r2(spark):
    df = spark.createDataFrame([("a", 1.0, 1.5), ("a", 2.0, 2.0), ("a", 4.0, 3.0), ("b", 1.0, None)], "g string, y double, p double")
    row = profile.r2(df, "y", "p", ["g"]).first()
    assert row.rows == 3 and row.r2 == pytest.approx(1 - 1.25 / (14 / 3))


def test_distinct(spark, rows):
    a = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(2,), (3,)], "x int").withColumnRenamed("x", "y")
    assert rows(profile.distinct_union({"x": a, "y": b}, "v")) == [(1,), (2,), (3,)]
    nested = a.select(F.struct("x").alias("s"))
    assert rows(profile.distinct_values(nested, "s.x", "v")) == [(1,), (2,)]


def many(spark, kinds):
    return spark.createDataFrame([(k, None) for k in kinds], "c string, empty string")


@pytest.mark.parametrize("tracked", [16, 10_000])
def test_sketched_modes_equal_counted_ones(spark, rows, tracked):
    hot = ["hot"] * 900 + [f"v{i}" for i in range(1500)]
    even = [f"v{i % 700}" for i in range(2100)]
    tied = ["b", "a"] * 50 + ["c"]
    for kinds in (hot, even, tied, ["x"], []):
        df = many(spark, kinds)
        got = rows(profile.modes_of_many(df, ["c", "empty"], tracked=tracked, candidates=8))
        assert got == rows(profile.modes(df, ["c", "empty"]))


def test_a_mode_that_stands_out_is_found_without_counting_all(spark, monkeypatch):
    df = spark.range(50_000).select(F.when(F.col("id") % 4 == 0, "hot").otherwise(F.col("id").cast("string")).alias("c"))
    monkeypatch.setattr(profile, "modes", None)
    assert profile.modes_of_many(df, ["c"]).collect() == [("c", "hot")]


def test_counts_read_no_column(spark, tmp_path):
    spark.range(100).select("id", F.col("id").alias("b")).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    for counted in (profile.row_counts({"t": df}), profile.shape(df)):
        assert counted.first()["rows"] == 100
        assert "ReadSchema: struct<>" in counted._jdf.queryExecution().executedPlan().toString()
