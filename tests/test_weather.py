import pytest
from pyspark.sql import functions as F

from tarmac.functions import weather as wx
from tarmac.schemas import RAW_DATA
from tarmac.sources import landing, tables

DOC = "STRUCT<weather: ARRAY<STRUCT<main: STRING, description: STRING>>, main: STRUCT<temp: DOUBLE>, wind: STRUCT<speed: DOUBLE>, visibility: DOUBLE, rain: STRUCT<`1h`: DOUBLE>>"


def doc(main="Rain", rain=None, conditions=True):
    return {
        "weather": [{"main": main, "description": "x"}] if conditions else [],
        "main": {"temp": 5.0}, "wind": {"speed": 2.0}, "visibility": 9000.0, "rain": rain,
    }


def fields(spark, text=None, raw=None, standard=None):
    df = spark.createDataFrame([(text, raw, standard)], f"t string, r STRUCT<{RAW_DATA}>, s {DOC}")
    packed = wx.weather_struct(standard=F.col("s"), raw_data=F.col("r"), legacy_text=F.col("t"))
    return tuple(df.select(*wx.weather_columns(packed, "").values()).first())


@pytest.mark.parametrize(
    "main, flag",
    [("Rain", 1), ("Light SNOW", 1), ("Thunderstorm", 1), ("Fog", 1), ("Drizzle", 0), ("Mist", 0), ("Haze", 0), (None, 0)],
)
def test_bad_weather(spark, main, flag):
    assert fields(spark, standard=doc(main))[4] == flag


def test_forms(spark):
    assert fields(spark) == (None, None, None, None, None)
    assert fields(spark, text="Light Rain") == (None, None, None, None, 1)
    assert fields(spark, text="clear sky", standard=doc()) == (None, None, None, None, 0)
    raw = {"weather": [{"main": "Fog"}], "main": {"temp": 1.0}, "wind": None, "visibility": 10.0, "rain": {"1h": 0.4}}
    assert fields(spark, raw=raw, standard=doc()) == (1.0, None, 10.0, 0.4, 1)
    assert fields(spark, standard=doc()) == (5.0, 2.0, 9000.0, 0.0, 1)


def test_rain_and_empty_conditions(spark):
    assert fields(spark, standard=doc(rain={"1h": 1.5}))[3] == 1.5
    assert fields(spark, standard=doc(rain={"1h": None}))[3] == 0.0
    assert fields(spark, standard=doc(conditions=False))[4] == 0


def test_variants_of_any_form(spark):
    docs = [
        '{"weather":[{"main":"Rain","id":5}],"main":{"temp":3,"feels_like":1},"wind":{"speed":2.5},"visibility":900,"rain":{"1h":0.4},"new":{"x":[1]}}',
        '{"raw_data":{"weather":[],"main":{"temp":-1.5}},"weather":[{"main":"Fog"}]}',
        '{"weather":"light SNOW tonight"}',
        '{"weather":[{"main":"Clear"}],"main":"broken","visibility":"far"}',
        "null",
    ]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, text string").select("id", F.parse_json("text").alias("doc"))
    df = df.unionByName(spark.createDataFrame([(5,)], "id int"), allowMissingColumns=True)
    got = {r.id: r.w and tuple(r.w) for r in df.select("id", wx.weather_of_variant(F.col("doc")).alias("w")).collect()}
    assert got == {
        0: (3.0, 2.5, 900.0, 0.4, 1), 1: (-1.5, None, None, 0.0, 0), 2: (None, None, None, None, 1), 3: (None, None, None, 0.0, 0), 4: None, 5: None,
    }


def test_undeclared_fields_survive_an_upsert(spark, tmp_path):
    (tmp_path / "land").mkdir()
    (tmp_path / "land" / "a.json").write_text('[{"k":"1","new":{"x":[1,2]}},{"k":"2","other":true}]')
    (tmp_path / "land" / "b.json").write_text('{"error":"quota"}')
    table = str(tmp_path / "table")
    for path in ("land", "more"):
        batch = landing.read_variants(spark, str(tmp_path / path)).withColumns(
            {"k": F.try_variant_get("doc", "$.k", "string"), "day": F.lit("d"), "at": F.lit(path)}
        )
        tables.upsert_table(batch, table, "k", ["at"], "day")
        (tmp_path / "more").mkdir(exist_ok=True)
        (tmp_path / "more" / "a.json").write_text('[{"k":"2","later":1}]')
    told = {r.k: r.doc for r in tables.read_table(spark, table).select("k", F.to_json("doc").alias("doc")).collect()}
    assert told == {"1": '{"k":"1","new":{"x":[1,2]}}', "2": '{"k":"2","later":1}'}
