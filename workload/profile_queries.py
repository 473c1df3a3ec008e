"""Null profiles, counts, modes, imputation, scores and weather fields."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.functions import text, weather as wx
from tarmac.operators import filters, impute, profile, shape
from workload.registry import query
from workload.tables import FLIGHTS_SQL, WEATHER_SQL, flights, load, weather

_FLAT_COLUMNS = [
    "pos", "flight_date", "flight_status", "airline_name", "flight_codeshared_flight_iata",
    "departure_scheduled", "departure_estimated", "departure_actual", "arrival_estimated", "arrival_actual",
]

# The documents hold empty and unreadable text where the SQL derivation already has a null.
_RAW_SQL = f"""
WITH {FLIGHTS_SQL},
raw AS (SELECT * REPLACE (
    CASE WHEN flight_status = 'scheduled' THEN NULL ELSE 'x' END AS departure_actual,
    CASE WHEN flight_status = 'landed' THEN 'x' END AS arrival_actual) FROM flights)
"""


def _count_sql(column: str, source: str) -> str:
    return f"SELECT '{column}' AS column_name, count(*) - count({source}) AS null_count, count(*) AS total FROM raw"


_NULLS_SQL = " UNION ALL ".join(_count_sql(c, "codeshared" if "codeshared" in c else c) for c in _FLAT_COLUMNS)


def _flat(spark, sf):
    return shape.keep_existing(shape.flatten(flights(spark, sf)), _FLAT_COLUMNS)


@query(f"{_RAW_SQL} {_NULLS_SQL}")
def null_counts(spark, sf):
    return profile.null_counts(_flat(spark, sf))


@query(f"""{_RAW_SQL}, n AS ({_NULLS_SQL})
SELECT column_name, null_count, round_even(null_count / total * 100.0 * 100.0, 0) / 100.0 AS null_percent
FROM n WHERE null_count / total * 100.0 >= 0.005""")
def null_profile(spark, sf):
    return profile.null_summary(_flat(spark, sf))


@query(f"""{_RAW_SQL}, n AS ({_NULLS_SQL})
SELECT string_agg(column_name, ',' ORDER BY column_name) AS kept, count(*) AS columns FROM n
WHERE round_even(null_count / total * 100.0 * 100.0, 0) / 100.0 <= 30.0""")
def drop_sparse_columns(spark, sf):
    kept = profile.drop_sparse(_flat(spark, sf), 30.0)
    names = profile.null_counts(kept).agg(
        F.concat_ws(",", F.sort_array(F.collect_list("column_name"))).alias("kept"), F.count("*").alias("columns")
    )
    return names


@query(f"{_RAW_SQL} SELECT bool_or(arrival_estimated IS NULL) AS any_null FROM raw")
def any_null_left(spark, sf):
    return filters.any_null(_flat(spark, sf).select("pos", "arrival_estimated"))


@query(f"""{_RAW_SQL} SELECT count(*) - count(arrival_estimated) AS missing, count(*) AS total,
  round_even((count(*) - count(arrival_estimated)) / count(*) * 100.0 * 100.0, 0) / 100.0 AS missing_percent FROM raw""")
def missing_share(spark, sf):
    return profile.missing_share(_flat(spark, sf), "arrival_estimated")


_MARKED = "SELECT *, nullif(event_type, 'error') AS kind FROM events"


@query(f"SELECT kind, count(*) AS n FROM ({_MARKED}) WHERE kind IS NOT NULL GROUP BY kind")
def value_counts(spark, sf):
    return profile.value_counts(_marked(spark, sf), "kind")


@query(f"SELECT kind, count(*) AS n FROM ({_MARKED}) GROUP BY kind")
def value_counts_with_null(spark, sf):
    return profile.value_counts(_marked(spark, sf), "kind", nulls=True)


def _marked(spark, sf):
    return load(spark, sf, "events").withColumn("kind", F.nullif("event_type", F.lit("error")))


_BEST = "(SELECT {c} FROM m WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@query(f"""WITH m AS (SELECT *, nullif(value, value) AS blank FROM ({_MARKED})),
t AS (SELECT *, CASE WHEN kind IS NOT NULL THEN props END AS sparse FROM m)
SELECT event_id, coalesce(kind, {_BEST.format(c='kind')}) AS kind, coalesce(sparse, (SELECT sparse FROM t
  WHERE sparse IS NOT NULL GROUP BY sparse ORDER BY count(*) DESC, sparse LIMIT 1)) AS sparse,
  CAST(NULL AS VARCHAR) AS blank FROM t""")
def mode_impute(spark, sf):
    events = _marked(spark, sf).select(
        "event_id",
        "kind",
        F.when(F.col("kind").isNotNull(), F.col("props")).alias("sparse"),
        F.lit(None).cast("string").alias("blank"),
    )
    return impute.fill_with_mode(events, ["kind", "sparse", "blank"])


@query(f"""WITH m AS ({_MARKED})
SELECT 'kind' AS column_name, {_BEST.format(c='kind')} AS mode UNION ALL SELECT 'props', {_BEST.format(c='props')}""")
def column_modes(spark, sf):
    return profile.modes(_marked(spark, sf), ["kind", "props"])


_MANY_SQL = """
WITH e AS (SELECT event_type AS kind, CASE WHEN event_id % 3 = 0 THEN 'often' ELSE 'e' || event_id END AS spread,
  'u' || (event_id % 977) AS level FROM events)
"""


@query(_MANY_SQL + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, (SELECT {c} FROM e GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mode" for c in ("kind", "spread", "level")
))
def modes_of_many_values(spark, sf):
    """One column of few values, one with a value per row but for a frequent one, one in which none stands out."""
    number = F.col("event_id").cast("string")
    rows = load(spark, sf, "events").select(
        F.col("event_type").alias("kind"),
        F.when(F.col("event_id") % 3 == 0, F.lit("often")).otherwise(F.concat(F.lit("e"), number)).alias("spread"),
        F.concat(F.lit("u"), (F.col("event_id") % 977).cast("string")).alias("level"),
    )
    return profile.modes_of_many(rows, ["kind", "spread", "level"], tracked=1000)


@query(f"""WITH m AS (SELECT event_id, CASE WHEN kind IS NOT NULL THEN value END AS value FROM ({_MARKED}))
SELECT event_id, round(coalesce(value, (SELECT avg(value) FROM m)), 6) AS value FROM m""")
def mean_impute(spark, sf):
    events = _marked(spark, sf).select("event_id", F.when(F.col("kind").isNotNull(), F.col("value")).alias("value"))
    return impute.fill_with_mean(events, ["value"]).select("event_id", F.round("value", 6).alias("value"))


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
           "embeddings", "pages", "benchmark", "labels", "conversations"]


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in TABLES))
def inventory_counts(spark, sf):
    return profile.row_counts({t: load(spark, sf, t) for t in TABLES})


@query("SELECT count(*) AS rows, CAST(11 AS INTEGER) AS columns FROM lineitem")
def frame_shape(spark, sf):
    return profile.shape(load(spark, sf, "lineitem"))


@query("""
WITH p AS (SELECT l_returnflag, l_extendedprice AS y, l_quantity * 2000.0 + l_discount * 100.0 AS p FROM lineitem)
SELECT l_returnflag, round(1.0 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)), 6) AS r2, count(*) AS rows
FROM p GROUP BY 1""")
def r2_score(spark, sf):
    rows = load(spark, sf, "lineitem").withColumn("p", F.expr("l_quantity * 2000.0D + l_discount * 100.0D"))
    scored = profile.r2(rows, "l_extendedprice", "p", ["l_returnflag"])
    return scored.withColumn("r2", F.round("r2", 6))


@query("SELECT l_orderkey, l_partkey, l_suppkey, CASE WHEN l_linestatus = 'O' THEN 0.0 WHEN l_extendedprice > 30000 THEN l_extendedprice - 30000 ELSE 0.0 END AS prediction FROM lineitem")
def clamp_prediction(spark, sf):
    raw = F.when(F.col("l_linestatus") == "O", F.lit(float("nan"))).otherwise(F.col("l_extendedprice") - 30000)
    return load(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", text.positive_or_zero(raw).alias("prediction")
    )


# ---- weather fields -----------------------------------------------------------------------


@query("SELECT doc_id, CASE WHEN regexp_matches(lower(text), 'rain|snow|thunderstorm|fog') THEN 1 ELSE 0 END AS weather_bad FROM documents")
def bad_weather_flag(spark, sf):
    return load(spark, sf, "documents").select("doc_id", wx.bad_weather(F.col("text")).alias("weather_bad"))


@query(f"""
WITH {WEATHER_SQL},
forms AS (SELECT *, split_part(id, '-', 2) AS form FROM weather)
SELECT id, CASE WHEN form IN ('3', '4', '5', '6', '7') THEN temperature END AS temperature,
  CASE WHEN form IN ('3', '4', '5', '6', '7') THEN wind_speed END AS wind_speed,
  CASE WHEN form IN ('3', '4', '5', '6', '7') THEN visibility END AS visibility,
  CASE WHEN form IN ('3', '4', '5', '6', '7') THEN precipitation END AS precipitation,
  CASE WHEN form = '1' THEN NULL WHEN form = '2' THEN CASE WHEN condition IS NULL THEN NULL ELSE weather_bad END
       ELSE weather_bad END AS weather_bad FROM forms""")
def polymorphic_weather(spark, sf):
    # Line 1 has no document, line 2 a bare text, line 3 a wrapped document, the others a standard one.
    w = weather(spark, sf)
    form = F.split("_id", "-")[1]
    doc = F.struct("weather", "main", "wind", "visibility", "rain")
    packed = wx.weather_struct(
        standard=F.when(~form.isin("1", "2", "3"), doc),
        raw_data=F.when(form == "3", doc),
        legacy_text=F.when(form == "2", F.get("weather", 0).getField("main")),
    )
    return w.select(F.col("_id").alias("id"), *[c.alias(n) for n, c in wx.weather_columns(packed, "").items()])


@query(f"WITH {WEATHER_SQL} SELECT id, CASE condition WHEN 'Rain' THEN 'light rain' WHEN 'Mist' THEN 'mist' WHEN 'Light Snow' THEN 'light snow' END AS description, precipitation FROM weather")
def first_element_extract(spark, sf):
    doc = F.struct("weather", "rain")
    return weather(spark, sf).select(
        F.col("_id").alias("id"),
        wx.first_condition(doc, "description").alias("description"),
        wx.precipitation(doc).alias("precipitation"),
    )
