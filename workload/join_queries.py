"""Lookups, nearest-in-time joins, snapshot joins and the feature jobs built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.functions import times
from tarmac.operators import lookup as lk
from tarmac.operators.merge import last_rows
from tarmac.operators.nearest import nearest_join
from tarmac.plans.serving import serving_features
from tarmac.plans.training import training_rows, weather_observations
from tarmac.schemas import FEATURE_COLUMNS, TARGET, WEATHER_FIELDS
from tarmac.sources.dimension import inline_dimension, last_wins
from workload.registry import query
from workload.tables import (
    CODES_SQL,
    FLIGHTS_SQL,
    WEATHER_SQL,
    code_entries,
    flights,
    load,
    minutes_sql,
    weather,
)


# ---- lookups ------------------------------------------------------------------------------


@query(f"""
WITH {FLIGHTS_SQL}, {CODES_SQL}
SELECT pos, d.city AS departure_city, a.city AS arrival_city FROM flights
LEFT JOIN codes d ON departure_iata = d.iata LEFT JOIN codes a ON arrival_iata = a.iata""")
def dimension_last_wins(spark, sf):
    codes = last_wins(code_entries(spark, sf))
    f = flights(spark, sf).select("pos", F.col("departure.iata").alias("dep"), F.col("arrival.iata").alias("arr"))
    f = lk.lookup(f, codes, "dep", "iata", {"city": "departure_city"})
    return lk.lookup(f, codes, "arr", "iata", {"city": "arrival_city"}).drop("dep", "arr")


@query(f"""
WITH {FLIGHTS_SQL}
SELECT pos, CASE departure_iata WHEN 'A0' THEN 'ALGERIA' WHEN 'A7' THEN 'GERMANY' WHEN 'A12' THEN 'JAPAN' END AS city
FROM flights""")
def inline_mapping(spark, sf):
    mapping = {"A0": "ALGERIA", "A7": "GERMANY", "A12": "JAPAN"}
    f = flights(spark, sf).select("pos", F.col("departure.iata").alias("dep"))
    return lk.lookup(f, F.broadcast(inline_dimension(spark, mapping)), "dep", "iata", {"city": "city"}).drop("dep")


@query(f"""
WITH {FLIGHTS_SQL}, {CODES_SQL}
SELECT arrival_iata, count(*) AS rows FROM flights
WHERE NOT EXISTS (SELECT 1 FROM codes WHERE iata = arrival_iata) GROUP BY 1""")
def unknown_codes(spark, sf):
    f = flights(spark, sf).select(F.col("arrival.iata").alias("arrival_iata"))
    return lk.unknown_codes(f, last_wins(code_entries(spark, sf)), "arrival_iata", "iata")


@query(f"""
WITH {FLIGHTS_SQL}, {CODES_SQL}
SELECT pos, departure_iata FROM flights WHERE departure_iata IN (SELECT iata FROM codes)""")
def known_codes(spark, sf):
    f = flights(spark, sf).select("pos", F.col("departure.iata").alias("departure_iata"))
    return lk.known(f, last_wins(code_entries(spark, sf)), "departure_iata", "iata")


@query(f"""
WITH {FLIGHTS_SQL}, {CODES_SQL}
SELECT DISTINCT city FROM codes
WHERE iata IN (SELECT departure_iata FROM flights UNION SELECT arrival_iata FROM flights)""")
def cities_to_collect(spark, sf):
    f = flights(spark, sf).select(F.col("departure.iata").alias("dep"), F.col("arrival.iata").alias("arr"))
    return lk.cities_of(f, last_wins(code_entries(spark, sf)), ["dep", "arr"], "iata", "city")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, c_mktsegment, o_orderpriority FROM lineitem
LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey""")
def large_dimension_lookup(spark, sf):
    # The same lookup operator with a dimension that grows with the data: measured, then hinted
    # or left to a shuffle join.
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = load(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    li = lk.lookup(li, o, "l_orderkey", "o_orderkey", {"o_custkey": "custkey", "o_orderpriority": "o_orderpriority"})
    return lk.lookup(li, c, "custkey", "c_custkey", {"c_mktsegment": "c_mktsegment"}).drop("custkey")


# ---- nearest in time ----------------------------------------------------------------------


def nearest_sql(tolerance_hours: int | None) -> str:
    """Nearest view per error event of the same user: two as-of joins over distinct instants."""
    bound = "" if tolerance_hours is None else f" AND distance <= {tolerance_hours} * 3600000000"
    return f"""
WITH obs AS (SELECT user_id, ts, min(event_id) AS id, arg_min(value, event_id) AS value
             FROM events WHERE event_type = 'view' GROUP BY ALL),
l AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'error'),
b AS (SELECT l.*, o.ts AS b_ts, o.id AS b_id, o.value AS b_value FROM l ASOF LEFT JOIN obs o
      ON l.user_id = o.user_id AND l.ts >= o.ts),
n AS (SELECT b.*, o.ts AS f_ts, o.id AS f_id, o.value AS f_value FROM b ASOF LEFT JOIN obs o
      ON b.user_id = o.user_id AND b.ts <= o.ts),
p AS (SELECT *, b_ts IS NOT NULL AND (f_ts IS NULL OR epoch_us(ts) - epoch_us(b_ts) <= epoch_us(f_ts) - epoch_us(ts)) AS back FROM n),
q AS (SELECT event_id, CASE WHEN back THEN b_id ELSE f_id END AS view_id, CASE WHEN back THEN b_value ELSE f_value END AS view_value,
  abs(epoch_us(ts) - epoch_us(CASE WHEN back THEN b_ts ELSE f_ts END)) AS distance FROM p)
SELECT event_id, CASE WHEN true{bound} THEN view_id END AS view_id, CASE WHEN true{bound} THEN view_value END AS view_value,
  CASE WHEN true{bound} THEN distance END AS distance FROM q"""


def _nearest(spark, sf, **options):
    events = load(spark, sf, "events")
    matched = nearest_join(
        events.where("event_type = 'error'").select("event_id", "user_id", "ts"),
        events.where("event_type = 'view'"),
        left_key="user_id", left_time="ts", key="user_id", time="ts", row_id="event_id",
        payload={"event_id": "view_id", "value": "view_value"}, matched_time="view_ts", **options,
    )
    distance = times.time_distance(F.col("ts"), F.col("view_ts"))
    return matched.select("event_id", "view_id", "view_value", distance.alias("distance"))


@query(nearest_sql(None), name="nearest_join")
def nearest_view(spark, sf):
    return _nearest(spark, sf)


@query(nearest_sql(6))
def nearest_join_6h(spark, sf):
    return _nearest(spark, sf, tolerance_hours=6)


@query(
    """
WITH obs AS (SELECT 1 AS k, ts, min(event_id) AS id FROM events WHERE event_type = 'view' GROUP BY ALL),
l AS (SELECT 1 AS k, event_id, ts FROM events WHERE event_type = 'error'),
b AS (SELECT l.*, o.ts AS b_ts, o.id AS b_id FROM l ASOF LEFT JOIN obs o ON l.k = o.k AND l.ts >= o.ts),
n AS (SELECT b.*, o.ts AS f_ts, o.id AS f_id FROM b ASOF LEFT JOIN obs o ON b.k = o.k AND b.ts <= o.ts)
SELECT event_id, CASE WHEN b_ts IS NOT NULL AND (f_ts IS NULL OR ts - b_ts <= f_ts - ts) THEN b_id ELSE f_id END AS view_id
FROM n"""
)
def nearest_join_hot_key(spark, sf):
    # One key holds every row; its buckets of time are what the tasks get.
    events = load(spark, sf, "events").withColumn("everywhere", F.lit("all"))
    return nearest_join(
        events.where("event_type = 'error'").select("event_id", "everywhere", "ts"),
        events.where("event_type = 'view'"),
        left_key="everywhere", left_time="ts", key="everywhere", time="ts", row_id="event_id",
        payload={"event_id": "view_id"}, bucket_hours=12,
    ).select("event_id", "view_id")


_MATCH_SQL = f"""
WITH {FLIGHTS_SQL}, {WEATHER_SQL}, {CODES_SQL},
obs AS (SELECT name, collected_at AS ts, min(id) AS id, arg_min(condition, id) AS condition FROM weather GROUP BY ALL),
l AS (SELECT pos, city, coalesce(departure_actual, departure_estimated, departure_scheduled) AS ts
      FROM flights LEFT JOIN codes ON departure_iata = iata),
b AS (SELECT l.*, o.ts AS b_ts, o.id AS b_id FROM l ASOF LEFT JOIN obs o ON l.city = o.name AND l.ts >= o.ts),
n AS (SELECT b.*, o.ts AS f_ts, o.id AS f_id FROM b ASOF LEFT JOIN obs o ON b.city = o.name AND b.ts <= o.ts),
p AS (SELECT *, b_ts IS NOT NULL AND (f_ts IS NULL OR ts - b_ts <= f_ts - ts) AS back FROM n),
q AS (SELECT pos, ts, CASE WHEN back THEN b_ts ELSE f_ts END AS m_ts, CASE WHEN back THEN b_id ELSE f_id END AS m_id FROM p)
SELECT pos, CASE WHEN abs(epoch_us(ts) - epoch_us(m_ts)) <= 21600000000 THEN m_id END AS departure_weather_id,
  CASE WHEN abs(epoch_us(ts) - epoch_us(m_ts)) <= 21600000000 THEN epoch_us(m_ts) END AS departure_weather_at FROM q"""


@query(_MATCH_SQL)
def departure_weather_6h(spark, sf):
    codes = last_wins(code_entries(spark, sf))
    f = flights(spark, sf)
    instants = [times.parse_instant(F.col(f"departure.{k}")) for k in ("actual", "estimated", "scheduled")]
    left = f.select("pos", F.col("departure.iata").alias("dep"), times.reference_time(*instants).alias("ref"))
    left = lk.lookup(left, codes, "dep", "iata", {"city": "city"})
    observations = weather_observations(weather(spark, sf), "name")
    matched = nearest_join(
        left, observations, left_key="city", left_time="ref", key="obs_city", time="obs_time", row_id="obs_id",
        payload={"obs_id": "departure_weather_id"}, matched_time="at", tolerance_hours=6,
    )
    return matched.select("pos", "departure_weather_id", F.unix_micros("at").alias("departure_weather_at"))


# ---- snapshots and feature jobs -----------------------------------------------------------


@query("""
WITH latest AS (SELECT user_id, arg_max(value, event_id) AS last_value, arg_max(event_type, event_id) AS last_type
                FROM events WHERE event_type <> 'signup' GROUP BY user_id)
SELECT e.event_id, e.user_id, last_value, last_type FROM events e JOIN latest l ON e.user_id = l.user_id
WHERE e.event_type = 'signup'""")
def latest_snapshot_join(spark, sf):
    events = load(spark, sf, "events")
    snapshot = last_rows(events.where("event_type <> 'signup'"), "user_id", ["event_id"], ["value", "event_type"])
    signups = events.where("event_type = 'signup'").select("event_id", "user_id")
    return lk.lookup(
        signups, snapshot, "user_id", "user_id", {"value": "last_value", "event_type": "last_type"}, "inner"
    )


def _end_sql(step: str, source: str, end: str, prefix: str) -> str:
    """CTEs that add the five weather fields nearest in time to one end of each flight."""
    fields = ", ".join(f"m.{c} AS {prefix}{c}" for c in WEATHER_FIELDS)
    return f"""
{step}_l AS (SELECT f.*, c.city AS ref_city, coalesce({end}_actual, {end}_estimated, {end}_scheduled) AS ref_time
             FROM {source} f LEFT JOIN codes c ON {end}_iata = c.iata),
{step}_b AS (SELECT l.*, o.ts AS b_ts, o.id AS b_id FROM {step}_l l ASOF LEFT JOIN obs o ON l.ref_city = o.name AND l.ref_time >= o.ts),
{step}_n AS (SELECT b.*, o.ts AS f_ts, o.id AS f_id FROM {step}_b b ASOF LEFT JOIN obs o ON b.ref_city = o.name AND b.ref_time <= o.ts),
{step}_p AS (SELECT *, CASE WHEN b_ts IS NOT NULL AND (f_ts IS NULL OR ref_time - b_ts <= f_ts - ref_time)
               THEN b_id ELSE f_id END AS match_id FROM {step}_n),
{step} AS (SELECT p.* EXCLUDE (ref_city, ref_time, b_ts, b_id, f_ts, f_id, match_id), {fields}
           FROM {step}_p p LEFT JOIN weather m ON p.match_id = m.id)"""


_CALENDAR_SQL = """CAST(hour(departure_scheduled) AS INTEGER) AS scheduled_hour,
  CAST(isodow(departure_scheduled) AS INTEGER) AS day_of_week, CAST(month(departure_scheduled) AS INTEGER) AS month,
  CASE WHEN isodow(departure_scheduled) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend"""

_WEATHER_OUT = ", ".join(f"{p}{c}" for p in ("dep_", "arr_") for c in WEATHER_FIELDS)

TRAINING_SQL = f"""
WITH {FLIGHTS_SQL}, {WEATHER_SQL}, {CODES_SQL},
obs AS (SELECT name, collected_at AS ts, min(id) AS id FROM weather GROUP BY ALL),
landed AS (SELECT * FROM flights WHERE arrival_actual IS NOT NULL),
{_end_sql('d', 'landed', 'departure', 'dep_')},
{_end_sql('a', 'd', 'arrival', 'arr_')}
SELECT pos, airline_name, departure_iata, arrival_iata, {_CALENDAR_SQL},
  {minutes_sql('departure_actual', 'departure_scheduled')} AS departure_delay_actual,
  {minutes_sql('departure_estimated', 'departure_scheduled')} AS departure_delay_estimated,
  {minutes_sql('arrival_estimated', 'arrival_scheduled')} AS arrival_delay_estimated,
  {minutes_sql('arrival_scheduled', 'departure_scheduled')} AS flight_duration_scheduled,
  {minutes_sql('arrival_actual', 'arrival_scheduled')} AS arrival_delay_actual,
  {_WEATHER_OUT} FROM a"""


def training_set(spark, sf, **limits):
    codes = last_wins(code_entries(spark, sf))
    return training_rows(flights(spark, sf), weather(spark, sf), codes, identity=["pos"], **limits)


@query(TRAINING_SQL)
def training_features(spark, sf):
    return training_set(spark, sf).select("pos", *FEATURE_COLUMNS, TARGET)


SERVING_SQL = f"""
WITH {FLIGHTS_SQL}, {WEATHER_SQL}, {CODES_SQL},
latest AS (SELECT city AS at_city, arg_max(id, (collected_at, id)) AS last_id FROM weather WHERE city IS NOT NULL GROUP BY city),
snap AS (SELECT at_city, {", ".join(WEATHER_FIELDS)} FROM latest JOIN weather ON last_id = id)
SELECT pos, flight_iata, airline_iata, airline_name, departure_iata, arrival_iata, {_CALENDAR_SQL},
  coalesce({minutes_sql('departure_actual', 'departure_scheduled')}, 0.0) AS departure_delay_actual,
  coalesce({minutes_sql('departure_estimated', 'departure_scheduled')}, 0.0) AS departure_delay_estimated,
  coalesce({minutes_sql('arrival_estimated', 'arrival_scheduled')}, 0.0) AS arrival_delay_estimated,
  coalesce({minutes_sql('arrival_scheduled', 'departure_scheduled')}, 0.0) AS flight_duration_scheduled,
  {", ".join(f"{s}.{c} AS {p}{c}" for s, p in (("ds", "dep_"), ("sa", "arr_")) for c in WEATHER_FIELDS)}
FROM flights JOIN codes dc ON departure_iata = dc.iata JOIN codes ac ON arrival_iata = ac.iata
JOIN snap ds ON dc.city = ds.at_city JOIN snap sa ON ac.city = sa.at_city
WHERE flight_status IN ('active', 'scheduled')"""


def serving_set(spark, sf):
    live = flights(spark, sf).where(F.col("flight_status").isin("active", "scheduled"))
    codes = last_wins(code_entries(spark, sf))
    return serving_features(live, weather(spark, sf), codes, ["collected_at", "_id"], ["pos"])


@query(SERVING_SQL, name="serving_features")
def serving_feature_rows(spark, sf):
    return serving_set(spark, sf)
