"""Declared schemas, as DDL text. Readers never infer: numbers arrive as a mix of ints and floats,
and keys may be absent altogether, so every field is nullable and typed here."""

from __future__ import annotations

# ---- fixed values: field names and types of the document formats --------------------------

FLIGHT = """
flight_date STRING, flight_status STRING,
departure STRUCT<airport:STRING, timezone:STRING, iata:STRING, icao:STRING, terminal:STRING,
  gate:STRING, delay:INT, scheduled:STRING, estimated:STRING, actual:STRING,
  estimated_runway:STRING, actual_runway:STRING>,
arrival STRUCT<airport:STRING, timezone:STRING, iata:STRING, icao:STRING, terminal:STRING,
  gate:STRING, baggage:STRING, scheduled:STRING, delay:INT, estimated:STRING, actual:STRING,
  estimated_runway:STRING, actual_runway:STRING>,
airline STRUCT<name:STRING, iata:STRING, icao:STRING>,
flight STRUCT<number:STRING, iata:STRING, icao:STRING,
  codeshared:STRUCT<airline_name:STRING, airline_iata:STRING, airline_icao:STRING,
    flight_number:STRING, flight_iata:STRING, flight_icao:STRING>>,
aircraft STRUCT<registration:STRING, iata:STRING, icao:STRING, icao24:STRING>,
live STRUCT<updated:STRING, latitude:DOUBLE, longitude:DOUBLE, altitude:DOUBLE, direction:DOUBLE,
  speed_horizontal:DOUBLE, speed_vertical:DOUBLE, is_ground:BOOLEAN>
"""

WEATHER = """
coord STRUCT<lon:DOUBLE, lat:DOUBLE>,
weather ARRAY<STRUCT<id:INT, main:STRING, description:STRING, icon:STRING>>,
base STRING,
main STRUCT<temp:DOUBLE, feels_like:DOUBLE, temp_min:DOUBLE, temp_max:DOUBLE, pressure:INT,
  humidity:INT, sea_level:INT, grnd_level:INT>,
visibility DOUBLE, wind STRUCT<speed:DOUBLE, deg:INT, gust:DOUBLE>,
rain STRUCT<`1h`:DOUBLE>, clouds STRUCT<`all`:INT>, dt BIGINT,
sys STRUCT<type:INT, id:BIGINT, country:STRING, sunrise:BIGINT, sunset:BIGINT>,
timezone INT, id BIGINT, name STRING, cod INT,
_id STRING, city STRING, role STRING, collected_at STRING
"""

RAW_DATA = """
weather ARRAY<STRUCT<main:STRING>>, main STRUCT<temp:DOUBLE>, wind STRUCT<speed:DOUBLE>,
visibility DOUBLE, rain STRUCT<`1h`:DOUBLE>
"""

SCHEDULE = """
airline_iata STRING, airline_icao STRING, flight_iata STRING, flight_icao STRING,
flight_number STRING,
dep_iata STRING, dep_icao STRING, dep_terminal STRING, dep_gate STRING,
dep_time STRING, dep_time_utc STRING, dep_estimated STRING, dep_estimated_utc STRING,
dep_actual STRING, dep_actual_utc STRING,
arr_iata STRING, arr_icao STRING, arr_terminal STRING, arr_gate STRING, arr_baggage STRING,
arr_time STRING, arr_time_utc STRING, arr_estimated STRING, arr_estimated_utc STRING,
arr_actual STRING, arr_actual_utc STRING,
cs_airline_iata STRING, cs_flight_number STRING, cs_flight_iata STRING,
status STRING, duration INT, delayed INT, dep_delayed INT, arr_delayed INT, aircraft_icao STRING,
arr_time_ts BIGINT, dep_time_ts BIGINT, arr_estimated_ts BIGINT, dep_estimated_ts BIGINT,
arr_actual_ts BIGINT, dep_actual_ts BIGINT
"""

CATEGORICAL_FEATURES = ["airline_name", "departure_iata", "arrival_iata"]
CALENDAR_FEATURES = ["scheduled_hour", "day_of_week", "month", "is_weekend"]
DELAY_FEATURES = [
    "departure_delay_actual",
    "departure_delay_estimated",
    "arrival_delay_estimated",
    "flight_duration_scheduled",
]
WEATHER_FIELDS = ["temperature", "wind_speed", "visibility", "precipitation", "weather_bad"]

TARGET = "arrival_delay_actual"

TIME_COLUMNS = [
    "departure_scheduled",
    "departure_estimated",
    "departure_actual",
    "arrival_scheduled",
    "arrival_estimated",
    "arrival_actual",
]

# ---- derived from the values above --------------------------------------------------------

DEPARTURE_WEATHER = [f"dep_{name}" for name in WEATHER_FIELDS]
ARRIVAL_WEATHER = [f"arr_{name}" for name in WEATHER_FIELDS]
NUMERIC_FEATURES = CALENDAR_FEATURES + DELAY_FEATURES + DEPARTURE_WEATHER + ARRIVAL_WEATHER
FEATURE_COLUMNS = CATEGORICAL_FEATURES + NUMERIC_FEATURES
REQUIRED_FEATURES = CATEGORICAL_FEATURES + CALENDAR_FEATURES + DELAY_FEATURES


def feature_type(name: str) -> str:
    if name in CATEGORICAL_FEATURES:
        return "string"
    if name in CALENDAR_FEATURES or name.endswith("weather_bad"):
        return "int"
    return "double"


FEATURES = ", ".join(f"{name} {feature_type(name)}" for name in FEATURE_COLUMNS)
