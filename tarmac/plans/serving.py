"""Serving features: live flights joined to the latest weather of both cities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions import times, weather as wx
from tarmac.operators.lookup import lookup
from tarmac.operators.merge import last_rows
from tarmac.plans.training import DELAYS
from tarmac.schemas import FEATURE_COLUMNS, TARGET, WEATHER_FIELDS


def latest_weather(weather: DataFrame, order: list[str], city_col: str = "city") -> DataFrame:
    """The last document per city, reduced to the five fields; documents without a city are ignored."""
    documents = [c for c in ("weather", "main", "wind", "visibility", "rain") if c in weather.columns]
    fields = weather.select(
        F.col(city_col).alias("city"), *order, wx.weather_struct(standard=F.struct(*documents)).alias("fields")
    )
    return last_rows(fields, "city", order, ["fields"]).select("city", "fields.*")


def serving_features(
    flights: DataFrame,
    weather: DataFrame,
    dimension: DataFrame,
    weather_order: list[str],
    identity: list[str] | None = None,
) -> DataFrame:
    """Live flights to 23 columns: two codes and the 21 model columns.

    A flight is kept only if both airports are known and both cities have weather. Missing delays
    are 0.0, and hour and weekday are read from the clock as written.
    """
    snapshot = latest_weather(weather, weather_order)
    out = flight_fields(flights, identity or [])
    for end, prefix in (("departure", "dep_"), ("arrival", "arr_")):
        out = lookup(out, dimension, f"{end}_iata", "iata", {"city": "here"}, "inner")
        fields = {name: f"{prefix}{name}" for name in WEATHER_FIELDS}
        out = lookup(out, snapshot, "here", "city", fields, "inner").drop("here")
    return out.select(*(identity or []), "flight_iata", "airline_iata", *FEATURE_COLUMNS)


def flight_fields(flights: DataFrame, identity: list[str]) -> DataFrame:
    """The features a flight document gives on its own.

    Texts are parsed in a first projection and used in a second one, so each is parsed once.
    """
    ends = {
        f"{end}_{kind}": times.parse_instant(F.col(f"{end}.{kind}"))
        for end in ("departure", "arrival")
        for kind in ("scheduled", "estimated", "actual")
    }
    parsed = flights.select(
        *identity,
        F.coalesce("flight.iata", F.lit("")).alias("flight_iata"),
        F.coalesce("airline.iata", F.lit("")).alias("airline_iata"),
        F.col("airline.name").alias("airline_name"),
        F.col("departure.iata").alias("departure_iata"),
        F.col("arrival.iata").alias("arrival_iata"),
        times.wall_clock(F.col("departure.scheduled")).alias("clock"),
        *[c.alias(n) for n, c in ends.items()],
    )
    kept = [*identity, "flight_iata", "airline_iata", "airline_name", "departure_iata", "arrival_iata"]
    calendar = times.calendar_fields(F.col("clock"))
    minutes = {n: times.clamped_minutes(F.col(a), F.col(b), missing="zero") for n, (a, b) in DELAYS.items() if n != TARGET}
    return parsed.select(*kept, *[c.alias(n) for n, c in (calendar | minutes).items()])
