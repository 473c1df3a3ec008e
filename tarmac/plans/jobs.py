"""The jobs a user runs: collecting, backfilling, training, predicting and checking tables.

Provider answers are read from a landing zone of envelope files; whatever fetches them writes one
file per request below ``airport=XXX`` (and ``status=...`` or ``flight_date=...``) folders. Day, status and airport are filtered
first, by folder where there is one. A provider's limits are arguments: ``per_request`` counts records of one file, the others rows of the result;
without them nothing is left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions import text, times
from tarmac.operators import caps, filters, lookup, profile
from tarmac.operators.validate import accepted_batch
from tarmac.plans import linear, models
from tarmac.plans.serving import serving_features
from tarmac.plans.training import split_train_test, training_rows
from tarmac.schemas import FLIGHT
from tarmac.sources import landing, tables
from tarmac.sources.dimension import read_dimension

# ---- fixed values: airports and statuses --------------------------------------------------------
HISTORY_AIRPORTS = ["CDG", "ORY", "AMS", "LHR", "MAD", "FRA", "MUC", "BCN", "FCO", "CPH"]
LIVE_AIRPORTS = ["CDG", "ORY", "AMS", "LHR", "JFK"]
LIVE_STATUSES = ["active", "scheduled"]


def _rank(column: str, order: list[str]) -> Column:
    """Position of a value in a short list; null for values the list does not hold."""
    return F.nullif(F.array_position(F.array(*[F.lit(v) for v in order]), F.col(column)), F.lit(0))


def _landed(
    spark: SparkSession, path: str, airports: list[str], per_request: int | None = None, **folders: list[str]
) -> DataFrame:
    records = landing.read_envelope(spark, path, FLIGHT, "data", {"airport": airports, **folders})
    if per_request is not None:
        records = caps.cap_per_group(records, ["source_file"], ["pos"], per_request)
    return records.withColumn("airport_rank", _rank("airport", airports))


def _keyed(flights: DataFrame, at: Column | None) -> DataFrame:
    keyed = flights.withColumn("_id", text.flight_day_key(F.col("flight.iata"), F.col("flight_date")))
    return tables.stamp(keyed, at)


def collect_history(
    spark: SparkSession, landing_path: str, table: str, day: str, airports: list[str] | None = None, at=None,
    per_request: int | None = None, open_below: int | None = None, total: int | None = None,
) -> DataFrame:
    """Upsert the day's finished flights; returns row counts per action.

    With ``open_below`` an airport is left out once so many rows came from those before it.
    """
    records = _landed(spark, landing_path, airports or HISTORY_AIRPORTS, per_request, flight_date=[day])
    finished = filters.landed_flights(filters.on_day(records, day), ["arrival.actual"])
    taken = caps.opening_cap(finished, "airport_rank", ["source_file", "pos"], open_below, total)
    batch = _keyed(taken.drop("source_file", "airport"), at)
    ordered = batch.withColumnRenamed("pos", "batch_pos")
    return tables.upsert_table(ordered, table, "_id", ["airport_rank", "batch_pos"], "flight_date")


def collect_weather(spark: SparkSession, landing_path: str, table: str, role: str | None = None, at=None) -> DataFrame:
    """Upsert weather documents, one row per city and hour, the last write winning.

    Writes are ordered by their instant, whatever offset it is written with; a document without a
    readable instant is stamped with the time of the run.
    """
    documents = landing.read_weather(spark, landing_path)
    now = F.current_timestamp() if at is None else at
    instant = F.coalesce(times.instant_column(documents, "collected_at"), now)
    named = F.coalesce("city", "name")
    batch = documents.withColumns(
        {"_id": text.city_hour_key(named, instant), "day": times.day_string(instant), "collected_instant": instant}
        | ({"role": F.lit(role)} if role else {})
    )
    return tables.upsert_table(batch, table, "_id", ["collected_instant"], "day")


def weather_of(weather: DataFrame, cities: DataFrame, city: str = "city") -> DataFrame:
    """Weather documents of the given cities, as :func:`arrival_cities` returns them."""
    return weather.join(cities.select(F.col(city).alias("wanted")), F.coalesce("city", "name") == F.col("wanted"), "left_semi")


def arrival_cities(flights: DataFrame, dimension: DataFrame, day: str) -> tuple[DataFrame, DataFrame]:
    """(cities that flights of the day arrive in, arrival codes the dimension lacks with counts)."""
    codes = filters.on_day(flights, day).select(F.col("arrival.iata").alias("code")).where(text.present(F.col("code")))
    return lookup.cities_of(codes, dimension, ["code"], "iata", "city"), lookup.unknown_codes(codes, dimension, "code", "iata")


def backfill(
    spark: SparkSession, landing_path: str, table: str, airports: list[str] | None = None, at=None,
    per_request: int | None = None, per_day: int | None = None,
) -> DataFrame:
    """Insert the (first ``per_day``) finished flights of every (day, airport) that the table does not hold."""
    records = _landed(spark, landing_path, airports or LIVE_AIRPORTS, per_request)
    taken = filters.landed_flights(records, ["arrival.actual"])
    if per_day is not None:
        taken = caps.cap_per_group(taken, ["flight_date", "airport_rank"], ["source_file", "pos"], per_day)
    batch = _keyed(taken.drop("source_file", "airport"), at).withColumnRenamed("pos", "batch_pos")
    return tables.insert_if_absent(batch, table, "_id", ["airport_rank", "batch_pos"], "flight_date")


def live_flights(
    spark: SparkSession, landing_path: str, day: str, airports: list[str] | None = None,
    per_request: int | None = None, total: int | None = None,
) -> DataFrame:
    """The active or scheduled flights of the day; with ``total`` the first ones in airport and status order."""
    folders = {"flight_date": [day], "status": LIVE_STATUSES}
    records = _landed(spark, landing_path, airports or LIVE_AIRPORTS, per_request, **folders)
    records = records.withColumn("status_rank", _rank("status", LIVE_STATUSES)).where("status_rank is not null")
    keep = (F.col("flight_date") == day) & F.col("flight_status").isin(LIVE_STATUSES)
    return caps.priority_cap(records, ["airport_rank", "status_rank"], ["source_file", "pos"], keep, total=total)


def train(
    spark: SparkSession, flights: DataFrame, weather: DataFrame, dimension: DataFrame, model_path: str,
    key: list[str] | None = None, **options,
) -> DataFrame:
    """Build the training set, fit and save the production model; returns R2 and rows per split.

    One pass over the set sums what the fit and the scores need, so the set is not stored.
    """
    key = key or ["_id"]
    rows = split_train_test(training_rows(flights, weather, dimension, identity=key, **options), key)
    model, scores = models.fit_production(rows)
    model.save(spark, model_path)
    return scores


def predict(
    spark: SparkSession, flights: DataFrame, weather: DataFrame, dimension: DataFrame, model_path: str,
    weather_order: list[str], ordering: list[str],
) -> DataFrame:
    """Serving features, validation and clamped predictions, numbered in input order. One invalid
    row rejects the batch."""
    features = serving_features(flights, weather, dimension, weather_order, ordering)
    scored = models.score(linear.load(spark, model_path), accepted_batch(features))
    return caps.numbered(scored, ordering, "prediction")


def check_tables(frames: dict[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    return profile.row_counts(frames)


def newest_rows(frames: dict[str, tuple[DataFrame, dict[str, str]]], time: str = "collected_at") -> DataFrame:
    """The three newest rows of each table as (table_name, label, detail)."""
    parts = [
        caps.newest(df, time, ["_id"], show).toDF("label", "detail").select(F.lit(name).alias("table_name"), "label", "detail")
        for name, (df, show) in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def load_inputs(spark: SparkSession, flights: str, weather: str, dimension: str) -> tuple[DataFrame, ...]:
    """Stored flights and weather tables plus the code dimension."""
    return tables.read_table(spark, flights), tables.read_table(spark, weather), read_dimension(spark, dimension)


