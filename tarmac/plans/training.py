"""Training set: flattened flights, clamped delays, calendar fields and the weather nearest in
time at both ends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions import times, weather as wx
from tarmac.operators import shape
from tarmac.operators.filters import with_target
from tarmac.operators.lookup import lookup
from tarmac.operators.nearest import nearest_join
from tarmac.schemas import FEATURE_COLUMNS, TARGET, TIME_COLUMNS, WEATHER_FIELDS

# Delay columns of a flattened flight: name -> (later instant, earlier instant).
DELAYS = {
    "departure_delay_actual": ("departure_actual", "departure_scheduled"),
    "departure_delay_estimated": ("departure_estimated", "departure_scheduled"),
    "arrival_delay_actual": ("arrival_actual", "arrival_scheduled"),
    "arrival_delay_estimated": ("arrival_estimated", "arrival_scheduled"),
    "flight_duration_scheduled": ("arrival_scheduled", "departure_scheduled"),
}


def add_delays(df: DataFrame, missing: str = "null") -> DataFrame:
    """The five clamped durations; a column the frame lacks counts as unknown."""

    def known(name: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast("timestamp")

    return df.withColumns(
        {out: times.clamped_minutes(known(a), known(b), missing) for out, (a, b) in DELAYS.items()}
    )


def add_calendar(df: DataFrame, scheduled: str = "departure_scheduled") -> DataFrame:
    return df.withColumns(times.calendar_fields(F.col(scheduled)))


def reference_column(df: DataFrame, end: str, strict: bool = False) -> Column:
    """The instant weather is looked up for: actual, else estimated, else scheduled.

    ``strict`` takes the first of these columns that exists and does not fall through to the next
    one when its value is missing.
    """
    names = [f"{end}_{kind}" for kind in ("actual", "estimated", "scheduled")]
    existing = [F.col(n) for n in names if n in df.columns]
    return existing[0] if strict else times.reference_time(*existing)


def weather_observations(weather: DataFrame, city_col: str) -> DataFrame:
    """Weather documents reduced to what the join carries: city, instant, id, five fields.

    Documents may be standard, wrapped in ``raw_data`` or a bare ``legacy_text``.
    """
    standard = [c for c in ("weather", "main", "wind", "visibility", "rain") if c in weather.columns]
    packed = wx.weather_struct(
        standard=F.struct(*standard),
        raw_data=F.col("raw_data") if "raw_data" in weather.columns else None,
        legacy_text=F.col("legacy_text") if "legacy_text" in weather.columns else None,
    )
    return weather.select(
        F.col(city_col).alias("obs_city"),
        times.instant_column(weather, "collected_at").alias("obs_time"),
        F.col("_id").alias("obs_id"),
        packed.alias("obs_fields"),
    ).select("obs_city", "obs_time", "obs_id", "obs_fields.*")


def add_weather(
    flights: DataFrame,
    weather: DataFrame,
    dimension: DataFrame,
    *,
    identity: list[str],
    city_col: str = "name",
    strict: bool = False,
    tolerance_hours: int | None = None,
    fields: list[str] | None = None,
    **limits,
) -> DataFrame:
    """``dep_*`` / ``arr_*`` columns from the nearest observation of each end's city.

    Both ends of a flight are points of one join, so weather is read, shuffled and sorted once. The departure's point carries the
    flight's row and the arrival's none; what both find is brought together by the flight's ``identity``, which must be unique.
    """
    names = WEATHER_FIELDS if fields is None else fields
    observations = weather_observations(weather, city_col).withColumn("obs_fields", F.struct(*names))
    ends = {"departure": "dep_", "arrival": "arr_"}
    whole = F.struct(*[F.col(f"`{c}`") for c in flights.columns])
    points = F.array(
        *[
            F.struct(
                F.lit(end).alias("end"), F.col(f"{end}_iata").alias("code"), reference_column(flights, end, strict).alias("ref_time"),
                (whole if end == "departure" else F.lit(None).cast(flights.schema)).alias("flight"),
            )
            for end in ends
        ]
    )
    each = flights.select(F.struct(*identity).alias("of"), F.explode(points).alias("point")).select("of", "point.*")
    located = lookup(each, dimension, "code", "iata", {"city": "ref_city"}).drop("code")
    matched = nearest_join(
        located, observations, left_key="ref_city", left_time="ref_time", key="obs_city", time="obs_time", row_id="obs_id",
        payload={"obs_fields": "found"}, tolerance_hours=tolerance_hours, **limits,
    )
    both = matched.groupBy("of").agg(
        F.first("flight", ignorenulls=True).alias("flight"),
        *[F.first(F.when(F.col("end") == end, F.col("found")), ignorenulls=True).alias(f"{prefix}found") for end, prefix in ends.items()],
    )
    found = [F.col(f"{prefix}found.{name}").alias(f"{prefix}{name}") for prefix in ends.values() for name in names]
    return both.select("flight.*", *found)


def training_rows(
    flights: DataFrame,
    weather: DataFrame,
    dimension: DataFrame,
    *,
    identity: list[str] | None = None,
    city_col: str = "name",
    strict: bool = False,
    **limits,
) -> DataFrame:
    """Flight documents to the 21 model columns plus the target, rows without a target dropped.

    The target filter is applied before the weather joins; they keep every left row exactly once,
    so the result is the same and fewer rows are shuffled.
    """
    if not identity:
        raise ValueError("name the columns that identify a flight")
    wanted = identity + ["airline_name", "departure_iata", "arrival_iata"] + TIME_COLUMNS
    flat = shape.keep_existing(shape.flatten(flights), wanted)
    flat = times.parse_time_columns(flat, TIME_COLUMNS)
    delayed = with_target(add_calendar(add_delays(flat)), TARGET)
    enriched = add_weather(delayed, weather, dimension, identity=identity, city_col=city_col, strict=strict, **limits)
    return enriched.select(*identity, *FEATURE_COLUMNS, TARGET)


def split_train_test(df: DataFrame, key: list[str], train_share: float = 0.75, seed: int = 42) -> DataFrame:
    """Add ``split``: ``train`` or ``test`` by a hash of the row's key.

    The assignment depends on the key alone, not on partitioning or order, so it survives retries
    and re-runs; shares are approximate.
    """
    digest = F.md5(F.concat_ws("|", *key, F.lit(seed)))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 10_000
    return df.withColumn("split", F.when(bucket < int(train_share * 10_000), "train").otherwise("test"))
