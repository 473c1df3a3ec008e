"""Instants, delays, calendar fields and keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.functions import text, times
from tarmac.operators.lookup import coverage_grid
from tarmac.operators.shape import flatten, keep_existing
from tarmac.plans.schedules import schedule_features
from tarmac.plans.training import add_delays, reference_column
from tarmac.schemas import TIME_COLUMNS
from workload.registry import query
from workload.tables import FLIGHTS_SQL, SCHEDULES_SQL, flights, load, minutes_sql, schedules


@query(f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  {minutes_sql('l_shipdate', 'o_orderdate')} AS delay_minutes,
  {minutes_sql('o_orderdate', 'l_shipdate')} AS lead_minutes
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def delay_minutes_clamped(spark, sf):
    joined = load(spark, sf, "lineitem").join(
        load(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        times.clamped_minutes(F.col("l_shipdate"), F.col("o_orderdate")).alias("delay_minutes"),
        times.clamped_minutes(F.col("o_orderdate"), F.col("l_shipdate")).alias("lead_minutes"),
    )


def flat_flights(spark, sf):
    return times.parse_time_columns(flatten(flights(spark, sf)), TIME_COLUMNS)


_DELAY_PAIRS = {
    "departure_delay_actual": ("departure_actual", "departure_scheduled"),
    "departure_delay_estimated": ("departure_estimated", "departure_scheduled"),
    "arrival_delay_actual": ("arrival_actual", "arrival_scheduled"),
    "arrival_delay_estimated": ("arrival_estimated", "arrival_scheduled"),
    "flight_duration_scheduled": ("arrival_scheduled", "departure_scheduled"),
}


@query(
    f"WITH {FLIGHTS_SQL} SELECT pos, "
    + ", ".join(f"{minutes_sql(a, b)} AS {n}" for n, (a, b) in _DELAY_PAIRS.items())
    + " FROM flights"
)
def delay_columns(spark, sf):
    return add_delays(flat_flights(spark, sf)).select("pos", *_DELAY_PAIRS)


@query(
    f"WITH {FLIGHTS_SQL} SELECT pos, "
    + ", ".join(f"coalesce({minutes_sql(a, b)}, 0.0) AS {n}" for n, (a, b) in _DELAY_PAIRS.items())
    + " FROM flights"
)
def delay_missing_zero(spark, sf):
    return add_delays(flat_flights(spark, sf), missing="zero").select("pos", *_DELAY_PAIRS)


@query("""
SELECT event_id, CAST(hour(ts) AS INTEGER) AS scheduled_hour, CAST(isodow(ts) AS INTEGER) AS day_of_week,
  CAST(month(ts) AS INTEGER) AS month, CASE WHEN isodow(ts) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend
FROM events""")
def calendar_features(spark, sf):
    events = load(spark, sf, "events")
    return events.select("event_id", *[c.alias(n) for n, c in times.calendar_fields(F.col("ts")).items()])


@query("""
WITH e AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN ts END AS ts FROM events)
SELECT event_id, CAST(hour(ts) AS INTEGER) AS scheduled_hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
  CAST(month(ts) AS INTEGER) AS month,
  CASE WHEN ts IS NOT NULL THEN CASE WHEN isodow(ts) IN (6, 7) THEN 1 ELSE 0 END END AS is_weekend
FROM e""")
def calendar_features_zero_based(spark, sf):
    ts = F.when(F.col("event_type") != "error", F.col("ts"))
    fields = times.zero_based_calendar_fields(ts)
    return load(spark, sf, "events").select("event_id", *[c.alias(n) for n, c in fields.items()])


@query(f"""
WITH {FLIGHTS_SQL}
SELECT pos, {", ".join(f"epoch_us({c}) AS {c}" for c in TIME_COLUMNS)} FROM flights""")
def parse_timestamps_lenient(spark, sf):
    flat = keep_existing(flatten(flights(spark, sf)), ["pos", *TIME_COLUMNS, "not_there"])
    parsed = times.parse_time_columns(flat, TIME_COLUMNS)
    return parsed.select("pos", *[F.unix_micros(c).alias(c) for c in TIME_COLUMNS])


@query(f"""
WITH {FLIGHTS_SQL}
SELECT pos, CAST(hour(departure_scheduled) AS INTEGER) AS scheduled_hour,
  CAST(isodow(departure_scheduled) AS INTEGER) AS day_of_week FROM flights""")
def wall_clock_calendar(spark, sf):
    # The same local clock times, written with different offsets and with the Z suffix.
    local = F.substring("departure.scheduled", 1, 19)
    offset = F.element_at(F.array(*[F.lit(o) for o in ("+00:00", "+02:00", "-05:30", "Z")]), (F.col("pos") % 4 + 1).cast("int"))
    written = flights(spark, sf).select("pos", times.wall_clock(F.concat(local, offset)).alias("ts"))
    return written.select("pos", F.hour("ts").alias("scheduled_hour"), times.iso_weekday(F.col("ts")).alias("day_of_week"))


@query(f"""
WITH {FLIGHTS_SQL}
SELECT pos, epoch_us(coalesce(departure_actual, departure_estimated, departure_scheduled)) AS departure_ref,
  epoch_us(coalesce(arrival_actual, arrival_estimated, arrival_scheduled)) AS arrival_ref,
  epoch_us(arrival_actual) AS arrival_ref_strict FROM flights""")
def reference_time_coalesce(spark, sf):
    flat = flat_flights(spark, sf)
    return flat.select(
        "pos",
        F.unix_micros(reference_column(flat, "departure")).alias("departure_ref"),
        F.unix_micros(reference_column(flat, "arrival")).alias("arrival_ref"),
        F.unix_micros(reference_column(flat, "arrival", strict=True)).alias("arrival_ref_strict"),
    )


@query("""
SELECT event_id, CASE WHEN event_type = 'error' THEN 'N/A' ELSE event_type END || '_' || strftime(ts, '%Y-%m-%d') AS day_key,
  user_id || '_' || strftime(ts, '%Y%m%d%H') AS hour_key FROM events""")
def natural_keys(spark, sf):
    code = F.nullif(F.col("event_type"), F.lit("error"))
    return load(spark, sf, "events").select(
        "event_id",
        text.flight_day_key(code, times.day_string(F.col("ts"))).alias("day_key"),
        text.city_hour_key(F.col("user_id").cast("string"), F.col("ts")).alias("hour_key"),
    )


_SCHEDULE_SQL = f"""
WITH {SCHEDULES_SQL}
SELECT pos, airline_iata AS airline_name, dep_iata AS departure_iata, arr_iata AS arrival_iata,
  CAST(hour(dep_time) AS INTEGER) AS scheduled_hour, CAST(isodow(dep_time) - 1 AS INTEGER) AS day_of_week,
  CAST(month(dep_time) AS INTEGER) AS month,
  CASE WHEN dep_time IS NOT NULL THEN CASE WHEN isodow(dep_time) IN (6, 7) THEN 1 ELSE 0 END END AS is_weekend,
  {minutes_sql('dep_actual', 'dep_time')} AS departure_delay_actual,
  {minutes_sql('arr_actual', 'arr_time')} AS arrival_delay_actual,
  {minutes_sql('dep_estimated', 'dep_time')} AS departure_delay_estimated,
  {minutes_sql('arr_estimated', 'arr_time')} AS arrival_delay_estimated,
  duration AS flight_duration_scheduled FROM schedules"""


@query(_SCHEDULE_SQL, name="schedule_features")
def schedule_feature_rows(spark, sf):
    return schedule_features(schedules(spark, sf), ["pos"])


@query("""
WITH grid AS (
  SELECT event_type, CAST(d AS DATE) AS day FROM (SELECT DISTINCT event_type FROM events),
    generate_series(TIMESTAMP '2023-12-30', TIMESTAMP '2024-02-02', INTERVAL 1 DAY) AS t(d)),
c AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL)
SELECT grid.event_type, strftime(grid.day, '%Y-%m-%d') AS day, coalesce(n, 0) AS n
FROM grid LEFT JOIN c ON grid.event_type = c.event_type AND grid.day = c.day""")
def backfill_grid(spark, sf):
    events = load(spark, sf, "events").select("event_type", F.col("ts").alias("day"))
    grid = coverage_grid(events, events, "event_type", "day", "2023-12-30", "2024-02-02")
    return grid.select("event_type", F.date_format("day", "yyyy-MM-dd").alias("day"), "n")
