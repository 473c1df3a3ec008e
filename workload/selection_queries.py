"""Filters, caps, newest rows and distinct sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.operators import caps, filters, profile, shape
from tarmac.operators.validate import accepted_batch, check_rows
from tarmac.plans.schedules import select_landed, select_live
from workload.join_queries import SERVING_SQL, serving_set
from workload.registry import query
from workload.tables import FLIGHTS_SQL, SCHEDULES_SQL, flights, load, schedules


@query(f"""
WITH {FLIGHTS_SQL}
SELECT pos FROM flights WHERE flight_status = 'landed' AND departure_actual IS NOT NULL
UNION ALL SELECT pos FROM flights WHERE false""")
def landed_complete(spark, sf):
    needed = ["departure.scheduled", "departure.actual", "arrival.scheduled", "arrival.actual"]
    return filters.landed_flights(flights(spark, sf), needed).select("pos")


@query(f"""
WITH {FLIGHTS_SQL},
t AS (SELECT pos, CASE WHEN flight_status = 'scheduled' THEN NULL WHEN airline_name = '5-LOW' THEN ''
                       ELSE 'known' END AS actual FROM flights)
SELECT pos, actual IS NOT NULL AND actual <> '' AS intended, actual IS NULL OR actual <> '' AS literal FROM t""")
def non_empty_filter(spark, sf):
    return flights(spark, sf).select(
        "pos",
        F.coalesce(filters.not_empty("departure.actual"), F.lit(False)).alias("intended"),
        filters.not_empty("departure.actual", nulls="keep").alias("literal"),
    )


@query(f"WITH {FLIGHTS_SQL} SELECT pos, arrival_iata FROM flights WHERE flight_date = '1998-10-03' AND flight_status IN ('active', 'scheduled')")
def same_day_live(spark, sf):
    rows = filters.with_status(filters.on_day(flights(spark, sf), "1998-10-03"), ["active", "scheduled"])
    return rows.select("pos", F.col("arrival.iata").alias("arrival_iata"))


OPERATING_SQL = f"""
WITH {SCHEDULES_SQL},
reg AS (SELECT cs_flight_iata AS code, min(pos) AS first_pos FROM schedules
        WHERE flight_iata IS NOT NULL AND cs_flight_iata IS NOT NULL GROUP BY 1),
operating AS (SELECT s.pos, s.flight_iata, s.status FROM schedules s LEFT JOIN reg ON s.flight_iata = reg.code
  WHERE s.flight_iata IS NOT NULL AND s.cs_flight_iata IS NULL AND (first_pos IS NULL OR first_pos > s.pos))
"""


@query(OPERATING_SQL + "SELECT pos, flight_iata FROM operating")
def codeshare_filter(spark, sf):
    return filters.drop_codeshares(schedules(spark, sf), "pos").select("pos", "flight_iata")


@query(OPERATING_SQL + "SELECT pos, flight_iata, status FROM operating WHERE status = 'landed' OR NOT EXISTS (SELECT 1 FROM operating WHERE status = 'landed')")
def prefer_else_all(spark, sf):
    return select_landed(schedules(spark, sf), "pos").select("pos", "flight_iata", "status")


@query("SELECT event_id FROM events")
def prefer_without_match(spark, sf):
    return filters.prefer(load(spark, sf, "events"), F.col("event_type") == "landed").select("event_id")


@query(OPERATING_SQL + """SELECT pos, flight_iata, status FROM operating
WHERE status = (SELECT CASE WHEN bool_or(status = 'active') THEN 'active' WHEN bool_or(status = 'scheduled') THEN 'scheduled' END FROM operating)""")
def priority_fallback(spark, sf):
    return select_live(schedules(spark, sf), "pos").select("pos", "flight_iata", "status")


@query("SELECT event_id FROM events WHERE event_type = 'purchase'")
def priority_fallback_second(spark, sf):
    events = load(spark, sf, "events")
    return filters.first_available(events, "event_type", ["landed", "purchase", "view"]).select("event_id")


@query(OPERATING_SQL + "SELECT pos, flight_iata FROM operating WHERE status = 'landed' ORDER BY pos LIMIT 10")
def limited_landed(spark, sf):
    return select_landed(schedules(spark, sf), "pos", 10).select("pos", "flight_iata")


# ---- caps and newest rows -----------------------------------------------------------------


@query(f"""
WITH {FLIGHTS_SQL}
SELECT pos, flight_date, departure_iata FROM flights WHERE flight_status = 'landed'
QUALIFY row_number() OVER (PARTITION BY flight_date, departure_iata ORDER BY pos) <= 2""")
def per_group_cap(spark, sf):
    rows = flights(spark, sf).select(
        "pos", "flight_date", "flight_status", F.col("departure.iata").alias("departure_iata")
    )
    landed = filters.with_status(rows, ["landed"])
    return caps.cap_per_group(landed, ["flight_date", "departure_iata"], ["pos"], 2).drop("flight_status")


@query(f"""
WITH {FLIGHTS_SQL},
answered AS (SELECT *, CAST(substr(departure_iata, 2) AS INTEGER) AS airport_rank FROM flights
  QUALIFY row_number() OVER (PARTITION BY departure_iata ORDER BY pos) <= 100),
kept AS (SELECT * FROM answered WHERE flight_status = 'landed' AND arrival_actual IS NOT NULL),
sizes AS (SELECT airport_rank, count(*) AS n FROM kept GROUP BY 1),
opened AS (SELECT airport_rank FROM (SELECT airport_rank, coalesce(sum(n) OVER (ORDER BY airport_rank
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sizes) WHERE before < 50)
SELECT pos, airport_rank FROM kept WHERE airport_rank IN (SELECT airport_rank FROM opened)
ORDER BY airport_rank, pos LIMIT 100""")
def group_opening_cap(spark, sf):
    rows = flights(spark, sf).withColumn("airport_rank", F.substring("departure.iata", 2, 2).cast("int"))
    answered = caps.cap_per_group(rows, ["airport_rank"], ["pos"], 100)
    kept = answered.where(
        (F.col("flight_status") == "landed") & (F.col("arrival.actual") != "") & (F.col("arrival.actual") != "unknown")
    )
    return caps.opening_cap(kept, "airport_rank", ["pos"], 50, 100).select("pos", "airport_rank")


@query(f"""
WITH {FLIGHTS_SQL},
answered AS (SELECT *, CAST(substr(departure_iata, 2) AS INTEGER) AS airport_rank,
    CASE flight_status WHEN 'active' THEN 0 ELSE 1 END AS status_rank FROM flights WHERE flight_status <> 'landed'
  QUALIFY row_number() OVER (PARTITION BY airport_rank, status_rank ORDER BY pos) <= 50)
SELECT pos, airport_rank, status_rank FROM answered WHERE flight_date >= '1998-01-01'
ORDER BY airport_rank, status_rank, pos LIMIT 10""")
def priority_cap(spark, sf):
    rows = filters.with_status(flights(spark, sf), ["active", "scheduled"]).select(
        "pos", "flight_date",
        F.substring("departure.iata", 2, 2).cast("int").alias("airport_rank"),
        F.when(F.col("flight_status") == "active", 0).otherwise(1).alias("status_rank"),
    )
    recent = F.col("flight_date") >= "1998-01-01"
    return caps.priority_cap(rows, ["airport_rank", "status_rank"], ["pos"], recent, 50, 10).drop("flight_date")


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_suppkey LIMIT 10")
def top_rows(spark, sf):
    ties = ["l_orderkey", "l_partkey", "l_suppkey"]
    return caps.top_rows(load(spark, sf, "lineitem"), "l_extendedprice", 10, ties).select(*ties, "l_extendedprice")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def first_rows(spark, sf):
    return caps.first_rows(load(spark, sf, "orders"), ["o_orderkey"], 10).select("o_orderkey", "o_totalprice")


@query("""
SELECT CASE WHEN event_type = 'view' THEN 'N/A' ELSE event_type END AS status, CAST(user_id AS VARCHAR) AS name
FROM events ORDER BY ts DESC, event_id LIMIT 3""")
def latest_rows(spark, sf):
    events = load(spark, sf, "events").withColumn("status", F.nullif("event_type", F.lit("view")))
    return caps.newest(events, "ts", ["event_id"], {"status": "status", "user_id": "name"})


@query("SELECT CAST(row_number() OVER (ORDER BY event_id) AS BIGINT) AS flight_no, round(value, 2) AS estimated_minutes FROM events")
def numbered_predictions(spark, sf):
    return caps.numbered(load(spark, sf, "events"), ["event_id"], "value")


@query("""
SELECT event_type, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) <= 3""")
def newest_per_type(spark, sf):
    events = load(spark, sf, "events").select("event_type", "event_id", "ts")
    return caps.cap_per_group(events, ["event_type"], [F.desc("ts"), "event_id"], 3).drop("ts")


# ---- sets and projections -----------------------------------------------------------------


@query("SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier")
def distinct_union(spark, sf):
    sides = {"c_nationkey": load(spark, sf, "customer"), "s_nationkey": load(spark, sf, "supplier")}
    return profile.distinct_union(sides, "nationkey")


@query(f"WITH {FLIGHTS_SQL} SELECT DISTINCT arrival_iata FROM flights")
def distinct_nested(spark, sf):
    return profile.distinct_values(flights(spark, sf), "arrival.iata", "arrival_iata")


@query(f"WITH {SCHEDULES_SQL} SELECT DISTINCT flight_iata, CAST(NULL AS VARCHAR) AS delay_info FROM schedules")
def delay_map(spark, sf):
    return shape.empty_delay_map(schedules(spark, sf))


@query("SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, CAST(embedding[i] AS DOUBLE) AS value FROM embeddings, generate_series(1, len(embedding)) AS t(i)")
def envelope_unnest(spark, sf):
    from tarmac.sources.landing import unnest

    rows = unnest(load(spark, sf, "embeddings").select("vec_id", "embedding"), "embedding")
    return rows.select("vec_id", "pos", F.col("element").cast("double").alias("value"))


@query("""SELECT event_id, 'k' AS name, CAST(json_extract(props, '$.k') AS BIGINT) AS value FROM events""")
def map_to_rows(spark, sf):
    events = load(spark, sf, "events").select("event_id", F.from_json("props", "map<string,bigint>").alias("m"))
    return events.select("event_id", F.explode("m").alias("name", "value"))


@query(f"""
WITH {FLIGHTS_SQL}
SELECT pos, flight_date, flight_status, departure_iata, arrival_iata, airline_name, airline_iata, flight_iata,
  codeshared AS flight_codeshared_flight_iata, codeshared IS NOT NULL AS flight_codeshared_present FROM flights""")
def flatten_nested(spark, sf):
    flat = shape.flatten(flights(spark, sf), presence_flags=True)
    wanted = [
        "pos", "flight_date", "flight_status", "departure_iata", "arrival_iata", "airline_name", "airline_iata",
        "flight_iata", "flight_codeshared_flight_iata", "flight_codeshared_present", "aircraft_registration",
    ]
    return shape.keep_existing(flat, wanted)


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def drop_by_name(spark, sf):
    orders = shape.drop_containing(load(spark, sf, "orders"), "DATE", "runway")
    return shape.drop_listed(orders, ["o_orderstatus", "not_there"], ["o_orderpriority"], ["o_orderstatus"])


# ---- validation ---------------------------------------------------------------------------

_ROWS_SQL = f"""
WITH served AS ({SERVING_SQL}),
damaged AS (SELECT *, airline_iata = '1' AS no_hour, airline_iata = '2' AS bad_month, airline_iata = '5' AS no_weather FROM served)
"""


def _damaged(spark, sf):
    """Feature rows with a missing required field, a wrong type, and a missing optional field."""
    served = serving_set(spark, sf)
    mark = F.col("airline_iata")
    return served.withColumns(
        {
            "scheduled_hour": F.when(mark != "1", F.col("scheduled_hour")),
            "month": F.when(mark == "2", F.lit("April")).otherwise(F.col("month").cast("string")),
            "dep_temperature": F.when(mark != "5", F.col("dep_temperature")),
        }
    )


@query(_ROWS_SQL + """
SELECT pos, CASE WHEN no_hour THEN 'missing:scheduled_hour' WHEN bad_month THEN 'type:month' ELSE '' END AS reasons,
  CASE WHEN no_hour THEN NULL ELSE scheduled_hour END AS scheduled_hour, CASE WHEN bad_month THEN NULL ELSE month END AS month,
  CASE WHEN no_weather THEN NULL ELSE dep_temperature END AS dep_temperature FROM damaged""")
def validate_rows(spark, sf):
    checked = check_rows(_damaged(spark, sf))
    return checked.select(
        "pos", F.concat_ws(",", "reasons").alias("reasons"), "scheduled_hour", "month", "dep_temperature"
    )


@query(_ROWS_SQL + "SELECT pos FROM damaged WHERE NOT EXISTS (SELECT 1 FROM damaged WHERE no_hour OR bad_month)")
def validate_strict(spark, sf):
    return accepted_batch(_damaged(spark, sf)).select("pos")


@query(f"SELECT pos FROM ({SERVING_SQL})")
def validate_strict_clean(spark, sf):
    return accepted_batch(serving_set(spark, sf)).select("pos")
