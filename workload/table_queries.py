"""Keyed writes, copies, exports and snapshots: each writes below the shared folder and reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.functions import text
from tarmac.operators.merge import absent_rows, merge_rows
from tarmac.plans.schedules import run_schedules, select_landed
from tarmac.schemas import FLIGHT
from tarmac.session import scratch_path
from tarmac.sources import landing, tables
from workload.registry import query
from workload.tables import FLIGHTS_SQL, SCHEDULES_SQL, flights, load, schedules

# Target: the earlier half of the month of events; batch: the later half. Key: user, event type
# and size class of the value, so keys occur on either side or on both, some with many versions.
_SPLIT = "2024-01-16"


def _halves(spark, sf):
    events = load(spark, sf, "events").select(
        F.concat_ws("_", "user_id", "event_type", F.floor(F.col("value") / 10)).alias("_id"),
        "event_type",
        F.when(F.col("value") > 20, F.col("value")).alias("value"),
        F.when(F.col("value") <= 60, F.col("props")).alias("props"),
        F.col("event_id").alias("last_event"),
        "ts",
    )
    split = F.lit(_SPLIT).cast("timestamp_ntz")
    return events.where(F.col("ts") < split).drop("ts"), events.where(F.col("ts") >= split).drop("ts")


_HALVES_SQL = f"""
WITH e AS (SELECT user_id || '_' || event_type || '_' || CAST(floor(value / 10) AS BIGINT) AS _id, event_type, CASE WHEN value > 20 THEN value END AS value,
  CASE WHEN value <= 60 THEN props END AS props, event_id AS last_event, ts FROM events),
old AS (SELECT * FROM e WHERE ts < TIMESTAMP '{_SPLIT}'), new AS (SELECT * FROM e WHERE ts >= TIMESTAMP '{_SPLIT}'),
stored AS (SELECT _id, arg_min(event_type, last_event) AS event_type, arg_min(CASE WHEN value IS NULL THEN -1 ELSE value END, last_event) AS value,
  arg_min(coalesce(props, ''), last_event) AS props, min(last_event) AS last_event FROM old GROUP BY _id),
target AS (SELECT _id, event_type, nullif(value, -1) AS value, nullif(props, '') AS props, last_event FROM stored),
b AS (SELECT _id, arg_max(event_type, last_event) AS event_type, arg_max(value, last_event) FILTER (value IS NOT NULL) AS value,
  arg_max(props, last_event) FILTER (props IS NOT NULL) AS props, max(last_event) AS last_event FROM new GROUP BY _id),
merged AS (SELECT coalesce(b._id, t._id) AS _id, coalesce(b.event_type, t.event_type) AS event_type, coalesce(b.value, t.value) AS value,
  coalesce(b.props, t.props) AS props, coalesce(b.last_event, t.last_event) AS last_event,
  CASE WHEN t._id IS NULL THEN 'inserted' WHEN b._id IS NULL THEN 'kept' ELSE 'updated' END AS merge_action
  FROM target t FULL JOIN b ON t._id = b._id)
"""


def _target(old):
    return absent_rows(None, old, "_id", ["last_event"])


@query(_HALVES_SQL + "SELECT * FROM merged")
def upsert_last_wins(spark, sf):
    old, new = _halves(spark, sf)
    return merge_rows(_target(old), new, "_id", ["last_event"])


@query(_HALVES_SQL + "SELECT _id, event_type, value, props, last_event FROM merged")
def upsert_table_written(spark, sf):
    old, new = _halves(spark, sf)
    path = scratch_path(spark, "upsert")
    tables.insert_if_absent(old, path, "_id", ["last_event"], "event_type")
    tables.upsert_table(new, path, "_id", ["last_event"], "event_type")
    return tables.read_table(spark, path)


@query(_HALVES_SQL + "SELECT merge_action, count(*) AS rows FROM merged GROUP BY 1")
def upsert_counts(spark, sf):
    old, new = _halves(spark, sf)
    path = scratch_path(spark, "upsert")
    tables.insert_if_absent(old, path, "_id", ["last_event"], "event_type")
    return tables.upsert_table(new, path, "_id", ["last_event"], "event_type")


_FRESH_SQL = _HALVES_SQL + """, fresh AS (SELECT * FROM new WHERE _id NOT IN (SELECT _id FROM target)
  QUALIFY row_number() OVER (PARTITION BY _id ORDER BY last_event) = 1)
"""


@query(_FRESH_SQL + "SELECT _id, event_type, value, props, last_event FROM fresh")
def insert_if_absent(spark, sf):
    old, new = _halves(spark, sf)
    return absent_rows(_target(old), new, "_id", ["last_event"])


@query(_FRESH_SQL + """SELECT (SELECT count(*) FROM fresh) AS saved, (SELECT count(*) FROM new) - (SELECT count(*) FROM fresh) AS skipped""")
def insert_counts(spark, sf):
    old, new = _halves(spark, sf)
    path = scratch_path(spark, "insert")
    tables.insert_if_absent(old, path, "_id", ["last_event"], "event_type")
    return tables.insert_if_absent(new, path, "_id", ["last_event"], "event_type")


@query("""
WITH e AS (SELECT user_id % 25 AS city, strftime(ts, '%Y%m%d%H') AS h, * FROM events)
SELECT CAST(city AS VARCHAR) || '_' || h AS _id, max(event_id) AS event_id, arg_max(value, event_id) AS value,
  arg_max(event_type, event_id) FILTER (event_type <> 'error') AS departure_role,
  arg_max(event_type, event_id) FILTER (event_type = 'error') AS arrival_role FROM e GROUP BY 1""")
def city_hour_upsert(spark, sf):
    # Two writers fill different columns; a merged row keeps what each of them set last.
    events = load(spark, sf, "events")
    is_error = F.col("event_type") == "error"
    rows = events.select(
        text.city_hour_key((F.col("user_id") % 25).cast("string"), F.col("ts")).alias("_id"),
        "event_id", "value",
        F.when(~is_error, F.col("event_type")).alias("departure_role"),
        F.when(is_error, F.col("event_type")).alias("arrival_role"),
    )
    return merge_rows(None, rows, "_id", ["event_id"]).drop("merge_action")


# ---- copies and snapshots -----------------------------------------------------------------


@query("SELECT event_id, value, 2 AS copies FROM events WHERE event_type = 'purchase'")
def copy_filtered(spark, sf):
    source = load(spark, sf, "events").where("event_type = 'purchase'").withColumn("_id", F.col("event_id"))
    path = scratch_path(spark, "copy")
    tables.copy_rows(source.select("_id", "event_id", "value"), path)
    tables.copy_rows(source.select("_id", "event_id", "value"), path)
    return tables.read_table(spark, path).groupBy("event_id", "value").agg(F.count("*").cast("int").alias("copies"))


@query("SELECT c_custkey, c_name FROM customer")
def replace_table(spark, sf):
    path = scratch_path(spark, "replace")
    tables.copy_rows(load(spark, sf, "orders").select("o_orderkey"), path)
    tables.replace_table(load(spark, sf, "customer").select(F.col("c_custkey").alias("_id"), "c_custkey", "c_name"), path)
    return tables.read_table(spark, path)


@query("""SELECT CAST(event_id AS VARCHAR) AS _id, CASE WHEN epoch_us(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
  ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS ts, event_type || 'é' AS kind FROM events""")
def export_json(spark, sf):
    path = scratch_path(spark, "export")
    rows = load(spark, sf, "events").select(
        F.col("event_id").alias("_id"), "ts", F.concat("event_type", F.lit("é")).alias("kind")
    )
    tables.export_json(rows, path)
    return spark.read.schema("_id string, ts string, kind string").json(path)


@query(f"""WITH {FLIGHTS_SQL} SELECT flight_date, flight_status, flight_iata, departure_iata, airline_name,
  codeshared AS shared, CAST(NULL AS VARCHAR) AS registration FROM flights""")
def json_snapshot(spark, sf):
    path = scratch_path(spark, "snapshot")
    tables.save_snapshot(flights(spark, sf).drop("pos"), path)
    back = landing.read_json_lines(spark, path, FLIGHT)
    return back.select(
        "flight_date", "flight_status", F.col("flight.iata").alias("flight_iata"),
        F.col("departure.iata").alias("departure_iata"), F.col("airline.name").alias("airline_name"),
        F.col("flight.codeshared.flight_iata").alias("shared"), "aircraft.registration",
    )


@query(f"""
WITH {SCHEDULES_SQL},
reg AS (SELECT cs_flight_iata AS code, min(pos) AS first_pos FROM schedules
        WHERE flight_iata IS NOT NULL AND cs_flight_iata IS NOT NULL GROUP BY 1),
kept AS (SELECT s.* FROM schedules s LEFT JOIN reg ON s.flight_iata = reg.code
  WHERE s.flight_iata IS NOT NULL AND s.cs_flight_iata IS NULL AND (first_pos IS NULL OR first_pos > s.pos) AND status = 'landed')
SELECT 'schedules' AS output, count(*) AS rows FROM kept UNION ALL SELECT 'features', count(*) FROM kept
UNION ALL SELECT 'delays', count(DISTINCT flight_iata) FROM kept""")
def schedule_run_outputs(spark, sf):
    folder = scratch_path(spark, "run")
    run_schedules(select_landed(schedules(spark, sf), "pos"), folder)
    from tarmac.operators.profile import row_counts

    written = {n: spark.read.schema("flight_iata string").json(f"{folder}/{n}") for n in ("schedules", "delays", "features")}
    return row_counts(written).select(F.col("table_name").alias("output"), "rows")


@query(f"""
WITH {SCHEDULES_SQL},
reg AS (SELECT cs_flight_iata AS code, min(pos) AS first_pos FROM schedules
        WHERE flight_iata IS NOT NULL AND cs_flight_iata IS NOT NULL GROUP BY 1),
kept AS (SELECT s.* FROM schedules s LEFT JOIN reg ON s.flight_iata = reg.code
  WHERE s.flight_iata IS NOT NULL AND s.cs_flight_iata IS NULL AND (first_pos IS NULL OR first_pos > s.pos) AND status = 'landed')
SELECT 'schedules' AS output, flight_iata, airline_iata AS airline, dep_iata AS departure, duration FROM kept
UNION ALL SELECT 'delays', flight_iata, NULL, NULL, NULL FROM kept GROUP BY flight_iata
UNION ALL SELECT 'features', NULL, airline_iata, dep_iata, duration FROM kept""")
def schedule_run_rows(spark, sf):
    folder = scratch_path(spark, "run")
    run_schedules(select_landed(schedules(spark, sf), "pos"), folder)
    fields = {
        "schedules": "flight_iata string, airline_iata string, dep_iata string, duration int",
        "delays": "flight_iata string, airline_iata string, dep_iata string, duration int",
        "features": "flight_iata string, airline_name string, departure_iata string, flight_duration_scheduled int",
    }
    parts = [
        spark.read.schema(schema).json(f"{folder}/{name}").toDF("flight_iata", "airline", "departure", "duration").withColumn("output", F.lit(name))
        for name, schema in fields.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
