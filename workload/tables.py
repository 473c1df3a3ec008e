"""The given tables in the shapes the engine works on.

Flights are derived from ``orders``, weather observations from ``lineitem``, airport codes from
``nation``; all of them grow with the tables. ``*_SQL`` holds the same derivation for the SQL
checks, with instants as timestamps where the documents hold text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _iso(ts: str) -> str:
    return f"date_format({ts}, \"yyyy-MM-dd'T'HH:mm:ss\") || '+00:00'"


def _plus(ts: str, minutes: str) -> str:
    return f"{ts} + make_dt_interval(0, 0, cast({minutes} AS INT))"


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flights_from(load(spark, sf_dir, "orders"))


def flights_from(o: DataFrame) -> DataFrame:
    """Nested flight documents, one per order. Landed flights have an actual arrival; some
    estimates are missing, some times are empty or unreadable text."""
    timed = o.selectExpr("*", _plus("o_orderdate", "o_custkey * 37 % 1440") + " AS dep").selectExpr(
        "*",
        _plus("dep", "if(o_orderpriority = '1-URGENT', 40 - o_custkey % 90, 45 + o_custkey % 700)") + " AS arr",
    )
    departure_estimated = _iso(_plus("dep", "o_orderkey % 90 - 20"))
    departure_actual = _iso(_plus("dep", "o_orderkey * 13 % 240 - 60"))
    arrival_estimated = _iso(_plus("arr", "o_custkey % 120 - 40"))
    arrival_actual = _iso(_plus("arr", "floor(o_totalprice) % 300 - 100"))
    return timed.selectExpr(
        "o_orderkey AS pos",
        "date_format(o_orderdate, 'yyyy-MM-dd') AS flight_date",
        "CASE o_orderstatus WHEN 'F' THEN 'landed' WHEN 'O' THEN 'active' ELSE 'scheduled' END AS flight_status",
        f"""named_struct('iata', 'A' || o_custkey % 30, 'scheduled', {_iso("dep")},
            'estimated', CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN {departure_estimated} END,
            'actual', CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderpriority = '5-LOW' THEN ''
                      ELSE {departure_actual} END) AS departure""",
        f"""named_struct('iata', 'A' || o_orderkey % 30, 'scheduled', {_iso("arr")},
            'estimated', CASE WHEN o_orderpriority <> '2-HIGH' THEN {arrival_estimated} END,
            'actual', CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM' THEN 'unknown'
                      WHEN o_orderstatus = 'F' THEN {arrival_actual} END) AS arrival""",
        "named_struct('name', o_orderpriority, 'iata', substring(o_orderpriority, 1, 1)) AS airline",
        """named_struct('iata', 'F' || o_custkey, 'codeshared', CASE WHEN o_orderpriority = '1-URGENT'
            THEN named_struct('flight_iata', 'F' || o_orderkey % 1000) END) AS flight""",
    )


FLIGHTS_SQL = """
times AS (
  SELECT *, o_orderdate + to_minutes(o_custkey * 37 % 1440) AS dep FROM orders),
times2 AS (
  SELECT *, dep + to_minutes(CASE WHEN o_orderpriority = '1-URGENT' THEN 40 - o_custkey % 90
                                  ELSE 45 + o_custkey % 700 END) AS arr FROM times),
flights AS (
  SELECT o_orderkey AS pos, strftime(o_orderdate, '%Y-%m-%d') AS flight_date,
    CASE o_orderstatus WHEN 'F' THEN 'landed' WHEN 'O' THEN 'active' ELSE 'scheduled' END AS flight_status,
    o_orderpriority AS airline_name, substr(o_orderpriority, 1, 1) AS airline_iata,
    'F' || o_custkey AS flight_iata,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'F' || (o_orderkey % 1000) END AS codeshared,
    'A' || (o_custkey % 30) AS departure_iata, 'A' || (o_orderkey % 30) AS arrival_iata,
    dep AS departure_scheduled,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN dep + to_minutes(o_orderkey % 90 - 20) END AS departure_estimated,
    CASE WHEN o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'
         THEN dep + to_minutes(o_orderkey * 13 % 240 - 60) END AS departure_actual,
    arr AS arrival_scheduled,
    CASE WHEN o_orderpriority <> '2-HIGH' THEN arr + to_minutes(o_custkey % 120 - 40) END AS arrival_estimated,
    CASE WHEN o_orderstatus = 'F' AND o_orderpriority <> '3-MEDIUM'
         THEN arr + to_minutes(CAST(floor(o_totalprice) AS BIGINT) % 300 - 100) END AS arrival_actual
  FROM times2)
"""


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested weather documents, one per line item, spread over the nations' names as cities.
    Documents of one writer lack ``city``; several share a city and an instant."""
    return load(spark, sf_dir, "lineitem").selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS _id",
        "'NATION_' || l_suppkey % 25 AS name",
        "CASE WHEN l_returnflag <> 'N' THEN 'NATION_' || l_suppkey % 25 END AS city",
        f"cast({_plus('l_shipdate', 'l_partkey % 1440')} AS timestamp) AS collected_at",
        """CASE WHEN l_returnflag = 'A' THEN array(named_struct('main', 'Rain', 'description', 'light rain'))
            WHEN l_returnflag = 'R' THEN array(named_struct('main', 'Mist', 'description', 'mist'))
            WHEN l_linestatus = 'O' THEN cast(array() AS array<struct<main: string, description: string>>)
            ELSE array(named_struct('main', 'Light Snow', 'description', 'light snow')) END AS weather""",
        "named_struct('temp', l_quantity) AS main",
        "named_struct('speed', l_discount) AS wind",
        "l_extendedprice AS visibility",
        "CASE WHEN l_linestatus = 'F' THEN named_struct('1h', nullif(l_tax, 0.0D)) END AS rain",
    )


WEATHER_SQL = """
weather AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id,
    'NATION_' || (l_suppkey % 25) AS name,
    CASE WHEN l_returnflag <> 'N' THEN 'NATION_' || (l_suppkey % 25) END AS city,
    l_shipdate + to_minutes(l_partkey % 1440) AS collected_at,
    l_quantity AS temperature, l_discount AS wind_speed, l_extendedprice AS visibility,
    CASE WHEN l_linestatus = 'F' THEN l_tax ELSE 0.0 END AS precipitation,
    CASE l_returnflag WHEN 'A' THEN 'Rain' WHEN 'R' THEN 'Mist'
      ELSE CASE WHEN l_linestatus <> 'O' THEN 'Light Snow' END END AS condition,
    CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 0
      ELSE CASE WHEN l_linestatus = 'O' THEN 0 ELSE 1 END END AS weather_bad
  FROM lineitem)
"""


def code_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seq, iata, city) entries with every code given twice; the later entry is the valid one.
    Codes A25 to A29 occur in the flights and are missing here."""
    n = load(spark, sf_dir, "nation")
    code = F.concat(F.lit("A"), "n_nationkey")
    old = n.select(F.col("n_nationkey").alias("seq"), code.alias("iata"), F.concat(F.lit("OLD_"), "n_name").alias("city"))
    new = n.select((F.col("n_nationkey") + 100).alias("seq"), code.alias("iata"), F.col("n_name").alias("city"))
    return old.unionByName(new)


CODES_SQL = """
entries AS (
  SELECT n_nationkey AS seq, 'A' || n_nationkey AS iata, 'OLD_' || n_name AS city FROM nation
  UNION ALL SELECT n_nationkey + 100, 'A' || n_nationkey, n_name FROM nation),
codes AS (SELECT iata, arg_max(city, seq) AS city FROM entries GROUP BY iata)
"""


def schedules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat schedule rows, one per order, in the second provider's layout."""
    return schedules_from(flights(spark, sf_dir))


def schedules_from(documents: DataFrame) -> DataFrame:
    def minute(column: str) -> str:
        return f"CASE WHEN {column} RLIKE '^[12]' THEN substring(translate({column}, 'T', ' '), 1, 16) END"

    flat = documents.selectExpr("*", "flight_status = 'scheduled' AND airline.name = '5-LOW' AS lost")
    return flat.selectExpr(
        "pos", "airline.iata AS airline_iata", "if(lost, NULL, flight.iata) AS flight_iata",
        "flight.codeshared.flight_iata AS cs_flight_iata", "departure.iata AS dep_iata", "arrival.iata AS arr_iata",
        f"if(lost, NULL, {minute('departure.scheduled')}) AS dep_time",
        f"{minute('departure.estimated')} AS dep_estimated", f"{minute('departure.actual')} AS dep_actual",
        f"{minute('arrival.scheduled')} AS arr_time", f"{minute('arrival.estimated')} AS arr_estimated",
        f"{minute('arrival.actual')} AS arr_actual", "flight_status AS status", "cast(pos % 500 AS INT) AS duration",
    )


SCHEDULES_SQL = (
    FLIGHTS_SQL
    + """,
schedules AS (
  SELECT pos, airline_iata, flight_status AS status, CAST(pos % 500 AS INTEGER) AS duration,
    CASE WHEN NOT (flight_status = 'scheduled' AND airline_name = '5-LOW') THEN flight_iata END AS flight_iata,
    codeshared AS cs_flight_iata, departure_iata AS dep_iata, arrival_iata AS arr_iata,
    CASE WHEN NOT (flight_status = 'scheduled' AND airline_name = '5-LOW') THEN departure_scheduled END AS dep_time,
    departure_estimated AS dep_estimated, departure_actual AS dep_actual, arrival_scheduled AS arr_time,
    arrival_estimated AS arr_estimated, arrival_actual AS arr_actual
  FROM flights)
"""
)


def minutes_sql(later: str, earlier: str) -> str:
    """Clamped minutes between two timestamp expressions, null if either is null."""
    diff = f"((epoch_us({later}) - epoch_us({earlier})) / 1e6 / 60.0)"
    return f"CASE WHEN {later} IS NOT NULL AND {earlier} IS NOT NULL THEN greatest({diff}, 0.0) END"
