"""Landing zones written from the given tables and read back with the engine's readers, and the jobs on them."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tarmac.functions import weather as wx
from tarmac.operators import profile, shape
from tarmac.plans import jobs, models
from tarmac.session import scratch_path
from tarmac.sources import landing, tables
from workload.registry import query
from workload.tables import FLIGHTS_SQL, WEATHER_SQL, flights, load, weather

#: Documents of one file: a provider's page, so that one task parses little.
PAGE = 4000


def _files(
    df: DataFrame, path: str, page: str, folders: list[str] | None = None, wrap: str | None = None, compression: str | None = None
) -> str:
    """One JSON file per page: an array of documents, or an object with the array in ``wrap``. Each folder has pages of its own."""
    folders = folders or []
    documents = [c for c in df.columns if c not in (page, *folders)]
    grouped = _paged(df, page, folders).groupBy("page", *folders).agg(F.collect_list(F.struct(*documents)).alias("documents"))
    value = F.to_json("documents") if wrap is None else F.to_json(F.struct(F.col("documents").alias(wrap)))
    _land(grouped.select(*folders, value.alias("value")), path, folders, compression=compression)
    return path


def _paged(df: DataFrame, page: str, folders: list[str]) -> DataFrame:
    """``page`` for every row: ranges of the column, or within a folder parts of its hashes, as many as the folder's documents fill."""
    if not folders:
        return df.withColumn("page", F.floor(F.col(page) / PAGE))
    sizes = df.groupBy(*[F.col(c).alias(f"of_{c}") for c in folders]).agg(F.ceil(F.count("*") / PAGE).alias("pages"))
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in folders])
    # A row per folder, of which the reader lists each.
    return df.join(F.broadcast(sizes), same).withColumn("page", F.pmod(F.xxhash64(page), F.col("pages")))


def _land(files: DataFrame, path: str, folders: list[str], mode: str = "errorifexists", compression: str | None = None) -> None:
    """Each row a file. Pages have no folders of their own: those would have to be made and listed one by one."""
    files.write.mode(mode).option("maxRecordsPerFile", 1).partitionBy(*folders).text(path, compression=compression)


_FLIGHT_COLUMNS = "flight_date, flight_status, flight_iata, departure_iata, arrival_iata, airline_name, codeshared AS shared"


def _flight_rows(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        *more, "flight_date", "flight_status", F.col("flight.iata").alias("flight_iata"), F.col("departure.iata").alias("departure_iata"),
        F.col("arrival.iata").alias("arrival_iata"), F.col("airline.name").alias("airline_name"),
        F.col("flight.codeshared.flight_iata").alias("shared"),
    )


@query(f"WITH {FLIGHTS_SQL} SELECT {_FLIGHT_COLUMNS} FROM flights")
def flights_json_array(spark, sf):
    return _flight_rows(landing.read_flights(spark, _files(flights(spark, sf), scratch_path(spark, "land"), "pos")))


@query(f"""WITH {WEATHER_SQL} SELECT id AS _id, name, city, epoch_us(collected_at) AS at, temperature, condition,
  CASE WHEN precipitation <> 0 THEN precipitation END AS precipitation FROM weather""")
def weather_json_array(spark, sf):
    rows = weather(spark, sf).withColumn("order", F.split("_id", "-")[0].cast("long"))
    read = landing.read_weather(spark, _files(rows, scratch_path(spark, "land"), "order"))
    return read.select(
        "_id", "name", "city", F.unix_micros(F.to_timestamp("collected_at")).alias("at"), F.col("main.temp").alias("temperature"),
        F.get(F.col("weather.main"), F.lit(0)).alias("condition"), F.col("rain.1h").alias("precipitation"),
    )


@query("SELECT o_orderpriority AS airline_name, o_custkey::DOUBLE AS dep_visibility, NULL::DOUBLE AS arr_visibility FROM orders")
def features_json_array(spark, sf):
    rows = load(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("airline_name"), F.col("o_custkey").alias("dep_visibility"), F.lit("x").alias("extra")
    )
    read = landing.read_features(spark, _files(rows, scratch_path(spark, "land"), "o_orderkey"))
    return read.select("airline_name", "dep_visibility", "arr_visibility")


def _zone(spark, sf, *folders) -> str:
    """Flight answers below ``airport=`` (and ``status=``) folders, and one error answer per airport."""
    rows = flights(spark, sf).withColumns({"airport": F.col("departure.iata"), "status": F.col("flight_status")})
    rows = rows.drop(*[c for c in ("airport", "status") if c not in folders])
    path = _files(rows, scratch_path(spark, "zone"), "pos", list(folders), "data")
    errors = rows.select(*folders).distinct().select(*folders, F.lit('{"error": "quota"}').alias("value"))
    _land(errors, path, list(folders), "append")
    return path


@query(f"WITH {FLIGHTS_SQL} SELECT departure_iata AS airport, {_FLIGHT_COLUMNS} FROM flights")
def envelope_records(spark, sf):
    return _flight_rows(landing.read_envelope(spark, _zone(spark, sf, "airport"), jobs.FLIGHT), "airport")


@query(f"WITH {FLIGHTS_SQL} SELECT DISTINCT 'airport=' || departure_iata AS folder FROM flights")
def skipped_files(spark, sf):
    skipped = landing.files_without(spark, _zone(spark, sf, "airport"), jobs.FLIGHT, "data")
    return skipped.select(F.regexp_extract("source_file", "(airport=[^/]*)", 1).alias("folder"))


@query("""SELECT o_orderkey AS key, o_orderpriority AS name, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice END AS price,
  NULL::VARCHAR AS note FROM orders""")
def rows_from_memory(spark, sf):
    # Documents made in the tasks, some without a price, all without a note.
    price = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice")).alias("price")
    made = load(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("name"), price)
    documents = landing.as_frame(spark, made.select(F.to_json(F.struct("*")).alias("doc")), "doc STRING")
    return landing.parse_documents(documents, "doc", "key LONG, name STRING, price DOUBLE, note STRING")


_AIRPORTS = [f"A{i}" for i in range(30)]


@query(f"""WITH {FLIGHTS_SQL}, d AS (SELECT min(flight_date) AS day FROM flights WHERE flight_status = 'landed')
SELECT DISTINCT flight_iata || '_' || flight_date AS _id, flight_date, flight_status FROM flights, d
WHERE flight_date = day AND flight_status = 'landed'""")
def collect_history(spark, sf):
    zone, table = _zone(spark, sf, "airport"), scratch_path(spark, "history")
    day = flights(spark, sf).where("flight_status = 'landed'").agg(F.min("flight_date")).first()[0]
    jobs.collect_history(spark, zone, table, day, _AIRPORTS, F.lit("2026-01-01").cast("timestamp"))
    return tables.read_table(spark, table).select("_id", "flight_date", "flight_status")


@query(f"""WITH {FLIGHTS_SQL}, d AS (SELECT max(flight_date) AS day FROM flights WHERE flight_status <> 'landed')
SELECT flight_iata, departure_iata, flight_status FROM flights, d WHERE flight_date = day AND flight_status <> 'landed'""")
def live_flights(spark, sf):
    day = flights(spark, sf).where("flight_status <> 'landed'").agg(F.max("flight_date")).first()[0]
    live = jobs.live_flights(spark, _zone(spark, sf, "airport", "status"), day, _AIRPORTS)
    return live.select(F.col("flight.iata").alias("flight_iata"), F.col("departure.iata").alias("departure_iata"), "flight_status")


@query("""
SELECT o_custkey % 1000 || '_' || o_orderstatus AS _id, o_orderstatus AS day,
  arg_max(o_totalprice, o_orderkey) FILTER (o_orderkey % 2 = 0) AS price,
  arg_max(o_orderpriority, o_orderkey) FILTER (o_orderkey % 2 = 1) AS priority FROM orders GROUP BY 1, 2""")
def upsert_new_column(spark, sf):
    # Two batches with different columns: each keeps what the other has stored.
    orders = load(spark, sf, "orders").withColumns(
        {"_id": F.concat_ws("_", F.col("o_custkey") % 1000, "o_orderstatus"), "day": F.col("o_orderstatus"), "seq": F.col("o_orderkey")}
    )
    path = scratch_path(spark, "columns")
    even, odd = orders.where("o_orderkey % 2 = 0"), orders.where("o_orderkey % 2 = 1")
    tables.upsert_table(even.select("_id", "day", "seq", F.col("o_totalprice").alias("price")), path, "_id", ["seq"], "day")
    tables.upsert_table(odd.select("_id", "day", "seq", F.col("o_orderpriority").alias("priority")), path, "_id", ["seq"], "day")
    return tables.read_table(spark, path).select("_id", "day", "price", "priority")


@query("SELECT 'events' AS table_name, event_id, 1 AS copies FROM events")
def namespace_copy(spark, sf):
    # Declared tables, one of them empty, copied to another database.
    source, target = (f"{kind}_{uuid.uuid4().hex}" for kind in ("source", "target"))
    spark.sql(f"CREATE DATABASE {source}")
    tables.create_if_missing(spark, f"{source}.events", "_id BIGINT, event_id BIGINT")
    tables.create_if_missing(spark, f"{source}.nothing", "_id BIGINT, event_id BIGINT")
    load(spark, sf, "events").select(F.col("event_id").alias("_id"), "event_id").write.insertInto(f"{source}.events")
    copied = tables.copy_namespace(spark, source, target)
    parts = [spark.table(f"{target}.{name}").select(F.lit(name).alias("table_name"), "event_id") for name in copied]
    return parts[0].groupBy("table_name", "event_id").agg(F.count("*").cast("int").alias("copies")) if len(parts) == 1 else parts[0]


@query("SELECT event_id, epoch_us(TIMESTAMP '2026-01-02 03:04:05') AS collected_at FROM events")
def stamped_rows(spark, sf):
    at = F.lit("2026-01-02 03:04:05").cast("timestamp")
    stamped = tables.stamp(load(spark, sf, "events").select("event_id"), at)
    return stamped.select("event_id", F.unix_micros("collected_at").alias("collected_at"))


@query("SELECT 'customers' AS table_name, count(*) AS rows FROM customer UNION ALL SELECT 'orders', count(*) FROM orders")
def catalog_inventory(spark, sf):
    database = f"inventory_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    for name, table in (("customers", "customer"), ("orders", "orders")):
        load(spark, sf, table).write.saveAsTable(f"{database}.{name}")
    counts = profile.inventory(spark).where(F.col("table_name").startswith(f"{database}."))
    return counts.select(F.substring_index("table_name", ".", -1).alias("table_name"), "rows")


@query("""SELECT 'features' AS part, 'o_orderkey' AS first_column, count(*) AS rows FROM orders
UNION ALL SELECT 'target', 'o_totalprice', count(o_totalprice) FROM orders""")
def target_split(spark, sf):
    features, target = shape.split_target(load(spark, sf, "orders"), "o_totalprice")
    counts = []
    for part, frame in (("features", features), ("target", target)):
        names = F.lit(part).alias("part"), F.lit(frame.columns[0]).alias("first_column")
        counts.append(frame.agg(F.count(frame.columns[0]).alias("rows")).select(*names, "rows"))
    return counts[0].unionByName(counts[1])


@query("""SELECT 'features' AS part, o_orderkey, o_custkey, NULL::DOUBLE AS target FROM orders
UNION ALL SELECT 'target', NULL, NULL, o_totalprice FROM orders""")
def target_split_rows(spark, sf):
    features, target = shape.split_target(load(spark, sf, "orders"), "o_totalprice")
    assert "o_totalprice" not in features.columns
    left = features.select(F.lit("features").alias("part"), "o_orderkey", "o_custkey")
    right = target.select(F.lit("target").alias("part"), F.col("o_totalprice").alias("target"))
    return left.unionByName(right, allowMissingColumns=True)


@query("SELECT o_orderpriority, o_orderstatus FROM orders")
def text_columns(spark, sf):
    orders = load(spark, sf, "orders")
    return orders.select(*shape.columns_of(orders, T.StringType))


@query(f"""WITH {WEATHER_SQL},
m AS (SELECT coalesce(city, name) AS city, date_trunc('month', collected_at) + (collected_at - date_trunc('day', collected_at)) AS collected_at FROM weather)
SELECT city || '_' || strftime(collected_at, '%Y%m%d%H') AS _id, strftime(max(collected_at), '%Y-%m-%d') AS day,
  epoch_us(max(collected_at)) AS at, 'departure' AS role FROM m GROUP BY 1""")
def collect_weather(spark, sf):
    # Answers of the weather provider, landed page by page, upserted per city and hour; each month's fall on its first day.
    at = F.col("collected_at")
    documents = weather(spark, sf).withColumn("order", F.split("_id", "-")[0].cast("long")).drop("_id")
    documents = documents.withColumn("collected_at", F.date_trunc("month", at) + (at - F.date_trunc("day", at)))
    zone, table = _files(documents, scratch_path(spark, "land"), "order"), scratch_path(spark, "weather")
    jobs.collect_weather(spark, zone, table, "departure", F.lit("2026-01-01").cast("timestamp"))
    return tables.read_table(spark, table).select("_id", "day", F.unix_micros("collected_instant").alias("at"), "role")


@query(f"""WITH {WEATHER_SQL}
SELECT concat_ws('-', id, CAST(temperature AS INTEGER), epoch_us(collected_at)) AS _id, temperature, wind_speed, precipitation, weather_bad, CAST(split_part(id, '-', 3) AS BIGINT) AS station,
  CASE WHEN split_part(id, '-', 2) = '1' THEN 2 ELSE 1 END AS version FROM weather""")
def weather_variants(spark, sf):
    # Documents with fields that no schema declares, landed, upserted twice, and read by typed paths.
    part = F.split("_id", "-")
    rows = weather(spark, sf).withColumns({"order": part[0].cast("long"), "station": F.struct(part[2].cast("long").alias("code"))})
    rows = rows.withColumn("_id", F.concat_ws("-", "_id", F.col("main.temp").cast("int"), F.unix_micros("collected_at")))
    table = scratch_path(spark, "variants")

    def land(documents, version):
        versioned = documents.withColumn("version", F.lit(version))
        landed = landing.read_variants(spark, _files(versioned, scratch_path(spark, "land"), "order", compression="gzip"))
        keyed = {"_id": "$._id", "name": "$.name"}
        batch = landed.select("doc", *[F.try_variant_get("doc", p, "string").alias(c) for c, p in keyed.items()], F.lit(version).alias("at"))
        tables.upsert_table(batch, table, "_id", ["at"], "name")

    land(rows, 1)
    land(rows.where(part[1] == "1"), 2)
    read = tables.read_table(spark, table)
    packed = wx.weather_of_variant(F.col("doc"))
    more = [F.try_variant_get("doc", "$.station.code", "long").alias("station"), F.try_variant_get("doc", "$.version", "int").alias("version")]
    kept = ("temperature", "wind_speed", "precipitation", "weather_bad")
    return read.select("_id", packed.alias("w"), *more).select("_id", *[f"w.{c}" for c in kept], "station", "version")


@query("SELECT event_id, 'k' AS name, CAST(json_extract(props, '$.k') AS BIGINT) AS value FROM events")
def map_rows(spark, sf):
    events = load(spark, sf, "events").select("event_id", F.from_json("props", "map<string,bigint>").alias("m"))
    keyed = events.select(F.transform_keys("m", lambda k, v: F.struct(k.alias("name"), "event_id")).alias("m"))
    return shape.map_rows(keyed, "m", "key", "value").select("key.event_id", "key.name", "value")


_FILLED = """
WITH e AS (SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN event_type END AS kind,
  CASE WHEN event_id % 5 <> 0 THEN value END AS value, event_id % 4 <> 0 AS train FROM events)
"""


def _holes(spark, sf):
    return load(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("kind"),
        F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value"), (F.col("event_id") % 4 != 0).alias("train"),
    )


@query(_FILLED + """, m AS (SELECT kind FROM e WHERE train AND kind IS NOT NULL GROUP BY kind ORDER BY count(*) DESC, kind LIMIT 1)
SELECT event_id, coalesce(e.kind, m.kind) AS kind FROM e, m""")
def fitted_text_fill(spark, sf):
    # Learnt on the training rows, applied to all.
    rows = _holes(spark, sf)
    model = models.MostFrequentImputer(["kind"]).fit(rows.where("train"))
    return model.transform(rows).select("event_id", "kind")


@query(_FILLED + """, m AS (SELECT avg(value) AS mean FROM e WHERE train)
SELECT event_id, round(coalesce(value, mean), 6) AS value FROM e, m""")
def fitted_number_fill(spark, sf):
    from pyspark.ml.feature import Imputer

    rows = _holes(spark, sf)
    fill = next(s for s in models.preprocessing(rows.where("train"), [], ["value"]) if isinstance(s, Imputer))
    filled = fill.fit(rows.where("train")).transform(rows)
    return filled.select("event_id", F.round("value_filled", 6).alias("value"))


@query("SELECT 'o_clerk' AS column_name, 0::BIGINT AS missing, 0::BIGINT AS total, NULL::DOUBLE AS missing_percent FROM orders HAVING count(*) > 0")
def empty_missing_share(spark, sf):
    orders = load(spark, sf, "orders")
    none = orders.where(F.col("o_orderkey") < 0)
    share = profile.missing_share(none, "o_custkey").withColumn("column_name", F.lit("o_clerk"))
    return share.where(F.lit(not orders.isEmpty())).select("column_name", "missing", "total", "missing_percent")


@query("""SELECT o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS r2, count(*) AS rows
FROM orders GROUP BY o_orderstatus""")
def constant_label_r2(spark, sf):
    # One label value per group; the prediction is right in one of the groups.
    rows = load(spark, sf, "orders").select(
        "o_orderstatus", F.lit(5.0).alias("label"), F.when(F.col("o_orderstatus") == "F", 5.0).otherwise(4.0).alias("prediction")
    )
    return profile.r2(rows, "label", "prediction", ["o_orderstatus"])
