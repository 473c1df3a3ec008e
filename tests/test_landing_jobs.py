"""Landing zone to table to model to prediction, on small hand-made documents."""

import json

import pytest
from pyspark.sql import functions as F

from tarmac.plans import jobs
from tarmac.plans.serving import serving_features
from tarmac.plans.training import training_rows
from tarmac.schemas import FEATURE_COLUMNS, FEATURES, FLIGHT, SCHEDULE, WEATHER
from tarmac.session import scratch_path
from tarmac.sources import dimension, landing, tables


def flight(code, dep, arr, day="2026-04-18", status="landed", dep_times=("10:45", "10:50", "11:02"), arr_times=("14:40", "14:29", "15:00")):
    def end(iata, clock):
        at = [f"{day}T{c}:00+00:00" if c else c for c in clock]
        return {"iata": iata, "scheduled": at[0], "estimated": at[1], "actual": at[2]}

    return {
        "flight_date": day, "flight_status": status, "departure": end(dep, dep_times), "arrival": end(arr, arr_times),
        "airline": {"name": "Airline " + (code or "?")[0], "iata": (code or "?")[0]}, "flight": {"iata": code}, "live": None,
    }


def weather(city, at, main="Clear", temp=10.0, name=None, rain=None, **extra):
    doc = {
        "weather": [{"id": 1, "main": main, "description": main.lower()}], "main": {"temp": temp},
        "wind": {"speed": 3}, "visibility": 10000, "name": name or city, "collected_at": at, "_id": f"{city}_{at}",
    }
    return doc | ({"city": city} if city else {}) | ({"rain": rain} if rain else {}) | extra


CODES = [(1, "CDG", "Old Paris"), (2, "CDG", "Paris"), (3, "ORY", "Paris"), (4, "HEL", "Helsinki"), (5, "YQB", "Quebec")]


@pytest.fixture
def codes(spark):
    return dimension.last_wins(spark.createDataFrame(CODES, dimension.DIMENSION_DDL))


def put(folder, name, content):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(content, ensure_ascii=False))


def test_readers(spark, tmp_path, rows):
    put(tmp_path / "a", "flights.json", [flight("F1", "CDG", "HEL"), flight("F2", "HEL", "CDG")])
    read = landing.read_flights(spark, str(tmp_path / "a"))
    assert read.schema == spark.createDataFrame([], FLIGHT).schema
    assert rows(read, "flight.iata", "arrival.actual")[0] == ("F1", "2026-04-18T15:00:00+00:00")
    put(tmp_path / "w", "weather.json", [weather("Paris", "2026-04-18T10:00:00Z", temp=7)])
    assert rows(landing.read_weather(spark, str(tmp_path / "w")), "main.temp", "wind.speed", "rain.1h") == [(7.0, 3.0, None)]
    put(tmp_path / "f", "features.json", [{"airline_name": "X", "dep_visibility": 10000, "extra": 1}])
    assert landing.read_features(spark, str(tmp_path / "f")).first().dep_visibility == 10000.0


def test_envelopes(spark, tmp_path, rows):
    put(tmp_path, "1.json", {"response": [{"flight_iata": "A"}, {"flight_iata": "B", "duration": 90}]})
    put(tmp_path, "2.json", {"error": "quota"})
    put(tmp_path, "3.json", {"response": []})
    records = landing.read_envelope(spark, str(tmp_path), SCHEDULE, "response")
    assert rows(records, "pos", "flight_iata", "duration") == [(0, "A", None), (1, "B", 90)]
    skipped = landing.files_without(spark, str(tmp_path), SCHEDULE)
    assert [r.source_file.rsplit("/", 1)[1] for r in skipped.collect()] == ["2.json"]


def test_folder_columns_give_way_to_record_fields(spark, tmp_path, rows):
    put(tmp_path / "airport=CDG" / "flight_date=2020-01-01", "1.json", {"data": [flight("F1", "CDG", "HEL")]})
    records = landing.read_envelope(spark, str(tmp_path), FLIGHT, "data")
    assert rows(records, "airport", "flight_date") == [("CDG", "2026-04-18")]


def test_frames_from_memory(spark):
    df = landing.as_frame(spark, [flight("F1", "CDG", "HEL"), {"flight_date": "x"}], FLIGHT)
    assert df.count() == 2 and landing.as_frame(spark, df, FLIGHT) is df
    with pytest.raises(TypeError):
        landing.as_frame(spark, "flights", FLIGHT)


def test_dimension(spark, tmp_path, rows, codes):
    (tmp_path / "codes.csv").write_text("seq,iata,city\n" + "\n".join(",".join(map(str, c)) for c in CODES))
    assert rows(dimension.read_dimension(spark, str(tmp_path / "codes.csv"))) == rows(codes)
    assert dict(rows(codes))["CDG"] == "Paris"


def test_serving_features(spark, codes):
    flights = landing.as_frame(
        spark,
        [
            flight("M1", "CDG", "HEL", arr_times=("14:40", "14:29", None)),
            flight("M2", "ORY", "HEL", dep_times=("23:30", None, None), arr_times=("23:00", None, None)),
            flight("M3", "CDG", "XXX"),
            flight("M4", "CDG", "YQB"),
            flight(None, "HEL", "CDG", day="2026-04-20"),
        ],
        FLIGHT,
    )
    observed = landing.as_frame(
        spark,
        [
            weather("Paris", "2026-04-18T08:00:00Z", "Rain", 1.0),
            weather("Paris", "2026-04-18T10:00:00Z", "Fog", 20.39, rain={"1h": 0.5}),
            weather("Helsinki", "2026-04-18T10:00:00Z", "Drizzle", 9.25),
            weather(None, "2026-04-18T11:00:00Z", "Snow", 0.0, name="Quebec"),
        ],
        WEATHER,
    )
    got = {r.flight_iata: r for r in serving_features(flights, observed, codes, ["collected_at"]).collect()}
    assert set(got) == {"M1", "M2", ""}
    m1 = got["M1"].asDict()
    assert [m1[c] for c in FEATURE_COLUMNS] == [
        "Airline M", "CDG", "HEL", 10, 6, 4, 1, 17.0, 5.0, 0.0, 235.0, 20.39, 3.0, 10000.0, 0.5, 1, 9.25, 3.0, 10000.0, 0.0, 0,
    ]
    assert (got["M2"].departure_delay_actual, got["M2"].flight_duration_scheduled) == (0.0, 0.0)
    assert (got[""].day_of_week, got[""].is_weekend, got[""].airline_iata) == (1, 0, "?")


def test_training_rows(spark, codes):
    flights = landing.as_frame(
        spark,
        [
            flight("F1", "CDG", "HEL"),
            flight("F2", "XXX", "CDG", dep_times=("10:00", None, None)),
            flight("F3", "CDG", "HEL", arr_times=("14:40", "14:29", "")),
            flight("F4", "CDG", "HEL", arr_times=("14:40", None, "14:00")),
        ],
        FLIGHT,
    ).withColumn("_id", F.col("flight.iata"))
    observed = landing.as_frame(
        spark,
        [
            weather("Paris", "2026-04-18T09:00:00Z", "Clear", 1.0),
            weather("Paris", "2026-04-18T13:04:00Z", "Rain", 2.0),
            weather("Helsinki", "2026-04-10T00:00:00Z", "Snow", -3.0),
            weather("Elsewhere", "2026-04-18T11:00:00Z", "Fog", 9.0),
        ],
        WEATHER,
    )
    got = {r._id: r for r in training_rows(flights, observed, codes, identity=["_id"]).collect()}
    assert set(got) == {"F1", "F2", "F4"}
    # F1 leaves at 11:02, equally far from 09:00 and 13:04: the earlier one is used.
    assert (got["F1"].dep_temperature, got["F1"].dep_weather_bad, got["F1"].arr_temperature) == (1.0, 0, -3.0)
    assert (got["F1"].arrival_delay_actual, got["F4"].arrival_delay_actual) == (20.0, 0.0)
    assert (got["F2"].dep_temperature, got["F2"].dep_weather_bad, got["F2"].arr_temperature) == (None, None, 2.0)
    assert got["F2"].departure_delay_actual is None
    strict = training_rows(flights, observed, codes, identity=["_id"], strict=True)
    assert strict.where("_id = 'F2'").first().arr_temperature == 2.0


def test_collect_history(spark, tmp_path, rows):
    zone = tmp_path / "zone"
    put(zone / "airport=CDG", "1.json", {"data": [flight(f"C{i}", "CDG", "HEL") for i in range(60)]})
    put(zone / "airport=AMS", "1.json", {"data": [flight(f"A{i}", "AMS", "HEL") for i in range(5)]})
    put(
        zone / "airport=ORY", "1.json",
        {"data": [flight("O1", "ORY", "HEL", status="active"), flight("O2", "ORY", "HEL", day="2026-04-17")]},
    )
    table = scratch_path(spark, "flights")
    at = F.lit("2026-04-18 20:00:00").cast("timestamp")
    done = jobs.collect_history(spark, str(zone), table, "2026-04-18", at=at)
    assert rows(done) == [("inserted", 65)]
    stored = tables.read_table(spark, table)
    assert stored.where("_id = 'C7_2026-04-18'").first().arrival.iata == "HEL"
    assert rows(jobs.collect_history(spark, str(zone), table, "2026-04-18", at=at)) == [("updated", 65)]
    assert tables.read_table(spark, table).count() == 65
    # A provider's limits apply only where they are asked for: CDG closes the door behind it.
    few = jobs.collect_history(spark, str(zone), scratch_path(spark, "few"), "2026-04-18", at=at, per_request=52, open_below=50)
    assert rows(few) == [("inserted", 52)]


def test_old_answers_in_the_zone_hide_nothing(spark, tmp_path, rows):
    zone = tmp_path / "zone"
    put(zone / "airport=CDG", "r1.json", {"data": [flight(f"A{i}", "CDG", "HEL", "2026-04-17") for i in range(100)]})
    put(zone / "airport=CDG", "r2.json", {"data": [flight(f"B{i}", "CDG", "HEL", "2026-04-18") for i in range(40)]})
    done = jobs.collect_history(spark, str(zone), scratch_path(spark, "flights"), "2026-04-18")
    assert rows(done) == [("inserted", 40)]
    live = tmp_path / "live"
    put(live / "airport=CDG" / "status=active", "r1.json", {"data": [flight(f"A{i}", "CDG", "HEL", "2026-04-17", "active") for i in range(60)]})
    put(live / "airport=CDG" / "status=active", "r2.json", {"data": [flight(f"B{i}", "CDG", "HEL", "2026-04-18", "active") for i in range(8)]})
    assert jobs.live_flights(spark, str(live), "2026-04-18").count() == 8
    assert jobs.live_flights(spark, str(live), "2026-04-18", per_request=5).count() == 5


def test_day_folders_prune_the_scan(spark, tmp_path):
    for day in ("2026-04-17", "2026-04-18"):
        put(tmp_path / "airport=CDG" / f"flight_date={day}", "1.json", {"data": [flight("F", "CDG", "HEL", day)]})
    records = jobs._landed(spark, str(tmp_path), ["CDG"], flight_date=["2026-04-18"])
    plan = records._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("\n")[0]
    assert "flight_date" in filters and "airport" in filters and records.count() == 1


def test_backfill(spark, tmp_path, rows):
    zone = tmp_path / "zone"
    for day in ("2026-04-01", "2026-04-02"):
        answer = [flight("B0", "CDG", "HEL", day, arr_times=("14:40", None, None))]
        answer += [flight(f"B{i}", "CDG", "HEL", day) for i in range(1, 5)]
        put(zone / "airport=CDG" / f"flight_date={day}", "1.json", {"data": answer})
    table = scratch_path(spark, "flights")
    assert rows(jobs.backfill(spark, str(zone), table, per_day=2)) == [(4, 0)]
    assert rows(jobs.backfill(spark, str(zone), table, per_day=2)) == [(0, 4)]
    keys = [r._id for r in tables.read_table(spark, table).orderBy("_id").collect()]
    assert keys == ["B1_2026-04-01", "B1_2026-04-02", "B2_2026-04-01", "B2_2026-04-02"]
    assert rows(jobs.backfill(spark, str(zone), table)) == [(4, 4)]


def test_weather_table_keeps_one_row_per_city_hour(spark, tmp_path, rows):
    one, two = tmp_path / "one", tmp_path / "two"
    put(one, "w.json", [weather(None, "2026-04-18T10:05:00Z", temp=1.0, name="Paris"), weather(None, "2026-04-18T11:05:00Z", temp=2.0, name="Paris")])
    put(two, "w.json", [weather("Paris", "2026-04-18T10:50:00Z", temp=3.0)])
    table = scratch_path(spark, "weather")
    jobs.collect_weather(spark, str(one), table, "departure")
    jobs.collect_weather(spark, str(two), table)
    stored = tables.read_table(spark, table)
    assert rows(stored, "_id", "main.temp", "role", "city") == [
        ("Paris_2026041810", 3.0, "departure", "Paris"), ("Paris_2026041811", 2.0, "departure", None),
    ]


def test_the_last_weather_write_is_told_by_its_instant(spark, tmp_path, rows):
    table = scratch_path(spark, "weather")
    put(tmp_path, "w.json", [
        weather("Paris", "2026-04-18T10:10:00+02:00", temp=1.0), weather("Paris", "2026-04-18T08:50:00+00:00", temp=2.0),
        weather("Oslo", None, temp=3.0),
    ])
    jobs.collect_weather(spark, str(tmp_path), table, at=F.lit("2026-04-18 12:00:00").cast("timestamp"))
    assert rows(tables.read_table(spark, table), "_id", "main.temp") == [("Oslo_2026041812", 3.0), ("Paris_2026041808", 2.0)]


def test_weather_of_the_arrival_cities(spark, codes, rows):
    flights = landing.as_frame(spark, [flight("1", "CDG", "HEL")], FLIGHT)
    observed = landing.as_frame(spark, [weather("Paris", "2026-04-18T10:00:00Z"), weather(None, "2026-04-18T10:00:00Z", name="Helsinki")], WEATHER)
    cities, _ = jobs.arrival_cities(flights, codes, "2026-04-18")
    assert rows(jobs.weather_of(observed, cities), "name") == [("Helsinki",)]


def test_arrival_cities(spark, codes, rows):
    flights = landing.as_frame(
        spark, [flight("1", "CDG", "HEL"), flight("2", "CDG", "XXX"), flight("3", "CDG", "XXX"), flight("4", "HEL", "ORY", "2026-04-19")], FLIGHT
    )
    cities, unknown = jobs.arrival_cities(flights, codes, "2026-04-18")
    assert rows(cities) == [("Helsinki",)] and rows(unknown) == [("XXX", 2)]


def test_train_then_predict(spark, tmp_path, codes, rows):
    docs = [
        flight(f"{'MN'[i % 2]}{i}", ("CDG", "HEL")[i % 2], ("HEL", "CDG")[i % 2], f"2026-04-{1 + i % 28:02d}",
               dep_times=("10:00", "10:05", f"10:{i % 50:02d}"), arr_times=("14:00", "14:10", f"14:{(i * 7) % 60:02d}"))
        for i in range(80)
    ]
    flights = landing.as_frame(spark, docs, FLIGHT).withColumn("_id", F.col("flight.iata"))
    observed = landing.as_frame(
        spark, [weather(c, f"2026-04-{d:02d}T10:00:00Z", temp=float(d)) for d in range(1, 29) for c in ("Paris", "Helsinki")], WEATHER
    )
    path = scratch_path(spark, "model")
    scores = jobs.train(spark, flights, observed, codes, path)
    assert {r.split for r in scores.collect()} == {"train", "test"}
    zone = tmp_path / "zone"
    live = [flight(f"L{i}", "CDG", "HEL", status="active", arr_times=("14:00", "14:10", None)) for i in range(8)]
    put(zone / "airport=CDG" / "status=active", "1.json", {"data": live})
    planned = [flight(f"S{i}", "CDG", "HEL", status="scheduled", dep_times=("10:00", None, None), arr_times=("14:00", None, None)) for i in range(8)]
    put(zone / "airport=CDG" / "status=scheduled", "1.json", {"data": planned})
    chosen = jobs.live_flights(spark, str(zone), "2026-04-18")
    assert chosen.count() == 16
    chosen = jobs.live_flights(spark, str(zone), "2026-04-18", total=10)
    assert [r.iata for r in chosen.orderBy("status_rank", "pos").select("flight.iata").collect()] == [f"L{i}" for i in range(8)] + ["S0", "S1"]
    listing = jobs.predict(spark, chosen, observed, codes, path, ["collected_at"], ["status_rank", "pos"])
    got = rows(listing)
    assert sorted(r[0] for r in got) == list(range(1, 11)) and all(r[1] >= 0 for r in got)


def test_checks(spark):
    df = spark.createDataFrame([(str(i), f"2026-01-0{i}", None) for i in range(1, 6)], "_id string, collected_at string, v string")
    assert [tuple(r) for r in jobs.check_tables({"t": df}).collect()] == [("t", 5)]
    newest = jobs.newest_rows({"t": (df, {"_id": "label", "v": "detail"})})
    assert [tuple(r) for r in newest.collect()] == [("t", "5", "N/A"), ("t", "4", "N/A"), ("t", "3", "N/A")]


def test_features_schema_matches_the_contract(spark):
    assert spark.createDataFrame([], FEATURES).columns == FEATURE_COLUMNS and len(FEATURE_COLUMNS) == 21


def test_a_folder_has_pages_of_its_own_documents(spark, tmp_path, monkeypatch):
    from datetime import datetime

    from workload import landing_queries

    # Keys far apart, of two airports and two statuses, some of them null or repeated.
    orders = [(i * 9000, i % 2, "OF"[i % 3 == 0], 5.0, datetime(2024, 1, 1), "5-LOW") for i in range(60)]
    orders += [(None, 0, "O", 5.0, datetime(2024, 1, 1), "5-LOW"), (0, None, "O", 5.0, datetime(2024, 1, 1), "5-LOW")] + orders[:3]
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    spark.createDataFrame(orders, schema).write.parquet(f"{tmp_path}/orders.parquet")

    def documents(*folders):
        path = landing_queries._zone(spark, str(tmp_path), *folders)
        read = spark.read.json(path, schema="data ARRAY<STRUCT<flight_date: string>>, error string", multiLine=True)
        held = read.select(*folders, F.size("data").alias("n"), "error", F.col("_metadata.file_path").alias("file")).collect()
        assert len({r["file"] for r in held}) == len(held)
        return [r.n for r in held if r.error is None], [tuple(r)[: len(folders)] for r in held if r.error is not None]

    sizes, errors = documents("airport")
    assert (len(sizes), sum(sizes), sorted(errors, key=str)) == (3, 65, [("A0",), ("A1",), (None,)])
    sizes, errors = documents("airport", "status")
    assert (len(sizes), sum(sizes), len(errors)) == (5, 65, 5)
    # A folder with more documents than a page holds has several.
    monkeypatch.setattr(landing_queries, "PAGE", 8)
    sizes, _ = documents("airport")
    assert len(sizes) > 6 and sum(sizes) == 65
