from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tarmac.functions import text, times
from tarmac.plans.training import add_delays, reference_column


def one(spark, column, **values):
    ddl = ", ".join(f"{k} string" for k in values) or "x int"
    return spark.createDataFrame([tuple(values.values()) or (0,)], ddl).select(column).first()[0]


A, B = "2026-04-18T11:02:00+00:00", "2026-04-18T10:45:00+00:00"


@pytest.mark.parametrize(
    "later, earlier, missing, expected",
    [
        (A, B, "null", 17.0),
        (B, A, "null", 0.0),
        (None, B, "null", None),
        (A, None, "null", None),
        ("", B, "null", None),
        ("soon", B, "null", None),
        (None, B, "zero", 0.0),
        (A, B, "zero", 17.0),
        ("2026-04-18T11:02:30Z", B, "null", 17.5),
        ("2026-04-18T13:02:00+02:00", B, "null", 17.0),
    ],
)
def test_clamped_minutes(spark, later, earlier, missing, expected):
    column = times.clamped_minutes(times.parse_instant(F.col("a")), times.parse_instant(F.col("b")), missing)
    assert one(spark, column, a=later, b=earlier) == expected


def test_clamped_minutes_rejects_other_modes():
    with pytest.raises(ValueError):
        times.clamped_minutes(F.lit(None), F.lit(None), "drop")


@pytest.mark.parametrize(
    "written, expected",
    [
        ("2026-04-18 09:05", datetime(2026, 4, 18, 9, 5)),
        ("2026-4-8 9:5", datetime(2026, 4, 8, 9, 5)),
        ("", None),
        (None, None),
        ("2026-04-18", None),
        ("2026-04-18T09:05:00Z", None),
        ("2026-13-18 09:05", None),
    ],
)
def test_parse_minute(spark, written, expected):
    assert one(spark, times.parse_minute(F.col("t")), t=written) == expected


def test_wall_clock_ignores_the_offset(spark):
    hour = F.hour(times.wall_clock(F.col("t")))
    assert one(spark, hour, t="2026-04-18T10:45:00+02:00") == 10
    assert one(spark, hour, t="2026-04-18T23:45:00Z") == 23


@pytest.mark.parametrize("day, iso, weekend", [("2026-04-17", 5, 0), ("2026-04-18", 6, 1), ("2026-04-19", 7, 1), ("2026-04-20", 1, 0)])
def test_calendar(spark, day, iso, weekend):
    ts = F.col("t").cast("timestamp")
    row = spark.createDataFrame([(f"{day} 18:30:00",)], "t string").select(
        *[c.alias(n) for n, c in times.calendar_fields(ts).items()],
        *[c.alias(f"z_{n}") for n, c in times.zero_based_calendar_fields(ts).items()],
    ).first()
    assert (row.scheduled_hour, row.day_of_week, row.month, row.is_weekend) == (18, iso, 4, weekend)
    assert (row.z_day_of_week, row.z_is_weekend) == (iso - 1, weekend)


def test_unknown_day(spark):
    ts = F.lit(None).cast("timestamp")
    row = spark.range(1).select(
        times.calendar_fields(ts)["is_weekend"].alias("one"), times.zero_based_calendar_fields(ts)["is_weekend"].alias("two")
    ).first()
    assert (row.one, row.two) == (0, None)


def test_delays_of_absent_columns_are_unknown(spark):
    df = spark.createDataFrame([(datetime(2026, 1, 1, 10),)], "departure_scheduled timestamp")
    assert add_delays(df).first()["departure_delay_actual"] is None
    assert add_delays(df, missing="zero").first()["departure_delay_actual"] == 0.0


def test_reference_time(spark):
    df = spark.createDataFrame(
        [(None, None, datetime(2026, 1, 1, 10))],
        "departure_actual timestamp, departure_estimated timestamp, departure_scheduled timestamp",
    )
    assert df.select(reference_column(df, "departure")).first()[0] == datetime(2026, 1, 1, 10)
    assert df.select(reference_column(df, "departure", strict=True)).first()[0] is None


def test_instant_columns_of_any_type(spark):
    df = spark.createDataFrame(
        [("2026-04-18T10:00:00+02:00", datetime(2026, 4, 18, 8), date(2026, 4, 18))], "a string, b timestamp_ntz, c date"
    )
    row = df.select(*[times.instant_column(df, c).alias(c) for c in "abc"]).first()
    assert row.a == row.b == datetime(2026, 4, 18, 8) and row.c == datetime(2026, 4, 18)


def test_keys(spark):
    assert one(spark, text.flight_day_key(F.col("a"), F.col("b")), a=None, b="2026-04-18") == "N/A_2026-04-18"
    ts = times.parse_instant(F.col("t"))
    assert one(spark, text.city_hour_key(F.col("c"), ts), c="New York", t="2026-04-18T10:35:28Z") == "New York_2026041810"


@pytest.mark.parametrize("value, expected", [(3.5, 3.5), (-1.0, 0.0), (float("nan"), 0.0), (None, 0.0)])
def test_positive_or_zero(spark, value, expected):
    df = spark.createDataFrame([(value,)], "p double")
    assert df.select(text.positive_or_zero(F.col("p"))).first()[0] == expected


def test_within_hours_is_closed(spark):
    df = spark.createDataFrame([(datetime(2026, 1, 1, 6), datetime(2026, 1, 1)), (datetime(2026, 1, 1, 6, 0, 1), datetime(2026, 1, 1))], "a timestamp, b timestamp")
    assert [r[0] for r in df.select(times.within_hours(F.col("a"), F.col("b"), 6)).collect()] == [True, False]
