"""Instants, clamped minutes and calendar fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MINUTE_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}$"
DAY_FORMAT = "yyyy-MM-dd"
HOUR_KEY_FORMAT = "yyyyMMddHH"


def parse_instant(text: Column) -> Column:
    """ISO-8601 text (``Z``, an offset, or none) to a timestamp; unparsable text becomes null.

    The ``try_`` form matters: with ANSI mode on, a plain cast fails the whole job on one bad row.
    """
    return F.try_to_timestamp(text)


def parse_minute(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm`` text to a timestamp; empty and malformed text become null.

    The shape is checked and the text cast, which is several times faster than a format parser.
    """
    return F.when(text.rlike(MINUTE_SHAPE), F.try_to_timestamp(text))


def wall_clock(text: Column) -> Column:
    """The date and time as written, ignoring the offset the text carries."""
    return text.try_cast("timestamp_ntz")


def instant_column(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a timestamp whatever its stored type: text, date or timestamp."""
    kind = dict(df.dtypes)[name]
    return parse_instant(F.col(name)) if kind == "string" else F.col(name).cast("timestamp")


def parse_time_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Replace the listed columns that exist by parsed timestamps."""
    return df.withColumns({n: instant_column(df, n) for n in names if n in df.columns})


def micros_between(later: Column, earlier: Column) -> Column:
    return F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))


def time_distance(a: Column, b: Column) -> Column:
    """Absolute distance in microseconds."""
    return F.abs(micros_between(a, b))


def within_hours(a: Column, b: Column, hours: int) -> Column:
    """Closed-interval test ``|a - b| <= hours``."""
    return time_distance(a, b) <= F.lit(hours * 3_600_000_000)


def clamped_minutes(later: Column, earlier: Column, missing: str = "null") -> Column:
    """Minutes from ``earlier`` to ``later``, never below zero.

    A missing end gives null (``missing="null"``, training) or 0.0 (``missing="zero"``, serving).
    ``greatest`` skips nulls, so the null case is decided before clamping.
    """
    minutes = micros_between(later, earlier) / F.lit(1e6) / F.lit(60.0)
    clamped = F.when(minutes.isNotNull(), F.greatest(minutes, F.lit(0.0)))
    if missing == "zero":
        return F.coalesce(clamped, F.lit(0.0))
    if missing != "null":
        raise ValueError(f"missing must be 'null' or 'zero', not {missing!r}")
    return clamped


def reference_time(*candidates: Column) -> Column:
    """The first known instant, in the order given."""
    return F.coalesce(*candidates)


def iso_weekday(ts: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(ts) + 1


def weekend_flag(day: Column, first_day: int = 1, missing: str = "zero") -> Column:
    """1 on Saturday and Sunday. ``first_day`` is Monday's number; a null day gives 0 or null."""
    flag = day.isin(first_day + 5, first_day + 6).cast("int")
    return F.coalesce(flag, F.lit(0)) if missing == "zero" else flag


def calendar_fields(ts: Column) -> dict[str, Column]:
    """Hour, ISO weekday, month and weekend flag of one timestamp."""
    day = iso_weekday(ts)
    return {
        "scheduled_hour": F.hour(ts),
        "day_of_week": day,
        "month": F.month(ts),
        "is_weekend": weekend_flag(day),
    }


def zero_based_calendar_fields(ts: Column) -> dict[str, Column]:
    """The second provider's variant: Monday is 0, and an unknown day has an unknown flag."""
    day = F.weekday(ts)
    return {
        "scheduled_hour": F.hour(ts),
        "day_of_week": day,
        "month": F.month(ts),
        "is_weekend": weekend_flag(day, first_day=0, missing="null"),
    }


def day_string(ts: Column) -> Column:
    return F.date_format(ts, DAY_FORMAT)


def hour_key(ts: Column) -> Column:
    return F.date_format(ts, HOUR_KEY_FORMAT)


def each_day(first: Column, last: Column) -> Column:
    """Array of the days from ``first`` to ``last``, both included."""
    return F.sequence(first.cast("date"), last.cast("date"), F.expr("interval 1 day"))
