"""Small text, key and number expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.functions.times import hour_key

UNKNOWN = "N/A"


def present(value: Column) -> Column:
    """Neither null nor the empty string."""
    return value.isNotNull() & (value != "")


def contains_any(value: Column, words: list[str]) -> Column:
    """Case-insensitive: does the text contain one of ``words``?"""
    lowered = F.lower(value)
    return reduce(or_, [lowered.contains(word) for word in words])


def or_unknown(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(UNKNOWN))


def flight_day_key(code: Column, day: Column) -> Column:
    """``{code}_{day}``; unknown parts read ``N/A`` so the key is never null."""
    return F.concat_ws("_", or_unknown(code), or_unknown(day))


def city_hour_key(city: Column, collected_at: Column) -> Column:
    """``{city}_{yyyyMMddHH}``: one row per city and UTC hour."""
    return F.concat_ws("_", city, hour_key(collected_at))


def positive_or_zero(value: Column) -> Column:
    """Clamp at zero; null and NaN also give zero (``greatest`` would rank NaN highest)."""
    return F.when((value > 0) & ~F.isnan(value), value).otherwise(F.lit(0.0))


def percent(part: Column, total: Column) -> Column:
    """``100 * part / total`` to two decimals, halves to even; null for a total of zero."""
    return F.rint(F.try_divide(part, total) * F.lit(100.0) * F.lit(100.0)) / F.lit(100.0)
