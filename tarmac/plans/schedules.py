"""The second provider's flat schedules: selection, features and the delay map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions import times
from tarmac.operators import caps, filters, shape
from tarmac.session import cut_lineage
from tarmac.sources.tables import save_run


def schedule_features(schedules: DataFrame, identity: list[str] | None = None) -> DataFrame:
    """One feature row per schedule. The airline's code stands in for its name, the duration is
    passed through, weekdays count from 0 and unknown values stay null."""
    instants = ("dep_time", "arr_time", "dep_actual", "arr_actual", "dep_estimated", "arr_estimated")
    parsed = schedules.withColumns({name: times.parse_minute(F.col(name)) for name in instants})
    calendar = times.zero_based_calendar_fields(F.col("dep_time"))
    minutes = {
        "departure_delay_actual": ("dep_actual", "dep_time"),
        "arrival_delay_actual": ("arr_actual", "arr_time"),
        "departure_delay_estimated": ("dep_estimated", "dep_time"),
        "arrival_delay_estimated": ("arr_estimated", "arr_time"),
    }
    return parsed.select(
        *(identity or []),
        F.col("airline_iata").alias("airline_name"),
        F.col("dep_iata").alias("departure_iata"),
        F.col("arr_iata").alias("arrival_iata"),
        *[c.alias(n) for n, c in calendar.items()],
        *[times.clamped_minutes(F.col(a), F.col(b)).alias(n) for n, (a, b) in minutes.items()],
        F.col("duration").alias("flight_duration_scheduled"),
    )


def select_landed(schedules: DataFrame, pos: str, limit: int | None = None) -> DataFrame:
    """Operating flights, the landed ones if there are any, in input order."""
    chosen = filters.prefer(filters.drop_codeshares(schedules, pos), F.col("status") == "landed")
    return chosen if limit is None else caps.first_rows(chosen, [pos], limit)


def select_live(schedules: DataFrame, pos: str, limit: int | None = None) -> DataFrame:
    """Operating flights that are active, or else scheduled, in input order."""
    chosen = filters.first_available(
        filters.drop_codeshares(schedules, pos), "status", ["active", "scheduled"]
    )
    return chosen if limit is None else caps.first_rows(chosen, [pos], limit)


def run_schedules(chosen: DataFrame, folder: str) -> None:
    """The three outputs of a run: the chosen schedules, their delay map and their features."""
    kept = cut_lineage(chosen)
    save_run(
        {"schedules": kept, "delays": shape.empty_delay_map(kept), "features": schedule_features(kept)}, folder
    )
