"""Row filters, including those whose outcome depends on other rows."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.text import present


def all_present(*columns: str) -> Column:
    """Every listed (possibly nested) column is neither null nor empty."""
    return reduce(and_, [present(F.col(c)) for c in columns])


def landed_flights(df: DataFrame, needed: list[str], status: str = "flight_status") -> DataFrame:
    """Finished flights whose ``needed`` nested fields are filled in."""
    return df.where((F.col(status) == "landed") & all_present(*needed))


def not_empty(column: str, nulls: str = "drop") -> Column:
    """``!= ''``. By default nulls are refused too; ``nulls="keep"`` lets them pass, as a store
    does when only the comparison with the empty string reaches it."""
    value = F.col(column)
    return present(value) if nulls == "drop" else value.isNull() | (value != "")


def on_day(df: DataFrame, day: str, column: str = "flight_date") -> DataFrame:
    return df.where(F.col(column) == F.lit(day))


def with_status(df: DataFrame, statuses: list[str], column: str = "flight_status") -> DataFrame:
    return df.where(F.col(column).isin(statuses))


def drop_codeshares(df: DataFrame, pos: str, code: str = "flight_iata", shared: str = "cs_flight_iata") -> DataFrame:
    """Keep operating flights only.

    Rows without a code are dropped and register nothing. A codeshare row is dropped and registers
    the code it shares; an operating row is dropped if its code was registered at a smaller
    ``pos``. Registrations are reduced to one row per code before the join.
    """
    coded = df.where(F.col(code).isNotNull())
    registered = (
        coded.where(F.col(shared).isNotNull())
        .groupBy(F.col(shared).alias("registered_code"))
        .agg(F.min(pos).alias("registered_at"))
    )
    operating = coded.where(F.col(shared).isNull())
    joined = operating.join(registered, F.col(code) == F.col("registered_code"), "left")
    late = F.col("registered_at") < F.col(pos)
    return joined.where(F.coalesce(~late, F.lit(True))).drop("registered_code", "registered_at")


def _any_row(df: DataFrame, condition: Column) -> Column:
    """Does any row meet the condition? One number per partition, one value overall."""
    return df.agg(F.coalesce(F.bool_or(condition), F.lit(False))).scalar()


def prefer(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that meet the condition if there are any, otherwise all rows."""
    return df.where(F.coalesce(condition, F.lit(False)) | ~_any_row(df, condition))


def first_available(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Rows with the first of ``values`` that occurs at all; none if none occurs."""
    found = df.agg(
        F.coalesce(*[F.max(F.when(F.col(column) == v, F.lit(v))) for v in values])
    ).scalar()
    return df.where(F.col(column) == found)


def with_target(df: DataFrame, target: str) -> DataFrame:
    return df.dropna(subset=[target])


def any_null(df: DataFrame) -> DataFrame:
    """One row: is there a null anywhere in the frame?"""
    nulls = reduce(or_, [F.col(f"`{c}`").isNull() for c in df.columns])
    return df.agg(F.coalesce(F.bool_or(nulls), F.lit(False)).alias("any_null"))
