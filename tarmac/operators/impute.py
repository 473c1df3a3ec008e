"""Filling missing values. Fill values come from one aggregate over the frame they are fitted on;
they enter the plan as a scalar subquery, so nothing is collected and no join is planned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.operators.profile import modes


def fill_with_mode(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls of text columns become the column's mode (ties: smallest). A column without any
    value stays null."""
    table = modes(df, columns).agg(F.map_from_entries(F.collect_list(F.struct("column_name", "mode")))).scalar()
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.coalesce(c, F.try_element_at(table, F.lit(c)).cast(kinds[c])) for c in columns})


def fill_with_mean(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls of numeric columns become the column's mean."""
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in columns])).scalar()
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), means.getField(c)) for c in columns})
