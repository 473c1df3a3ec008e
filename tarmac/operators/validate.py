"""Checking feature rows against the typed contract before they are scored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.schemas import FEATURE_COLUMNS, REQUIRED_FEATURES, feature_type
from tarmac.session import cut_lineage


def _typed(name: str, stored: str) -> tuple[Column, Column]:
    """(value under the contract type, is the stored value acceptable?)"""
    raw = F.col(name)
    wanted = feature_type(name)
    if wanted == "string":
        return raw.cast("string"), F.lit(stored == "string")
    number = raw.try_cast("double")
    if wanted == "int":
        whole = number.isNotNull() & (number == F.floor(number))
        return F.when(whole, number).try_cast("int"), whole
    return number, number.isNotNull()


def check_rows(df: DataFrame) -> DataFrame:
    """Contract columns in contract types, plus ``reasons``: what is wrong with the row, empty if
    nothing is. Extra columns are ignored; absent ones count as missing."""
    stored = dict(df.dtypes)
    values, reasons = {}, []
    for name in FEATURE_COLUMNS:
        required = name in REQUIRED_FEATURES
        if name not in stored:
            values[name] = F.lit(None).cast(feature_type(name))
            if required:
                reasons.append(F.lit(f"missing:{name}"))
            continue
        value, fits = _typed(name, stored[name])
        values[name] = value
        problem = F.when(F.col(name).isNotNull() & ~fits, F.lit(f"type:{name}"))
        reasons.append(problem.when(F.col(name).isNull(), F.lit(f"missing:{name}")) if required else problem)
    kept = [c for c in df.columns if c not in values]
    checked = df.select(
        *[F.col(c) for c in kept],
        *[v.alias(n) for n, v in values.items()],
        F.array_compact(F.array(*reasons)).alias("reasons"),
    )
    return checked


def split_rows(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their reasons)."""
    checked = check_rows(df)
    return checked.where(F.size("reasons") == 0).drop("reasons"), checked.where(F.size("reasons") > 0)


def accepted_batch(df: DataFrame) -> DataFrame:
    """Strict mode: the whole batch if every row is valid, otherwise no row at all.

    The checked rows are stored, so that what made them runs once for the verdict and for the rows.
    """
    checked = cut_lineage(check_rows(df), "checked")
    flawed = checked.agg(F.count_if(F.size("reasons") > 0)).scalar()
    return checked.where(flawed == 0).drop("reasons")
