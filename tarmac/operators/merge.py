"""Keyed merging of a batch into a target, as plain DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order(columns: list[str]) -> Column:
    # A single column stays bare, so that rows without a position are told apart from those with one.
    return F.struct(*columns) if len(columns) > 1 else F.col(columns[0])


def last_values(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Per key, the last non-null value of every column.

    This is what a sequence of "set the fields I have" writes leaves behind. Each map task
    reduces its own rows first, so a key with very many versions sends few rows to one reducer.
    """
    position = _order(order)
    values = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), position)).alias(c) for c in values]
    )


def last_rows(rows: DataFrame, key: str, order: list[str], payload: list[str] | None = None) -> DataFrame:
    """Per key, the row that comes last; rows with a null key are ignored."""
    kept = [c for c in rows.columns if c != key] if payload is None else payload
    picked = F.max_by(F.struct(*kept), _order(order))
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(picked.alias("row")).select(key, "row.*")


def first_rows_per_key(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Per key, the row that comes first."""
    kept = [c for c in rows.columns if c != key]
    picked = F.min_by(F.struct(*kept), _order(order))
    return rows.groupBy(key).agg(picked.alias("row")).select(key, "row.*")


def merge_rows(target: DataFrame | None, batch: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Upsert: target rows overlaid by the batch, with ``merge_action`` per row.

    Both sides are unique per key when they meet, so no key can be hot in the join.
    """
    fresh = last_values(batch, key, order)
    if target is None:
        return fresh.withColumn("merge_action", F.lit("inserted"))
    columns = target.columns + [c for c in fresh.columns if c not in target.columns]
    old = target.select(F.col(key), F.lit(True).alias("in_target"), F.struct(*target.columns).alias("old"))
    new = fresh.select(F.col(key), F.lit(True).alias("in_batch"), F.struct(*fresh.columns).alias("new"))

    def pick(name: str) -> Column:
        sides = [f"new.{name}"] * (name in fresh.columns) + [f"old.{name}"] * (name in target.columns)
        return F.coalesce(*sides).alias(name)

    action = (
        F.when(F.col("in_target").isNull(), "inserted").when(F.col("in_batch").isNull(), "kept").otherwise("updated")
    )
    joined = old.join(new, key, "full_outer")
    return joined.select(*[F.col(key) if c == key else pick(c) for c in columns], action.alias("merge_action"))


def absent_rows(target: DataFrame | None, batch: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Insert-if-absent: the first batch row of every key the target does not hold."""
    fresh = first_rows_per_key(batch, key, order)
    return fresh if target is None else fresh.join(target.select(key), key, "left_anti")
