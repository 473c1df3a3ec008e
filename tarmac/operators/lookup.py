"""Equality joins against dimensions and snapshots.

The other side is unique per key. Spark broadcasts it if its files or, at run time, its shuffled rows are small; otherwise
the join shuffles and adaptive execution splits the partitions of hot keys, for which a unique other side is enough. No
pass over the data is made to choose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.times import each_day

def lookup(
    facts: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dim_key: str,
    values: dict[str, str],
    how: str = "left",
) -> DataFrame:
    """Bring dimension columns to the facts: ``values`` maps dimension column -> new name.

    ``dimension`` must be unique per ``dim_key``.
    """
    side = dimension.select(
        F.col(dim_key).alias("lookup_key"), *[F.col(old).alias(new) for old, new in values.items()]
    )
    return facts.join(side, F.col(fact_key) == F.col("lookup_key"), how).drop("lookup_key")


def known(facts: DataFrame, dimension: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Facts whose code the dimension holds."""
    side = dimension.select(F.col(dim_key).alias("lookup_key"))
    return facts.join(side, F.col(fact_key) == F.col("lookup_key"), "left_semi")


def unknown_codes(facts: DataFrame, dimension: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Codes the dimension lacks, with the number of facts that carry each.

    Facts are counted per code before the join, so the join sees one row per code.
    """
    codes = facts.where(F.col(fact_key).isNotNull()).groupBy(fact_key).agg(F.count("*").alias("rows"))
    side = dimension.select(F.col(dim_key).alias("lookup_key"))
    return codes.join(side, F.col(fact_key) == F.col("lookup_key"), "left_anti")


def cities_of(facts: DataFrame, dimension: DataFrame, code_columns: list[str], dim_key: str, city: str) -> DataFrame:
    """Distinct cities of the codes found in any of ``code_columns``; unknown codes drop out."""
    codes = facts.select(F.explode(F.array(*code_columns)).alias("code")).where("code is not null").distinct()
    return lookup(codes, dimension, "code", dim_key, {city: city}, "inner").select(city).distinct()


def coverage_grid(facts: DataFrame, members: DataFrame, member: str, day: str, first: str, last: str) -> DataFrame:
    """Facts per (day, member) over every day of a closed range, zero where there are none.

    The grid is an explode of the day list on each member row; facts are counted before the join.
    """
    days = F.explode(each_day(F.lit(first), F.lit(last)))
    grid = members.select(member).distinct().select(member, days.alias(day))
    counts = facts.groupBy(F.col(member), F.col(day).cast("date").alias(day)).agg(F.count("*").alias("n"))
    filled = grid.join(counts, [member, day], "left")
    return filled.select(member, day, F.coalesce("n", F.lit(0)).alias("n"))
