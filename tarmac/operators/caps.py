"""Limits that are part of the job: newest rows, caps per group, caps across ordered groups.

``row_number() <= k`` is evaluated on each map task before the shuffle (window group limit), so a
group that holds most of the table still sends at most k rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tarmac.functions.text import or_unknown
from tarmac.session import cut_lineage

Ordering = list[str | Column]


def first_rows(df: DataFrame, ordering: Ordering, n: int) -> DataFrame:
    """The first ``n`` rows in input order (the position columns carry it)."""
    return df.orderBy(*ordering).limit(n)


def top_rows(df: DataFrame, column: str, n: int, ties: Ordering) -> DataFrame:
    """The ``n`` largest values, nulls last; ``ties`` makes the choice reproducible."""
    return df.orderBy(F.col(column).desc_nulls_last(), *ties).limit(n)


def newest(df: DataFrame, time: str, ties: Ordering, show: dict[str, str], n: int = 3) -> DataFrame:
    """The newest rows with the listed (nested) fields as text, ``N/A`` where unknown."""
    rows = df.orderBy(F.col(time).desc_nulls_last(), *ties).limit(n)
    return rows.select(*[or_unknown(F.col(path)).alias(name) for path, name in show.items()])


def cap_per_group(df: DataFrame, group: list[str], ordering: Ordering, cap: int) -> DataFrame:
    window = W.partitionBy(*group).orderBy(*ordering)
    ranked = df.withColumn("rank_in_group", F.row_number().over(window))
    return ranked.where(F.col("rank_in_group") <= cap).drop("rank_in_group")


def opening_cap(
    df: DataFrame, rank: str, ordering: Ordering, open_below: int | None = None, total: int | None = None
) -> DataFrame:
    """Groups are taken in ``rank`` order; a group contributes only if fewer than ``open_below``
    rows were taken before it. The result holds at most ``total`` rows. Without a limit it does not apply.

    Each non-empty group adds at least one row, so only the first ``open_below`` groups can ever
    open: the running sum and the broadcast side hold at most that many rows.
    """
    if open_below is not None:
        sizes = df.groupBy(rank).agg(F.count("*").alias("size")).orderBy(rank).limit(open_below)
        before = W.orderBy(rank).rowsBetween(W.unboundedPreceding, -1)
        opened = sizes.withColumn("taken_before", F.coalesce(F.sum("size").over(before), F.lit(0)))
        opened = opened.where(F.col("taken_before") < open_below).select(rank)
        df = df.join(F.broadcast(opened), rank, "left_semi")
    return df if total is None else df.orderBy(rank, *ordering).limit(total)


def priority_cap(
    df: DataFrame, request: list[str], ordering: Ordering, keep: Column, per_request: int | None = None,
    total: int | None = None,
) -> DataFrame:
    """Each request returns its first ``per_request`` rows; the filter applies afterwards, and
    the first ``total`` survivors in (request order, position) are taken. Without a limit it does not apply."""
    answered = df if per_request is None else cap_per_group(df, request, ordering, per_request)
    kept = answered.where(keep)
    return kept if total is None else kept.orderBy(*request, *ordering).limit(total)


def numbered(df: DataFrame, ordering: list[str], value: str) -> DataFrame:
    """Predictions as a list in input order: running number and value with two decimals.

    The numbering is distributed: rows are range-partitioned once and stored, each partition is
    numbered on its own, and the row counts of the partitions before it are added. Only those
    counts (one per partition) meet in one place.
    """
    ranged = df.select(*ordering, value).repartitionByRange(*ordering)
    stored = cut_lineage(ranged.withColumn("part", F.spark_partition_id()))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sizes = stored.groupBy("part").agg(F.count("*").alias("size"))
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(W.partitionBy("part").orderBy(*ordering))
    return stored.join(F.broadcast(offsets), "part").select(
        (within + F.col("offset")).alias("flight_no"), F.round(value, 2).alias("estimated_minutes")
    )
