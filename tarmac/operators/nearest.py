"""Nearest-in-time join: for every left row, the observation of the same key closest in time.

Both sides are stacked, shuffled once by (key, bucket of time) and sorted by time in each bucket; one running window carries the
latest earlier observation forward and a second, sorted the other way, carries the next later one back. Cost is one shuffle
of the rows and two sorts, never (left rows x observations) pairs. Two running frames are used
on purpose: a frame that looks at all following rows is re-evaluated per row.

A key may hold a large part of all rows, so the unit of work is never the key but the key in one bucket of time. What a bucket lacks,
the last observation before it and the first one after it, comes from a summary of one row per bucket. The summary reads the
shuffle that the windows read, so each input is evaluated once; it needs all columns of it on purpose, because a narrower
plan would be a shuffle of its own. Its rows are handed to the buckets that hold left rows by a join on the bucket, for which
the rows lie right already. Nothing is measured, stored or collected, and there is one plan for all sizes. Where very many left rows share
a key and one instant, which no bucket of time can part, ``spread`` deals the left rows of each bucket over as many shares, each of which
meets all observations of the bucket; equal left rows are parted, too.

Ties: the earlier observation wins; among observations of one instant the smallest id wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKET_HOURS = 24


def nearest_join(
    left: DataFrame,
    observations: DataFrame,
    *,
    left_key: str,
    left_time: str,
    key: str,
    time: str,
    row_id: str,
    payload: dict[str, str],
    matched_time: str | None = None,
    tolerance_hours: int | None = None,
    bucket_hours: int = BUCKET_HOURS,
    spread: int = 1,
) -> DataFrame:
    """Left join to the nearest observation.

    ``payload`` maps observation column -> output column. Rows of ``left`` without key, time or
    any observation get nulls. With ``tolerance_hours`` a match further away (closed bound) is
    dropped to null, which is exact: the nearest overall is the nearest within the bound.
    """
    stacked = _stack(left, observations, left_key, left_time, key, time, row_id, payload, bucket_hours, spread)
    points = stacked.repartition("bucket")
    chosen = _carry_both_ways(points).where("kind = 1").join(_handed(points), "bucket", "left")

    pick = _closer()
    if tolerance_hours is not None:
        limit = F.lit(tolerance_hours * 3_600_000_000)
        pick = F.when(F.abs(pick.getField("t") - F.col("t")) <= limit, pick)
    picked = chosen.select("row", pick.alias("match"))
    out = [F.col(f"match.payload.{name}").alias(name) for name in payload.values()]
    if matched_time:
        out.append(F.timestamp_micros(F.col("match.t")).alias(matched_time))
    return picked.select("row.*", *out)


def _stack(left, observations, left_key, left_time, key, time, row_id, payload, bucket_hours, spread) -> DataFrame:
    """Both inputs in one shape: bucket (key k, number s and share r), instant t (microseconds), kind (0 observation, 1 left row),
    observation id and payload, left row.

    The bucket is one struct, never null itself, so no join asks for keys that are not null: such a filter would reach the summary's
    copy of this plan alone and make a second shuffle of it.
    """

    def micros(name: str) -> Column:
        return F.unix_micros(F.col(name).cast("timestamp"))

    def number(name: str) -> Column:
        return F.floor(micros(name) / F.lit(bucket_hours * 3_600_000_000)).cast("int")

    every = F.explode(F.sequence(F.lit(0), F.lit(spread - 1))) if spread > 1 else F.lit(0)
    seen = observations.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        F.col(key).alias("k"),
        number(time).alias("s"),
        micros(time).alias("t"),
        F.col(row_id).alias("id"),
        F.struct(*[F.col(old).alias(new) for old, new in payload.items()]).alias("payload"),
        every.alias("r"),
    )
    seen = seen.select(F.struct("k", "s", "r").alias("bucket"), "t", F.lit(0).alias("kind"), "id", "payload")
    # Left rows that cannot match must not pile up under one null key: they are spread over as
    # many groups as there are input partitions.
    matchable = F.col(left_key).isNotNull() & F.col(left_time).isNotNull()
    share = F.pmod(F.monotonically_increasing_id(), F.lit(spread)).cast("int") if spread > 1 else F.lit(0)
    own = F.when(matchable, number(left_time)).otherwise(-1 - F.spark_partition_id())
    asked = left.select(
        F.struct(F.when(matchable, F.col(left_key)).alias("k"), own.alias("s"), share.alias("r")).alias("bucket"),
        F.when(matchable, micros(left_time)).alias("t"),
        F.lit(1).alias("kind"),
        F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("row"),
    )
    return asked.unionByName(seen, allowMissingColumns=True)


def _handed(points: DataFrame) -> DataFrame:
    """For each bucket with left rows the observations that bound it from outside: ``from_before`` and ``from_after``."""
    seen = F.when(F.col("kind") == 0, F.struct("t", "payload"))
    first = F.min_by(seen, F.when(F.col("kind") == 0, F.struct("t", "id")))
    last = F.min_by(seen, F.when(F.col("kind") == 0, F.struct(-F.col("t"), F.col("id"))))
    edges = points.groupBy("bucket").agg(first.alias("first"), last.alias("last"), F.count("row").alias("asked"))
    earlier = W.partitionBy("bucket.k", "bucket.r").orderBy("bucket.s").rowsBetween(W.unboundedPreceding, -1)
    later = W.partitionBy("bucket.k", "bucket.r").orderBy(F.col("bucket.s").desc()).rowsBetween(W.unboundedPreceding, -1)
    told = edges.select(
        "bucket",
        "asked",
        F.last("last", ignorenulls=True).over(earlier).alias("from_before"),
        F.last("first", ignorenulls=True).over(later).alias("from_after"),
    )
    useful = (F.col("asked") > 0) & (F.col("from_before").isNotNull() | F.col("from_after").isNotNull())
    return told.where(useful).drop("asked")


def _carry_both_ways(points: DataFrame) -> DataFrame:
    group = W.partitionBy("bucket")
    up = group.orderBy("t", "kind", F.col("id").desc()).rowsBetween(W.unboundedPreceding, 0)
    down = group.orderBy(F.col("t").desc(), "kind", F.col("id").desc()).rowsBetween(W.unboundedPreceding, 0)
    # The windows take columns the rows carry anyway; a struct built here would be shuffled too.
    instant = F.when(F.col("kind") == 0, F.col("t"))
    return points.select(
        "bucket",
        "kind",
        "t",
        "row",
        F.last(instant, ignorenulls=True).over(up).alias("before_t"),
        F.last("payload", ignorenulls=True).over(up).alias("before"),
        F.last(instant, ignorenulls=True).over(down).alias("after_t"),
        F.last("payload", ignorenulls=True).over(down).alias("after"),
    )


def _closer() -> Column:
    """The closer of the two neighbours: those in the bucket, else those handed to it."""

    def neighbour(side: str) -> Column:
        inside = F.struct(F.col(f"{side}_t").alias("t"), F.col(side).alias("payload"))
        return F.when(F.col(f"{side}_t").isNotNull(), inside).otherwise(F.col(f"from_{side}"))

    t, before, after = F.col("t"), neighbour("before"), neighbour("after")
    use_before = before.isNotNull() & (after.isNull() | ((t - before["t"]) <= (after["t"] - t)))
    return F.when(use_before, before).otherwise(after)
