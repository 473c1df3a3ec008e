import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tarmac.operators.nearest import nearest_join

T0 = datetime(2026, 1, 1)


def brute(left, obs, tolerance=None):
    """Nearest per left row by direct comparison: distance, then earlier instant, then smallest id."""
    out = {}
    for row_id, city, ts in left:
        best = None
        for obs_id, name, at, value in obs:
            if city is None or ts is None or name != city or at is None:
                continue
            if tolerance is not None and abs(at - ts) > timedelta(hours=tolerance):
                continue
            rank = (abs(at - ts), at, obs_id)
            if best is None or rank < best[0]:
                best = (rank, obs_id, value, at)
        out[row_id] = best[1:] if best else (None, None, None)
    return out


def run(spark, left, obs, **options):
    l = spark.createDataFrame(left, "id long, city string, ts timestamp")
    o = spark.createDataFrame(obs, "oid long, name string, at timestamp, value double")
    joined = nearest_join(
        l, o, left_key="city", left_time="ts", key="name", time="at", row_id="oid",
        payload={"oid": "match_id", "value": "match_value"}, matched_time="match_at", **options,
    )
    collected = joined.collect()
    assert len(collected) == len(left)
    return {r.id: (r.match_id, r.match_value, r.match_at) for r in collected}


def sample(seed, n=120, m=60, span=600, cities=("a", "b", "hot", None)):
    rng = random.Random(seed)
    city = lambda: rng.choice(cities + ("hot",) * 4)
    when = lambda: None if rng.random() < 0.05 else T0 + timedelta(minutes=rng.randrange(span))
    left = [(i, city(), when()) for i in range(n)]
    obs = [(1000 + i, city(), when(), float(i)) for i in range(m)]
    rng.shuffle(obs)
    return left, obs


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("options", [{}, {"bucket_hours": 1}, {"bucket_hours": 1, "spread": 3}])
def test_equals_brute_force(spark, seed, options):
    # The short span makes equal instants and equal distances common.
    left, obs = sample(seed, span=600 if seed % 2 else 40)
    assert run(spark, left, obs, **options) == brute(left, obs)


def test_left_rows_of_one_instant_are_parted(spark):
    l = spark.createDataFrame([(7, "hot", T0)] * 4000, "id long, city string, ts timestamp").repartition(4)
    o = spark.createDataFrame([(i, "hot", T0 + timedelta(minutes=i - 30), 1.0) for i in range(20)], "oid long, name string, at timestamp, v double")
    joined = nearest_join(
        l, o, left_key="city", left_time="ts", key="name", time="at", row_id="oid", payload={"oid": "m"}, spread=16
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = joined.withColumn("part", F.spark_partition_id()).groupBy("part").agg(F.count("*").alias("n"), F.min("m").alias("m")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(p.n for p in parts) == 4000 and max(p.n for p in parts) < 2500 and {p.m for p in parts} == {19}


@pytest.mark.parametrize("hours", [24, 1])
def test_many_observations_of_one_instant(spark, hours):
    # Sixty observations share two instants, hours apart; the buckets between hold flights only.
    obs = [(i, "hot", T0 + timedelta(hours=i % 2 * 4), float(i)) for i in range(60, 0, -1)]
    left = [(i, "hot", T0 + timedelta(minutes=10 * i - 100)) for i in range(60)]
    assert run(spark, left, obs, bucket_hours=hours) == brute(left, obs)


@pytest.mark.parametrize("hours", [24, 1])
def test_tolerance_is_closed(spark, hours):
    obs = [(1, "a", T0, 1.0)] + [(i, "hot", T0 + timedelta(days=i), 0.0) for i in range(2, 30)]
    left = [(1, "a", T0 + timedelta(hours=6)), (2, "a", T0 + timedelta(hours=6, seconds=1)), (3, "none", T0)]
    left += [(i, "hot", T0 + timedelta(days=i, hours=i % 9)) for i in range(4, 30)]
    result = run(spark, left, obs, tolerance_hours=6, bucket_hours=hours)
    assert result == brute(left, obs, 6)
    assert result[1][0] == 1 and result[2][0] is None


def test_tie_goes_to_the_earlier_observation(spark):
    obs = [(5, "a", T0, 5.0), (1, "a", T0 + timedelta(hours=2), 1.0)]
    assert run(spark, [(1, "a", T0 + timedelta(hours=1))], obs)[1][0] == 5


def test_copies_of_rows_are_kept(spark):
    left = [(7, "hot", T0)] * 50
    obs = [(1, "hot", T0 + timedelta(minutes=3), 1.0)] * 40
    l = spark.createDataFrame(left, "id long, city string, ts timestamp").repartition(8)
    o = spark.createDataFrame(obs, "oid long, name string, at timestamp, value double").repartition(8)
    joined = nearest_join(
        l, o, left_key="city", left_time="ts", key="name", time="at", row_id="oid", payload={"value": "v"}, bucket_hours=1
    )
    assert [r.v for r in joined.collect()] == [1.0] * 50


def test_each_input_is_read_and_shuffled_once(spark, tmp_path):
    left, obs = sample(1)
    spark.createDataFrame(left, "id long, city string, ts timestamp").write.parquet(f"{tmp_path}/left_rows")
    spark.createDataFrame(obs, "oid long, name string, at timestamp, value double").write.parquet(f"{tmp_path}/observed_rows")
    l, o = spark.read.parquet(f"{tmp_path}/left_rows"), spark.read.parquet(f"{tmp_path}/observed_rows")
    joined = nearest_join(
        l, o, left_key="city", left_time="ts", key="name", time="at", row_id="oid", payload={"value": "v"}, bucket_hours=1
    )
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # The summary reads the shuffle of the rows again; its own two shuffles hold one row per bucket.
    assert "ReusedExchange" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert plan.count("FileScan") == 2
    assert plan.count("REPARTITION_BY_COL") == 2 and plan.count("Exchange hashpartitioning") <= 4
