"""Plans and layouts that matter on large tables, observed on small ones."""

import os

from pyspark.sql import functions as F

from tarmac.operators.lookup import lookup
from tarmac.operators.merge import merge_rows
from tarmac.session import clear_stages, cut_lineage, scratch_path
from tarmac.sources import tables


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_sides_are_broadcast_without_a_job(spark):
    facts = spark.range(100).withColumnRenamed("id", "k")
    dim = cut_lineage(spark.range(50).select(F.col("id").alias("d"), F.lit("x").alias("v")))
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    joined = lookup(facts, dim, "k", "d", {"v": "v"})
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_hot_key_of_an_unbroadcast_lookup_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        facts = spark.range(0, 30_000, 1, 8).select(F.when(F.col("id") % 10 < 8, -1).otherwise(F.col("id")).alias("k"), "id")
        dim = spark.range(-1, 30_000).select(F.col("id").alias("d"), (F.col("id") * 2).alias("v"))
        joined = lookup(facts, dim, "k", "d", {"v": "v"})
        assert "skew=true" in final_plan(joined)
        assert joined.where("v <> k * 2").count() == 0 and joined.count() == 30_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_stage_is_read_back_by_column(spark):
    staged = cut_lineage(spark.range(10).select("id", F.struct("id").alias("s")))
    plan = staged.select("id").where("id = 3")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan and "PushedFilters: [IsNotNull(id), EqualTo(id,3)]" in plan


def test_keyed_write_leaves_few_files_per_folder(spark):
    path = scratch_path(spark, "t")
    rows = spark.range(0, 2000, 1, 16).select(
        F.col("id").cast("string").alias("_id"), (F.col("id") % 3).cast("string").alias("day"), "id"
    )
    tables.upsert_table(rows, path, "_id", ["id"], "day")
    folders = [d for d in os.listdir(path.removeprefix("file:")) if d.startswith("day=")]
    files = [f for d in folders for f in os.listdir(f"{path.removeprefix('file:')}/{d}") if f.endswith(".parquet")]
    assert len(folders) == 3 and len(files) <= 6
    assert tables.read_table(spark, path).count() == 2000


def test_day_folders_stay_text(spark):
    path = scratch_path(spark, "t")
    rows = spark.createDataFrame([("k", "2026-04-18", 1)], "_id string, flight_date string, seq int")
    tables.upsert_table(rows, path, "_id", ["seq"], "flight_date")
    tables.upsert_table(rows, path, "_id", ["seq"], "flight_date")
    assert dict(tables.read_table(spark, path).dtypes)["flight_date"] == "string"


def test_versions_of_a_key_are_reduced_before_the_shuffle(spark):
    batch = spark.range(1000).select(F.when(F.col("id") % 3 < 2, "hot").otherwise("cold").alias("_id"), "id")
    plan = merge_rows(None, batch, "_id", ["id"])._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "partial_max_by" in below


def test_stages_are_removed_with_the_job(spark, tmp_path):
    staged = cut_lineage(spark.range(3))
    file = staged.inputFiles()[0].removeprefix("file://")
    kept = cut_lineage(spark.range(3), path=str(tmp_path / "own"))
    assert os.path.exists(file) and clear_stages(spark) >= 1
    assert not os.path.exists(file) and kept.count() == 3
