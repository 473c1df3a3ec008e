import json
import os
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tarmac.operators.merge import last_rows, merge_rows
from tarmac.session import scratch_path, shared_dir
from tarmac.sources import tables

DDL = "_id string, day string, a int, s STRUCT<x: INT, y: INT>, seq int"


def as_dict(df):
    return {r._id: (r.day, r.a, tuple(r.s) if r.s else None, r.seq) for r in df.collect()}


def apply_loop(store, batch):
    """Set-what-is-known, one row after another."""
    for key, day, a, s, seq in sorted(batch, key=lambda r: r[4]):
        old = store.get(key, (None,) * 4)
        store[key] = tuple(n if n is not None else o for n, o in zip((day, a, s, seq), old))
    return store


def batch(seed, n=60, keys=15):
    rng = random.Random(seed)
    maybe = lambda v: v if rng.random() < 0.6 else None
    out = []
    for i in range(n):
        key = rng.randrange(keys)
        out.append((f"k{key}", f"d{key % 3}", maybe(rng.randrange(9)), maybe((rng.randrange(9), maybe(1))), seed * 1000 + i))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_upsert_equals_the_loop(spark, seed):
    first, second = batch(seed), batch(seed + 10, keys=25)
    target = merge_rows(None, spark.createDataFrame(first, DDL), "_id", ["seq"]).drop("merge_action")
    merged = merge_rows(target, spark.createDataFrame(second, DDL), "_id", ["seq"])
    assert as_dict(merged) == apply_loop(apply_loop({}, first), second)


def test_structs_are_replaced_whole_and_nulls_keep_the_old_value(spark):
    target = spark.createDataFrame([("k", "d", 1, (1, 2), 0)], DDL)
    new = spark.createDataFrame([("k", "d", None, (9, None), 1)], DDL)
    row = merge_rows(target, new, "_id", ["seq"]).first()
    assert (row.a, tuple(row.s), row.merge_action) == (1, (9, None), "updated")


def test_columns_of_either_side_survive(spark):
    target = spark.createDataFrame([("k", "departure")], "_id string, role string")
    new = spark.createDataFrame([("k", "Paris", 1)], "_id string, city string, seq int")
    row = merge_rows(target, new, "_id", ["seq"]).first()
    assert (row.role, row.city) == ("departure", "Paris")


def test_upsert_table_rewrites_only_touched_partitions(spark):
    path = scratch_path(spark, "t")
    counts = lambda df: {r.merge_action: r["rows"] for r in df.collect()}
    first = [("k1", "d1", 1, None, 1), ("k2", "d2", 2, None, 2)]
    assert counts(tables.upsert_table(spark.createDataFrame(first, DDL), path, "_id", ["seq"], "day")) == {"inserted": 2}
    local = path.removeprefix("file:")
    before = {f for f in os.listdir(f"{local}/day=d2") if f.endswith(".parquet")}
    second = [("k1", "d1", 5, None, 3), ("k3", "d1", 7, None, 4)]
    for _ in range(2):  # replaying a batch changes nothing
        done = counts(tables.upsert_table(spark.createDataFrame(second, DDL), path, "_id", ["seq"], "day"))
        assert {k: v[1] for k, v in as_dict(tables.read_table(spark, path)).items()} == {"k1": 5, "k2": 2, "k3": 7}
    assert done == {"updated": 2}
    assert {f for f in os.listdir(f"{local}/day=d2") if f.endswith(".parquet")} == before


def test_insert_if_absent_keeps_the_first(spark):
    path = scratch_path(spark, "t")
    first = [("k1", "d1", 1, None, 1), ("k1", "d1", 2, None, 2)]
    saved = tables.insert_if_absent(spark.createDataFrame(first, DDL), path, "_id", ["seq"], "day").first()
    assert tuple(saved) == (1, 1)
    second = [("k1", "d1", 9, None, 3), ("k2", "d1", 3, None, 4)]
    saved = tables.insert_if_absent(spark.createDataFrame(second, DDL), path, "_id", ["seq"], "day").first()
    assert tuple(saved) == (1, 1)
    assert {k: v[1] for k, v in as_dict(tables.read_table(spark, path)).items()} == {"k1": 1, "k2": 3}


def test_last_rows_ignores_null_keys(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), (None, 3, "z")], "k string, seq int, v string")
    assert [tuple(r) for r in last_rows(df, "k", ["seq"], ["v"]).collect()] == [("a", None)]


def test_copies(spark, rows):
    path = scratch_path(spark, "copy")
    source = spark.createDataFrame([("k1", 1), ("k2", 2)], "_id string, v int")
    tables.copy_rows(source, path)
    tables.copy_rows(source, path)
    assert rows(tables.read_table(spark, path)) == [(1,), (1,), (2,), (2,)]
    tables.replace_table(source.where("v = 2"), path)
    assert rows(tables.read_table(spark, path)) == [(2,)]


def test_namespace_copy(spark, rows):
    for db in ("src", "dst"):
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    spark.sql("CREATE DATABASE src")
    tables.create_if_missing(spark, "src.full", "_id STRING, v INT")
    tables.create_if_missing(spark, "src.full", "_id STRING, v INT")
    tables.create_if_missing(spark, "src.empty", "_id STRING, v INT")
    spark.sql("INSERT INTO src.full VALUES ('a', 1), ('b', 2)")
    assert tables.copy_namespace(spark, "src", "dst") == ["full"]
    assert rows(spark.table("dst.full")) == [(1,), (2,)]


def test_export(spark):
    path = scratch_path(spark, "export")
    df = spark.createDataFrame(
        [(7, {"at": datetime(2026, 4, 18, 10, 35, 28, 113286)}, [datetime(2026, 1, 1)], "Québec"), (8, None, None, None)],
        "_id long, s STRUCT<at: TIMESTAMP>, l ARRAY<TIMESTAMP>, city string",
    )
    tables.export_json(df, path)
    lines = [json.loads(line.value) for line in spark.read.text(path).collect()]
    assert {"_id": "7", "s": {"at": "2026-04-18T10:35:28.113286"}, "l": ["2026-01-01T00:00:00"], "city": "Québec"} in lines
    assert any("Québec" in r.value for r in spark.read.text(path).collect())


def test_stamp_and_missing_tables(spark):
    assert tables.read_if_exists(spark, scratch_path(spark, "none")) is None
    fixed = F.lit("2026-01-01").cast("timestamp")
    assert tables.stamp(spark.range(1), fixed).first().collected_at == datetime(2026, 1, 1)
    assert shared_dir(spark).endswith("shared") or "shared/" in shared_dir(spark)


@pytest.mark.parametrize("guessing", ["true", "false"])
def test_folder_values_of_any_spelling(spark, guessing):
    before = spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled")
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", guessing)
    try:
        path = scratch_path(spark, "t")
        days = ["01", "2026-04-18", None, "", "1e3"]
        for seq, half in enumerate((range(0, 10), range(5, 15))):
            batch = spark.createDataFrame([(f"k{i}", days[i % 5], i, None, seq * 100 + i) for i in half], DDL)
            tables.upsert_table(batch, path, "_id", ["seq"], "day")
            assert tables.insert_if_absent(batch, path, "_id", ["seq"], "day").first().saved == 0
        got = [(r._id, r.seq) for r in spark.read.parquet(path).collect()]
        assert sorted(got) == sorted((f"k{i}", i if i < 5 else 100 + i) for i in range(15))
        assert "day=01" in os.listdir(path.removeprefix("file:")) and "day=1" not in os.listdir(path.removeprefix("file:"))
    finally:
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", before)


def keyed(spark, rows, columns):
    return spark.createDataFrame(rows, columns)


def test_columns_that_come_later_stay(spark, rows):
    path = scratch_path(spark, "t")
    tables.upsert_table(keyed(spark, [("a1", "A", 1, 10)], "_id string, day string, seq int, x int"), path, "_id", ["seq"], "day")
    tables.upsert_table(keyed(spark, [("b1", "B", 1, "ROLE")], "_id string, day string, seq int, y string"), path, "_id", ["seq"], "day")
    assert rows(tables.read_table(spark, path), "_id", "x", "y") == [("a1", 10, None), ("b1", None, "ROLE")]
    # A batch without the column leaves the stored value.
    tables.upsert_table(keyed(spark, [("b1", "B", 2, 7)], "_id string, day string, seq int, x int"), path, "_id", ["seq"], "day")
    tables.insert_if_absent(keyed(spark, [("a2", "A", 1, 2.5)], "_id string, day string, seq int, z double"), path, "_id", ["seq"], "day")
    assert rows(tables.read_table(spark, path), "_id", "x", "y", "z") == [("a1", 10, None, None), ("a2", None, None, 2.5), ("b1", 7, "ROLE", None)]


def test_a_stopped_write_is_finished_by_the_next(spark, rows, monkeypatch):
    path, ddl = scratch_path(spark, "t"), "_id string, day string, seq int, x int"
    tables.upsert_table(keyed(spark, [("a", "1", 1, 1), ("b", "2", 1, 1)], ddl), path, "_id", ["seq"], "day")

    def stop(merged, path, partition_by):
        # The folder is gone and its rows are only among the merged ones.
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/day=1")
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(tables, "_replace_folders", stop)
        with pytest.raises(RuntimeError):
            tables.upsert_table(keyed(spark, [("c", "1", 2, 3)], ddl), path, "_id", ["seq"], "day")
    assert rows(tables.read_table(spark, path), "_id") == [("b",)]
    for _ in range(2):
        tables.upsert_table(keyed(spark, [("c", "1", 2, 3)], ddl), path, "_id", ["seq"], "day")
        assert rows(tables.read_table(spark, path), "_id", "x") == [("a", 1), ("b", 1), ("c", 3)]


def test_null_and_empty_folders(spark, rows):
    path, ddl = scratch_path(spark, "t"), "_id string, day string, seq int"
    tables.upsert_table(keyed(spark, [("a", None, 1), ("b", "", 1), ("c", "1", 1)], ddl), path, "_id", ["seq"], "day")
    counts = tables.upsert_table(keyed(spark, [("a", None, 2), ("d", "", 2)], ddl), path, "_id", ["seq"], "day")
    assert rows(counts) == [("inserted", 1), ("kept", 1), ("updated", 1)]
    assert rows(tables.read_table(spark, path), "_id", "seq") == [("a", 2), ("b", 1), ("c", 1), ("d", 2)]


def test_an_upsert_leaves_no_staged_batch(spark, tmp_path, rows):
    import os

    from tarmac import session

    before, path = len(session._STAGES), str(tmp_path / "table")
    schema = "k string, day string, at int, v string"
    tables.upsert_table(spark.createDataFrame([("a", "x", 1, "1"), ("b", None, 1, "1"), ("c", "y", 1, "1")], schema), path, "k", ["at"], "day")
    again = spark.createDataFrame([("a", "x", 2, "2"), ("b", None, 2, "2"), ("d", "z", 2, "2"), ("d", "z", 3, None)], schema)
    counts = tables.upsert_table(again, path, "k", ["at"], "day")
    staged = session._STAGES[before:]
    assert len(staged) == 2 and not [p for p in staged if os.path.exists(p.removeprefix("file:"))]
    assert rows(counts, "merge_action", "rows") == [("inserted", 1), ("updated", 2)]
    assert rows(tables.read_table(spark, path), "k", "v") == [("a", "2"), ("b", "2"), ("c", "1"), ("d", "2")]
    # The folders of a batch are few and do not make the table's rows move.
    touched = tables._touched(path, again, "day")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in touched and "SortMergeJoin" not in touched


def test_folders_of_a_batch_are_broadcast_at_any_size(spark, tmp_path):
    path, limit = str(tmp_path / "table"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    batch = spark.createDataFrame([("a", "x", 1)], "k string, day string, at int")
    tables.upsert_table(batch, path, "k", ["at"], "day")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" not in tables._touched(path, batch, "day")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
