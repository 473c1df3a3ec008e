"""Table maintenance on plain files: snapshots, exports, copies and keyed writes.

Keyed writes rewrite only the partitions a batch touches. The merged rows are first written below the table itself, in
``_pending``, which no reader sees; the overwrite then never reads the files it replaces. A write that stopped while folders were being
replaced is finished from there by the next one. Columns that came later are read from all files. One writer per table at a time.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.operators.merge import absent_rows, merge_rows
from tarmac.session import cut_lineage, drop_stage, free_shuffles, fresh_stage


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table with the columns of all its files; what a file lacks is null."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def read_if_exists(spark: SparkSession, path: str, folder: T.StructField | None = None) -> DataFrame | None:
    """The table at ``path``, or None when nothing has been written there yet.

    ``folder`` states the type of the folder column; otherwise a session may guess it and read
    the text ``01`` as the number 1.
    """
    try:
        df = read_table(spark, path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    if folder is None:
        return df
    declared = T.StructType([folder if f.name == folder.name else f for f in df.schema.fields])
    return spark.read.schema(declared).parquet(path)


def stamp(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Add the ingestion time; pass a literal to make a run reproducible."""
    return df.withColumn("collected_at", F.current_timestamp() if at is None else at)


# ---- snapshots and exports ----------------------------------------------------------------


def save_snapshot(df: DataFrame, path: str) -> None:
    """Replace a JSON-lines snapshot."""
    df.write.mode("overwrite").json(path)


def _iso_text(value: Column) -> Column:
    fraction = F.nullif(F.date_format(value, ".SSSSSS"), F.lit(".000000"))
    return F.concat(F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss"), F.coalesce(fraction, F.lit("")))


def _json_ready(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return _iso_text(value)
    if isinstance(kind, T.StructType):
        parts = [_json_ready(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: _json_ready(item, kind.elementType))
    return value


def json_ready(df: DataFrame, id_column: str = "_id") -> DataFrame:
    """Timestamps at any depth as ISO-8601 text, the row id as text; other values unchanged."""
    columns = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        out = value.cast("string") if field.name == id_column else _json_ready(value, field.dataType)
        columns.append(out.alias(field.name))
    return df.select(*columns)


def export_json(df: DataFrame, path: str, id_column: str = "_id") -> None:
    """Export as UTF-8 JSON lines, non-ASCII text unescaped."""
    json_ready(df, id_column).write.mode("overwrite").json(path)


def save_run(outputs: dict[str, DataFrame], folder: str) -> None:
    """Write several results of one run, each below ``folder`` under its name."""
    for name, df in outputs.items():
        save_snapshot(df, f"{folder}/{name}")


# ---- keyed writes -------------------------------------------------------------------------


PENDING = "_pending"


def _pending(spark: SparkSession, path: str):
    """The file system and path of the folder for merged rows."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{PENDING}")
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _is_complete(spark: SparkSession, path: str) -> bool:
    system, place = _pending(spark, path)
    return system.exists(place.suffix("/_SUCCESS"))


def _drop_pending(spark: SparkSession, path: str) -> None:
    system, place = _pending(spark, path)
    system.delete(place, True)


def _replace_folders(merged: DataFrame, path: str, partition_by: str) -> None:
    """Rows are gathered by target folder before the write: adaptive execution merges small folders
    into one task and splits a folder that holds most of the rows, so file sizes stay even."""
    gathered = merged.drop("merge_action").hint("rebalance", F.col(partition_by))
    writer = gathered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition_by).parquet(path)


def recover(spark: SparkSession, path: str, partition_by: T.StructField) -> None:
    """Finish a write that stopped: complete merged rows replace their folders, incomplete ones are dropped."""
    if _is_complete(spark, path):
        merged = spark.read.parquet(f"{path}/{PENDING}")
        kinds = [partition_by if f.name == partition_by.name else f for f in merged.schema.fields]
        _replace_folders(spark.read.schema(T.StructType(kinds)).parquet(f"{path}/{PENDING}"), path, partition_by.name)
    _drop_pending(spark, path)


def _touched(path: str, batch: DataFrame, partition_by: str) -> DataFrame | None:
    """The stored rows of the folders the batch touches, or None without a table.

    The batch's folder values meet the table in a semi-join on the folder column, by which Spark prunes the
    scan; nothing is collected. Null and empty values share the default folder, which reads back as null.
    """
    target = read_if_exists(batch.sparkSession, path, batch.schema[partition_by])
    if target is None:
        return None
    folder = batch.select(F.nullif(F.col(partition_by).cast("string"), F.lit("")).alias("text"), F.col(partition_by).alias("touched"))
    named = folder.where("text is not null").select("touched").distinct()
    nameless = folder.agg(F.bool_or(F.col("text").isNull()).alias("any")).scalar()
    at_default = target.where(F.col(partition_by).isNull() & F.coalesce(nameless, F.lit(False)))
    # A row per folder, of which the writer makes or lists each; without the hint the whole table may be shuffled for them.
    return target.join(F.broadcast(named), F.col(partition_by) == F.col("touched"), "left_semi").unionByName(at_default)


def upsert_table(
    batch: DataFrame, path: str, key: str, order: list[str], partition_by: str, stage: str | None = None
) -> DataFrame:
    """Merge a batch into the table by ``key``; returns the number of rows per action.

    The last known value of each column wins; columns the batch leaves null keep their stored
    value, and so do columns it does not have; nested structs are replaced whole. ``partition_by`` must be a function of the key.
    The batch is evaluated once, into ``stage``; a stream reuses one folder for all its batches. Without one the batch is dropped
    once it is merged, and the space of each step's shuffles is given back before the next one.
    """
    spark, field = batch.sparkSession, batch.schema[partition_by]
    recover(spark, path, field)
    own = fresh_stage(spark) if stage is None else None
    batch = _step(batch, own or stage, own)
    merged = _step(merge_rows(_touched(path, batch, partition_by), batch, key, order), f"{path}/{PENDING}", own)
    if own:
        drop_stage(spark, own)
    _replace_folders(merged, path, partition_by)
    # At most three rows; they are fetched here because the merged rows go.
    counts = merged.groupBy("merge_action").agg(F.count("*").alias("rows")).collect()
    _drop_pending(spark, path)
    if own:
        free_shuffles(spark)
    return spark.createDataFrame(counts, "merge_action string, rows long")


def _step(df: DataFrame, path: str, free: str | None) -> DataFrame:
    stored = cut_lineage(df, path=path)
    if free:
        free_shuffles(df.sparkSession)
    return stored


def insert_if_absent(
    batch: DataFrame, path: str, key: str, order: list[str], partition_by: str, stage: str | None = None
) -> DataFrame:
    """Append the rows whose key the table does not hold; returns saved and skipped counts.

    The batch is evaluated once. An append is one commit of the file writer: a repeat after a stop adds what is missing.
    """
    recover(batch.sparkSession, path, batch.schema[partition_by])
    batch = cut_lineage(batch, path=stage)
    fresh = cut_lineage(absent_rows(_touched(path, batch, partition_by), batch, key, order), path=stage and f"{stage}-fresh")
    gathered = fresh.hint("rebalance", F.col(partition_by))
    gathered.write.mode("append").partitionBy(partition_by).parquet(path)
    offered = batch.agg(F.count("*").alias("offered"))
    saved = fresh.agg(F.count("*").alias("saved"))
    return saved.select("saved", (offered.scalar() - F.col("saved")).alias("skipped"))


# ---- copies -------------------------------------------------------------------------------


def copy_rows(source: DataFrame, path: str, id_column: str = "_id") -> None:
    """Append rows to another table without their id; duplicates are allowed."""
    source.drop(id_column).write.mode("append").parquet(path)


def replace_table(source: DataFrame, path: str, id_column: str = "_id") -> None:
    """Replace a table's content by another table's rows, without their id."""
    source.drop(id_column).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def create_if_missing(spark: SparkSession, table: str, schema_ddl: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema_ddl}) USING parquet")


def copy_namespace(spark: SparkSession, source: str, target: str, id_column: str = "_id") -> list[str]:
    """Append every non-empty table of one database to the same name in another."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {target}")
    copied = []
    for table in sorted(t.name for t in spark.catalog.listTables(source) if not t.isTemporary):
        rows = spark.table(f"{source}.{table}").drop(id_column)
        if rows.isEmpty():
            continue
        rows.write.mode("append").saveAsTable(f"{target}.{table}")
        copied.append(table)
    return copied
