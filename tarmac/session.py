"""Session construction and the shared folder used for checkpoints and staged tables."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Instants are compared across tables, so the session zone is
# pinned; AQE resizes partitions, splits skewed join partitions and switches join strategies.
# The JVM never compiles a method of more than 8000 bytes, so larger generated stages would run
# interpreted; below that limit Spark falls back to one compiled expression per column.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Folder values stay text: a day column must not turn into a date on the way through a table.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build_session(app_name: str = "tarmac", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster that would be a
    machine-local path, so a missing setting is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tarmac-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder for one staged table or stream."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def workers_import_package(spark: SparkSession) -> None:
    """Let Python workers of this session import this package, wherever the driver was started.

    Executors that do not see this folder need the package installed or sent with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


#: Folders this process has staged tables in, until the job that wrote them ends.
_STAGES: list[str] = []


def clear_stages(spark: SparkSession) -> int:
    """Remove the staged tables of this process; returns how many. Results that still read them are gone, too."""
    paths, _STAGES[:] = list(_STAGES), []
    for path in paths:
        drop_stage(spark, path)
    return len(paths)


def drop_stage(spark: SparkSession, path: str) -> None:
    """Remove a staged table, or a part of it, that nothing reads any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def fresh_stage(spark: SparkSession, label: str = "stage") -> str:
    """A fresh path for a staged table, which :func:`clear_stages` removes."""
    path = scratch_path(spark, label)
    _STAGES.append(path)
    return path


def staged_by(df: DataFrame, column: str, label: str = "stage") -> str:
    """Write ``df`` to the shared folder, rows of each value of the column in a folder ``column=value``; returns the folder of all."""
    path = fresh_stage(df.sparkSession, label)
    df.write.partitionBy(column).parquet(path)
    return path


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the files of shuffles that no plan in use reads any more.

    It does so once the driver has collected their handles, which may be long after a large step is over.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def cut_lineage(df: DataFrame, label: str = "stage", path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that using it again never re-runs
    the plan above it. The files are columnar, outlive any executor, and later steps read only
    the columns they need. Repeating jobs give a ``path`` of their own, which each run replaces.
    """
    if path is None:
        path = fresh_stage(df.sparkSession, label)
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
