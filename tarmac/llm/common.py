"""What several operators of this folder share."""

from __future__ import annotations

import os
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

import tarmac
from tarmac.session import cut_lineage

#: Words everywhere in this folder: runs of anything but space and the five ASCII line and tab characters.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows that a Python worker gets at once: few enough for very long texts, enough to make up for the transfer.
BATCH_ROWS = 500
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def text_of(column: str) -> Column:
    """The text, with a null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, however often the body names it.

    Catalyst may copy an expression to each place that uses it, inside lambdas too, where it would
    be computed for every element of an array.
    """
    return F.transform(F.array(value), body)[0]


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once, replacing those of the same names.

    A plain projection may be merged with what stands above it, and a filter on its columns is pushed
    below it, each time with a copy of the expressions. Rows made by a generator are not.
    """
    one = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.drop(*columns).select("*", F.inline(F.array(one)))


def shielded(operator):
    """Keep input columns apart from an operator's own.

    All helper columns of this folder begin with an underscore. Input columns that do are renamed on the way in, also where an argument
    names them, and back on the way out; without such columns the operator runs as it is.
    """

    @wraps(operator)
    def run(df: DataFrame, *args, **options) -> DataFrame:
        taken = [c for c in df.columns if c.startswith("_")]
        if not taken:
            return operator(df, *args, **options)
        prefix = "kept"
        while any(c.lower().startswith(prefix) for c in df.columns):
            prefix += "x"
        safe = {c: f"{prefix}{i}" for i, c in enumerate(taken)}

        def named(value):
            return safe.get(value, value) if isinstance(value, str) else value

        out = operator(df.withColumnsRenamed(safe), *map(named, args), **{k: named(v) for k, v in options.items()})
        return out.withColumnsRenamed({new: old for old, new in safe.items()})

    return run


def worker_path(spark: SparkSession) -> None:
    """Let Python workers of this session import this package, and give them batches that fit in memory.

    Executors that do not see this folder need the package installed or sent with ``--py-files``. The limit on
    the rows of a batch is a setting of the session; a lower one of the user's stays.
    """
    rows = int(spark.conf.get(_ARROW_ROWS))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set(_ARROW_ROWS, BATCH_ROWS)
    root = os.path.dirname(os.path.dirname(os.path.abspath(tarmac.__file__)))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def numbered(df: DataFrame, order: list[Column], into: str) -> DataFrame:
    """Number the rows from 0 in the given order, which must name each row once.

    Rows are dealt out by range and stored; each partition numbers its own rows and adds the sizes
    of those before it. Only one count per partition meets in one task.
    """
    keys = [c.alias(f"_order{i}") for i, c in enumerate(order)]
    names = [f"_order{i}" for i in range(len(order))]
    dealt = df.select("*", *keys).repartitionByRange(*names).withColumn("_part", F.spark_partition_id())
    stored = cut_lineage(dealt)
    sizes = stored.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(W.partitionBy("_part").orderBy(*names)) - 1
    return stored.join(F.broadcast(starts), "_part").withColumn(into, F.col("_start") + within).drop("_part", "_start", *names)
