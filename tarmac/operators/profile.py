"""Column profiles, counts and scores. Every profile is one pass over the data, whatever the
number of columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.text import percent
from tarmac.session import cut_lineage


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, null_count, total), one row per column."""
    names = df.columns
    counts = df.agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(names)],
    )
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_count")) for i, c in enumerate(names)]
    )
    return counts.select("total", F.explode(pairs).alias("p")).select("p.*", "total")


def null_summary(df: DataFrame, show: int | None = None) -> DataFrame:
    """Columns with nulls and their percentage, two decimals, highest first; the first ``show``."""
    shares = null_counts(df).select(
        "column_name", "null_count", percent(F.col("null_count"), F.col("total")).alias("null_percent")
    )
    ranked = shares.where("null_percent > 0").orderBy(F.desc("null_percent"), "column_name")
    return ranked if show is None else ranked.limit(show)


def sparse_columns(df: DataFrame, threshold: float = 30.0) -> list[str]:
    """Names of columns whose rounded null percentage exceeds the threshold (one row per column)."""
    return [r[0] for r in null_summary(df).where(F.col("null_percent") > threshold).collect()]


def drop_sparse(df: DataFrame, threshold: float = 30.0) -> DataFrame:
    return df.drop(*sparse_columns(df, threshold))


def missing_share(df: DataFrame, column: str) -> DataFrame:
    missing = F.count_if(F.col(column).isNull())
    return df.agg(
        missing.alias("missing"), F.count("*").alias("total"), percent(missing, F.count("*")).alias("missing_percent")
    )


def value_counts(df: DataFrame, column: str, nulls: bool = False) -> DataFrame:
    rows = df if nulls else df.where(F.col(column).isNotNull())
    return rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.col(column).asc_nulls_last())


#: Values a sketch tracks per column.
TRACKED = 10_000


def _pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value) of every non-null value, as text."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("p")).select("p.*").where("value is not null")


def _best(pairs: DataFrame) -> DataFrame:
    """(column_name, mode, n) by counting every value of the pairs."""
    counted = pairs.groupBy("column_name", "value").agg(F.count("*").alias("n"))
    first = F.min(F.struct((-F.col("n")).alias("order"), "value"))
    return counted.groupBy("column_name").agg(first.alias("first")).select("column_name", F.col("first.value").alias("mode"), (-F.col("first.order")).alias("n"))


def modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, mode): most frequent non-null value, the smallest on a tie.

    Values are counted with an ordinary grouped count, so a column with very many distinct values
    is spread over the cluster; only the counts are then reduced to one value per column.
    """
    return _best(_pairs(df, columns)).drop("n")


def modes_of_many(df: DataFrame, columns: list[str], tracked: int = TRACKED, candidates: int = 100) -> DataFrame:
    """What :func:`modes` gives, for columns with very many values of which a few stand out.

    A sketch of frequent items, merged from all tasks, names candidates, those it is sure of beyond its error. The error is at most 2.7 times
    the rows over ``tracked``, so a value it does not name counts at most twice that, or, with all ``candidates`` named, what it tells of
    the last. Candidates alone are counted exactly. Where the best of them is beyond that bound, no other value can be the mode;
    columns in which none stands out are counted in full. Nothing is shuffled by value but for those.
    """
    sketch = [F.expr(f"approx_top_k(cast(`{c}` AS string), {candidates}, {tracked})").alias(f"s{i}") for i, c in enumerate(columns)]
    told = df.agg(*sketch, *[F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(columns)]).first()
    wanted, limits = [], []
    for i, c in enumerate(columns):
        items = [r for r in told[f"s{i}"] or [] if r["item"] is not None]
        last = items[-1]["count"] if len(items) >= candidates else 0
        wanted += [(c, r["item"]) for r in items]
        limits.append((c, float(max(8 * told[f"n{i}"] / tracked, last))))
    spark = df.sparkSession
    # At most ``candidates`` per column, and one limit.
    named = F.broadcast(spark.createDataFrame(wanted, "column_name string, value string"))
    bounds = F.broadcast(spark.createDataFrame(limits, "column_name string, bound double"))
    best = _best(_pairs(df, columns).join(named, ["column_name", "value"], "left_semi"))
    settled = cut_lineage(best.join(bounds, "column_name").where("n > bound").select("column_name", "mode"), "modes")
    sure = {r["column_name"] for r in settled.collect()}
    rest = [c for i, c in enumerate(columns) if c not in sure and told[f"n{i}"]]
    return settled.unionByName(modes(df, rest)) if rest else settled


def distinct_values(df: DataFrame, path: str, alias: str) -> DataFrame:
    """Distinct non-null values of a nested field."""
    return df.select(F.col(path).alias(alias)).where(F.col(alias).isNotNull()).distinct()


def distinct_union(frames: dict[str, DataFrame], alias: str) -> DataFrame:
    """Distinct non-null values of one column per frame, taken together."""
    parts = [df.select(F.col(column).alias(alias)) for column, df in frames.items()]
    return reduce(DataFrame.unionByName, parts).where(F.col(alias).isNotNull()).distinct()


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rows) of several tables; each count is one aggregate over no columns."""
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def inventory(spark: SparkSession) -> DataFrame:
    """Row counts of every table of every database in the catalog."""
    tables = {
        f"{db.name}.{t.name}": spark.table(f"{db.name}.{t.name}")
        for db in spark.catalog.listDatabases()
        for t in spark.catalog.listTables(db.name)
        if not t.isTemporary
    }
    if not tables:
        return spark.createDataFrame([], "table_name string, rows bigint")
    return row_counts(tables)


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def r2(df: DataFrame, label: str, prediction: str, by: list[str] | None = None) -> DataFrame:
    """Coefficient of determination, per group if ``by`` is given.

    One pass: the residual sum of squares and the label's central second moment, both of which
    Spark merges from partial aggregates without cancellation. A label without spread has nothing to
    explain: 1.0 if every prediction is right, else 0.0.
    """
    y, p = F.col(label), F.col(prediction)
    both = df.where(y.isNotNull() & p.isNotNull())
    residual = F.sum((y - p) * (y - p))
    spread = F.var_pop(y) * F.count(y)
    flat = F.when(residual == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    share = F.when(spread == 0, flat).otherwise(F.lit(1.0) - F.try_divide(residual, spread))
    return both.groupBy(*(by or [])).agg(share.alias("r2"), F.count("*").alias("rows"))
