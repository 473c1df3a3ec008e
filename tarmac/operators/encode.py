"""One-hot codes by a dictionary table, for columns with any number of categories.

The distinct (column, value) pairs are numbered in tasks: dealt out by range and stored, each partition numbers its own and adds the sizes
of those before it. The dictionary is joined back, column by column; Spark broadcasts it if it is small and otherwise
shuffles, with its rows unique per value, so hot values can be split. No list of labels reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tarmac.session import cut_lineage


def dictionary(rows: DataFrame, columns: list[str], drop_first: bool = False, descending: bool = False) -> DataFrame:
    """(name, value, slot): the slot of every value of ``rows``, column after column, values as text in their order.

    Nulls have no slot; with ``drop_first`` neither has the smallest value of each column.
    """
    pairs = [F.struct(F.lit(i).alias("at"), F.lit(c).alias("name"), F.col(f"`{c}`").cast("string").alias("value")) for i, c in enumerate(columns)]
    values = rows.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").where("value is not null").distinct()
    order = ["at", F.desc("value") if descending else F.asc("value")]
    stored = cut_lineage(values.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "dictionary")
    if drop_first:
        smallest = stored.groupBy("at").agg(F.min("value").alias("value"))
        stored = stored.join(smallest, ["at", "value"], "left_anti")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sizes = stored.groupBy("part").agg(F.count("*").alias("size"))
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(W.partitionBy("part").orderBy(*order)) - 1
    # One offset per partition.
    numbered = stored.withColumn("within", within).join(F.broadcast(offsets), "part")
    return cut_lineage(numbered.select("name", "value", (F.col("offset") + F.col("within")).alias("slot")), "dictionary")


def one_hot(rows: DataFrame, codes: DataFrame, columns: list[str], into: str = "slots") -> DataFrame:
    """``rows`` with the sorted slots at which their one-hot vector is 1; values without a slot add none."""
    out = rows.select("*")
    found = []
    for i, name in enumerate(columns):
        side = codes.where(F.col("name") == name).select(F.col("value").alias(f"{into}_value{i}"), F.col("slot").alias(f"{into}_slot{i}"))
        out = out.join(side, F.col(f"`{name}`").cast("string") == F.col(f"{into}_value{i}"), "left")
        found.append(F.col(f"{into}_slot{i}"))
    slots = F.array_sort(F.array_compact(F.array(*found)))
    return out.select(*[f"`{c}`" for c in rows.columns], slots.alias(into))
