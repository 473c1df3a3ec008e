"""The airport-code dimension. Users supply it as (seq, iata, city) rows; codes may repeat and
the entry with the highest ``seq`` wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DIMENSION_DDL = "seq INT, iata STRING, city STRING"


def last_wins(entries: DataFrame, code: str = "iata", value: str = "city", seq: str = "seq") -> DataFrame:
    return entries.groupBy(code).agg(F.max_by(value, seq).alias(value))


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header ``seq,iata,city``."""
    entries = spark.read.schema(DIMENSION_DDL).option("header", True).csv(path)
    return last_wins(entries)


def inline_dimension(spark: SparkSession, mapping: dict[str, str]) -> DataFrame:
    """A short mapping written in the job itself, for example a handful of airports."""
    return spark.createDataFrame(list(mapping.items()), "iata string, city string")
