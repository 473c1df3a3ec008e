"""Landing-zone readers: JSON arrays, provider envelopes, in-memory rows.

A JSON array or an envelope is one document per file, so a single task parses each file. That
suits provider responses (a page holds at most a hundred records); bulk tables should be stored
as JSON lines or Parquet, which split.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.schemas import FEATURES, FLIGHT, WEATHER


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that each hold one JSON array of documents."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files with one document per line; these split across tasks."""
    return spark.read.schema(schema).json(path)


def read_variants(spark: SparkSession, path: str, into: str = "doc") -> DataFrame:
    """JSON array files as one VARIANT per document: nothing has to be declared, and no field is lost. A file that holds no
    array gives no rows."""
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path)
    return files.select(F.explode(F.from_json("value", "ARRAY<VARIANT>", {"mode": "PERMISSIVE"})).alias(into))


def read_flights(spark: SparkSession, path: str) -> DataFrame:
    return read_json_array(spark, path, FLIGHT)


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    return read_json_array(spark, path, WEATHER)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return read_json_array(spark, path, FEATURES)


def _envelopes(
    spark: SparkSession, path: str, field: str, record: str, folders: dict[str, list[str]] | None = None
) -> DataFrame:
    files = spark.read.schema(f"{field} ARRAY<STRUCT<{record}>>").option("multiLine", True).json(path)
    for folder, values in (folders or {}).items():
        if folder in files.columns:
            files = files.where(F.col(folder).isin(values))
    return files.withColumn("source_file", F.col("_metadata.file_path"))


def unnest(df: DataFrame, field: str, keep: list[str] | None = None) -> DataFrame:
    """One row per array element with its position; rows with an empty or missing array vanish."""
    kept = [c for c in df.columns if c != field] if keep is None else keep
    element = df.schema[field].dataType.elementType
    if not isinstance(element, T.StructType):
        return df.select(*kept, F.posexplode(field).alias("pos", "element"))
    # A folder column that repeats a field of the record gives way to the record's own value.
    kept = [c for c in kept if c not in element.fieldNames()]
    return df.select(*kept, F.posexplode(field).alias("pos", "element")).select(*kept, "pos", "element.*")


def read_envelope(
    spark: SparkSession, path: str, record: str, field: str = "data", folders: dict[str, list[str]] | None = None
) -> DataFrame:
    """Records of ``{field: [...]}`` files with ``source_file`` and ``pos``.

    Folders named ``airport=CDG`` and the like become columns; ``folders`` names the values to be read of
    those that exist, so files of other folders are not opened. Order within
    the run is carried explicitly, because rows of a DataFrame have none.
    """
    return unnest(_envelopes(spark, path, field, record, folders), field)


def files_without(spark: SparkSession, path: str, record: str, field: str = "response") -> DataFrame:
    """Report of the files that do not hold ``field`` at all (a provider's error answer)."""
    return _envelopes(spark, path, field, record).where(F.col(field).isNull()).select("source_file")


def parse_documents(df: DataFrame, column: str, schema: str) -> DataFrame:
    """JSON texts of a column as rows under a declared schema; a text that is no document gives a row of nulls."""
    return df.select(F.from_json(column, schema).alias("doc")).select("doc.*")


def as_frame(spark: SparkSession, data, schema: str) -> DataFrame:
    """A DataFrame as it is, or a list of dicts under a declared schema; anything else is refused.

    The dicts pass through JSON, so absent keys become null and whole numbers fit double fields.
    """
    if isinstance(data, DataFrame):
        return data
    if isinstance(data, list) and all(isinstance(row, dict) for row in data):
        texts = [(json.dumps(row, default=lambda v: v.isoformat() if hasattr(v, "isoformat") else str(v)),) for row in data]
        return parse_documents(spark.createDataFrame(texts, "doc string"), "doc", schema)
    raise TypeError("expected a DataFrame or a list of dicts")
