"""What queries with a state of their own share."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tarmac.session import workers_import_package

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rows pass a state as JSON text, with instants in full.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def prepare(spark: SparkSession) -> None:
    """State of this kind needs the RocksDB state store, which is made the session's for queries that start anew, and workers
    that find this package."""
    if spark.conf.get(_PROVIDER, "") != _ROCKS:
        spark.conf.set(_PROVIDER, _ROCKS)
    workers_import_package(spark)


def packed(columns: list[str]) -> Column:
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), _JSON)


def unpacked(text: str, schema) -> Column:
    return F.from_json(text, schema, _JSON)
