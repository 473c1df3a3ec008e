"""Live flights enriched and scored while they arrive: stream-static joins, then the model.

``enrich_stream`` joins a snapshot of the weather taken when the query starts. ``enrich_batches`` takes a new one
for every micro-batch, so later flights meet the weather that was written in between.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tarmac.plans.linear import LinearModel
from tarmac.plans.models import score
from tarmac.plans.serving import serving_features
from tarmac.streaming.ingest import each_batch


def enrich_stream(
    flights: DataFrame, weather: DataFrame, dimension: DataFrame, weather_order: list[str], identity: list[str]
) -> DataFrame:
    """Serving features of a stream of flight documents."""
    return serving_features(flights, weather, dimension, weather_order, identity)


def score_stream(model: PipelineModel | LinearModel, features: DataFrame) -> DataFrame:
    """Clamped predictions for a stream of feature rows."""
    return score(model, features)


def enrich_batches(
    flights: DataFrame, read_weather: Callable[[], DataFrame], dimension: DataFrame, weather_order: list[str],
    identity: list[str], path: str, checkpoint: str, model: PipelineModel | LinearModel | None = None, available_now: bool = True,
) -> StreamingQuery:
    """Serving features (scored, if there is a model) of every micro-batch below ``path/batch_id=N``.

    ``read_weather`` is called for each batch; a replayed batch replaces its own folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        features = serving_features(batch, read_weather(), dimension, weather_order, identity)
        rows = features if model is None else score(model, features)
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return each_batch(flights, write, checkpoint, "append", available_now)
