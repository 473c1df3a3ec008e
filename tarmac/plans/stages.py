"""Fitted preprocessing stages that ``pyspark.ml`` has no equal of."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class MostFrequentModel(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fills nulls of text columns with the values learnt in training."""

    fills = Param(Params._dummy(), "fills", "fill value per input column", TypeConverters.toListString)

    def __init__(self, inputCols: list[str] | None = None, fills: list[str] | None = None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=inputCols, fills=fills)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        pairs = zip(self.getInputCols(), self.getOrDefault(self.fills))
        return dataset.withColumns({name: F.coalesce(name, F.lit(value)) for name, value in pairs})


class DropFirst(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Index columns from a descending indexer with a bucket for unseen values, re-coded so that
    the encoder's dropped last category stands for both the first category and unseen values."""

    sizes = Param(Params._dummy(), "sizes", "number of known categories per column", TypeConverters.toListInt)

    def __init__(self, inputCols: list[str] | None = None, sizes: list[int] | None = None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=inputCols, sizes=sizes)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        # ``least`` builds a new column: the indexer's metadata, which still counts the bucket for
        # unseen values, does not reach the encoder.
        pairs = zip(self.getInputCols(), self.getOrDefault(self.sizes))
        return dataset.withColumns({c: F.least(F.col(c), F.lit(float(max(n - 1, 0)))) for c, n in pairs})
