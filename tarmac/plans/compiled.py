"""Fitted pipelines as column expressions.

The stages of :mod:`tarmac.plans.models` and a linear model, a forest or boosted trees become conditions and arithmetic over the input
columns: fills are coalesced, a one-hot slot is a comparison with its category, a tree is nested cases. The plan then
holds no vectors and no extra columns, only one projection, in batch or stream.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import ImputerModel, OneHotEncoderModel, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, LinearRegressionModel, RandomForestRegressionModel
from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.plans.stages import DropFirst, MostFrequentModel


class _Inputs:
    """What each intermediate column of the pipeline stands for."""

    def __init__(self):
        self.fills: dict[str, str] = {}
        self.labels: dict[str, tuple[str, list[str]]] = {}
        self.slots: dict[str, tuple[str, list[str]]] = {}
        self.numbers: dict[str, tuple[str, float]] = {}
        self.features: list[tuple[str, str | float]] = []

    def read(self, stage) -> None:
        if isinstance(stage, MostFrequentModel):
            self.fills |= dict(zip(stage.getInputCols(), stage.getOrDefault(stage.fills)))
        elif isinstance(stage, StringIndexerModel):
            for source, out, labels in zip(stage.getInputCols(), stage.getOutputCols(), stage.labelsArray):
                self.labels[out] = (source, list(labels))
        elif isinstance(stage, DropFirst):
            # The last of the descending labels shares its slot with unseen values, which the encoder drops.
            self.labels |= {c: (self.labels[c][0], self.labels[c][1][:-1]) for c in stage.getInputCols()}
        elif isinstance(stage, OneHotEncoderModel):
            self.slots |= {out: self.labels[c] for c, out in zip(stage.getInputCols(), stage.getOutputCols())}
        elif isinstance(stage, ImputerModel):
            means = stage.surrogateDF.first()
            self.numbers |= {out: (c, float(means[c])) for c, out in zip(stage.getInputCols(), stage.getOutputCols())}
        elif isinstance(stage, VectorAssembler):
            for name in stage.getInputCols():
                if name in self.slots:
                    source, labels = self.slots[name]
                    self.features += [(source, label) for label in labels]
                elif name in self.numbers:
                    self.features.append(self.numbers[name])
                else:
                    raise TypeError(f"no stage makes {name}")
        else:
            raise TypeError(f"cannot compile {type(stage).__name__}")

    def number(self, slot: int) -> Column:
        name, mean = self.features[slot]
        value = F.col(f"`{name}`").cast("double")
        return F.coalesce(F.when(~F.isnan(value), value), F.lit(mean))

    def text(self, name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(self.fills.get(name)))

    def is_text(self, slot: int) -> bool:
        return isinstance(self.features[slot][1], str)

    def holds(self, slot: int) -> Column:
        name, label = self.features[slot]
        return F.coalesce(self.text(name) == F.lit(label), F.lit(False))


def _linear(model: LinearRegressionModel, inputs: _Inputs) -> Column:
    total, by_name = F.lit(float(model.intercept)), {}
    for slot, w in enumerate(map(float, model.coefficients)):
        if not w:
            continue
        if inputs.is_text(slot):
            name, label = inputs.features[slot]
            by_name.setdefault(name, []).extend((F.lit(label), F.lit(w)))
        else:
            total = total + inputs.number(slot) * w
    for name, told in by_name.items():
        total = total + F.coalesce(F.try_element_at(F.create_map(*told), inputs.text(name)), F.lit(0.0))
    return total


def _tree(node, inputs: _Inputs) -> Column:
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    slot = split.featureIndex()
    if split.getClass().getSimpleName() == "ContinuousSplit":
        value = inputs.holds(slot).cast("double") if inputs.is_text(slot) else inputs.number(slot)
        goes_left = value <= float(split.threshold())
    else:
        # Slots of categories are 0 or 1.
        zero, one = (x in set(split.leftCategories()) for x in (0.0, 1.0))
        goes_left = F.lit(one) if zero == one else inputs.holds(slot) if one else ~inputs.holds(slot)
    return F.when(goes_left, _tree(node.leftChild(), inputs)).otherwise(_tree(node.rightChild(), inputs))


def prediction(model: PipelineModel) -> Column:
    """The pipeline's prediction as one expression over its input columns; TypeError for stages it does not know."""
    inputs = _Inputs()
    for stage in model.stages[:-1]:
        inputs.read(stage)
    last = model.stages[-1]
    if isinstance(last, LinearRegressionModel):
        return _linear(last, inputs)
    if isinstance(last, (RandomForestRegressionModel, GBTRegressionModel)):
        weights = [1.0 / len(last.trees)] * len(last.trees) if isinstance(last, RandomForestRegressionModel) else last.treeWeights
        total = F.lit(0.0)
        for tree, weight in zip(last.trees, weights):
            total = total + _tree(tree._java_obj.rootNode(), inputs) * float(weight)
        return total
    raise TypeError(f"cannot compile {type(last).__name__}")
