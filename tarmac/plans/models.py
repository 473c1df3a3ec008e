"""Regression models over feature rows, on ``pyspark.ml``."""

from __future__ import annotations

from math import isfinite

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.text import positive_or_zero
from tarmac.operators.profile import modes, r2
from tarmac.plans import compiled, linear
from tarmac.plans.stages import DropFirst, MostFrequentModel
from tarmac.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES, TARGET
from tarmac.session import cut_lineage

# ---- fixed values: hyper-parameters ---------------------------------------------------------
ELASTIC_NET = {"alpha": 0.1, "l1_ratio": 0.2}
ELASTIC_NET_EXPLORATION = {"alpha": 0.01, "l1_ratio": 0.5}
RIDGE_ALPHA = 1.0
FOREST = {"numTrees": 50, "maxDepth": 3, "minInstancesPerNode": 5, "seed": 42}
BOOSTING = {"stepSize": 0.1, "maxDepth": 2, "maxIter": 50, "seed": 42}


# ---- preprocessing --------------------------------------------------------------------------


class MostFrequentImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the most frequent value of each text column (ties: smallest); one value per column
    reaches the driver. A column without any value is filled with the empty string."""

    def __init__(self, inputCols: list[str] | None = None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=inputCols)

    def _fit(self, dataset: DataFrame) -> MostFrequentModel:
        learnt = {row["column_name"]: row["mode"] for row in modes(dataset, self.getInputCols()).collect()}
        return MostFrequentModel(self.getInputCols(), [learnt.get(c, "") for c in self.getInputCols()])


class DropFirstFit(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Reads the category counts off the indexers' column metadata."""

    def __init__(self, inputCols: list[str] | None = None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=inputCols)

    def _fit(self, dataset: DataFrame) -> DropFirst:
        vals = {c: dataset.schema[c].metadata["ml_attr"]["vals"] for c in self.getInputCols()}
        return DropFirst(self.getInputCols(), [len(vals[c]) - 1 for c in self.getInputCols()])


def usable_numeric(df: DataFrame, columns: list[str]) -> list[str]:
    """Numeric columns with at least one value; a mean needs one. One aggregate for all of them."""
    if not columns:
        return []
    counts = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    return [c for c in columns if counts[c] > 0]


def preprocessing(
    train: DataFrame,
    categorical: list[str] | None = None,
    numeric: list[str] | None = None,
    drop_first: bool = False,
) -> list:
    """Stages that turn feature rows into one vector: fill, index, one-hot, assemble.

    Categories are ordered alphabetically. A value unseen in training becomes an all-zero block;
    with ``drop_first`` so does the first category.
    """
    categorical = CATEGORICAL_FEATURES if categorical is None else categorical
    numeric = usable_numeric(train, NUMERIC_FEATURES if numeric is None else numeric)
    index = [f"{c}_index" for c in categorical]
    onehot = [f"{c}_onehot" for c in categorical]
    filled = [f"{c}_filled" for c in numeric]
    stages = []
    if categorical:
        order = "alphabetDesc" if drop_first else "alphabetAsc"
        stages.append(MostFrequentImputer(categorical))
        stages.append(
            StringIndexer(inputCols=categorical, outputCols=index, stringOrderType=order, handleInvalid="keep")
        )
        if drop_first:
            stages.append(DropFirstFit(index))
        stages.append(OneHotEncoder(inputCols=index, outputCols=onehot, dropLast=True))
    if numeric:
        stages.append(Imputer(strategy="mean", inputCols=numeric, outputCols=filled))
    stages.append(VectorAssembler(inputCols=onehot + filled, outputCol="features"))
    return stages


def as_doubles(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Numeric feature columns as doubles; the mean of an integer column need not be an integer."""
    names = [c for c in (columns or NUMERIC_FEATURES) if c in df.columns]
    return df.withColumns({c: F.col(c).cast("double") for c in names})


# ---- estimators -----------------------------------------------------------------------------


def label_spread(train: DataFrame, label: str, solver: str = "normal") -> tuple[float, int]:
    """The standard deviation a solver divides the label by, and the number of labels.

    The normal-equation solver uses the population value, the iterative one the sample value. The solver is
    always named, since Spark's own choice depends on the number of features, which one-hot blocks can push up:
    beyond 4,096 features the caller names ``l-bfgs``.
    """
    deviation = F.stddev_samp(label) if solver == "l-bfgs" else F.stddev_pop(label)
    spread, rows = train.agg(deviation, F.count(label)).first()
    spread = float(spread) if spread is not None and isfinite(spread) else 0.0
    return spread, rows


def _linear(label: str, reg: float = 0.0, mix: float = 0.0, solver: str = "normal") -> LinearRegression:
    return LinearRegression(
        labelCol=label, featuresCol="features", regParam=reg, elasticNetParam=mix,
        standardization=False, maxIter=1000, tol=1e-10, solver=solver,
    )


def elastic_net(
    train: DataFrame, label: str = TARGET, alpha: float = 0.1, l1_ratio: float = 0.2, solver: str = "normal"
) -> LinearRegression:
    """Minimises ``|y - Xw|^2 / 2n + alpha * l1_ratio * |w|_1 + alpha * (1 - l1_ratio) / 2 * |w|^2``.

    Spark fits on a label divided by its standard deviation, which scales the quadratic penalty
    but not the absolute one; the two are converted so that the objective above is the one solved.
    """
    spread, _ = label_spread(train, label, solver)
    lasso, quadratic = alpha * l1_ratio, alpha * (1.0 - l1_ratio) * spread
    total = lasso + quadratic
    return _linear(label, total, lasso / total, solver) if total > 0 else _linear(label, solver=solver)


def ridge(train: DataFrame, label: str = TARGET, alpha: float = RIDGE_ALPHA, solver: str = "normal") -> LinearRegression:
    """Minimises ``|y - Xw|^2 + alpha * |w|^2``."""
    spread, rows = label_spread(train, label, solver)
    return _linear(label, alpha * spread / rows if rows else 0.0, 0.0, solver)


def least_squares(label: str = TARGET) -> LinearRegression:
    return _linear(label)


def random_forest(label: str = TARGET) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=label, featuresCol="features", featureSubsetStrategy="all", **FOREST)


def gradient_boosting(label: str = TARGET) -> GBTRegressor:
    return GBTRegressor(labelCol=label, featuresCol="features", **BOOSTING)


def build_model(train: DataFrame, estimator=None, label: str = TARGET, **columns) -> Pipeline:
    """Preprocessing plus an estimator; the production estimator is the elastic net."""
    estimator = estimator or elastic_net(train, label, **ELASTIC_NET)
    return Pipeline(stages=preprocessing(train, **columns) + [estimator])


#: The five models that are compared, and those of them that are trees.
CANDIDATES = ["random_forest", "gradient_boosting", "linear_regression", "ridge", "elastic_net"]
TREES = {"random_forest": random_forest, "gradient_boosting": gradient_boosting}


def compare_models(rows: DataFrame, label: str = TARGET, names: list[str] | None = None, **columns) -> DataFrame:
    """(model, split, r2, rows) for each candidate; ``rows`` carries ``split``.

    One pass over the rows sums what all linear candidates and their scores need. For the trees preprocessing is fitted and
    applied once; the assembled vectors are written to the shared folder, where both fits read them.
    """
    names = CANDIDATES if names is None else [n for n in CANDIDATES if n in names]
    # Each score is two numbers, so the finished table is tiny and safe to build here.
    scores = []
    if linear_names := [n for n in names if n not in TREES]:
        categorical, numeric = columns.get("categorical", CATEGORICAL_FEATURES), columns.get("numeric", NUMERIC_FEATURES)
        summed = linear.Moments(rows, categorical, numeric, label, "split")
        scores += linear.compare(summed, linear_names, ridge=RIDGE_ALPHA, elastic_net=ELASTIC_NET_EXPLORATION)
    if tree_names := [n for n in names if n in TREES]:
        train = rows.where("split = 'train'")
        prepared_by = Pipeline(stages=preprocessing(train, drop_first=True, **columns)).fit(train)
        ready = cut_lineage(prepared_by.transform(rows).select("split", "features", label))
        fit_on = ready.where("split = 'train'")
        for name in tree_names:
            scored = TREES[name](label).fit(fit_on).transform(ready)
            scores += [(name, r["split"], r["r2"], r["rows"]) for r in r2(scored, label, "prediction", ["split"]).collect()]
    return rows.sparkSession.createDataFrame(scores, "model string, split string, r2 double, rows bigint")


def fit_production(rows: DataFrame, label: str = TARGET, **columns) -> tuple[linear.LinearModel, DataFrame]:
    """The production model of the rows of split ``train``, and (split, r2, rows); one pass over ``rows``."""
    categorical, numeric = columns.get("categorical", CATEGORICAL_FEATURES), columns.get("numeric", NUMERIC_FEATURES)
    summed = linear.Moments(rows, categorical, numeric, label, "split")
    design = summed.design("train")
    model = design.elastic_net(**ELASTIC_NET)
    scores = [(part, *design.r2(model, part)) for part in sorted(summed.raw)]
    return model, rows.sparkSession.createDataFrame(scores, "split string, r2 double, rows bigint")


# ---- persistence and scoring ----------------------------------------------------------------


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel | linear.LinearModel, rows: DataFrame, clamp: bool = True) -> DataFrame:
    """Rows with ``prediction``; predicted delays below zero become zero.

    The model becomes one expression over the rows' own columns, which stay as they are.
    """
    told = model.prediction() if isinstance(model, linear.LinearModel) else compiled.prediction(model)
    scored = rows.withColumn("prediction", told)
    return scored.withColumn("prediction", positive_or_zero(F.col("prediction"))) if clamp else scored
