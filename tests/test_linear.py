"""Models from sums against NumPy over the rows, and compiled pipelines against their transform."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tarmac.plans import compiled, linear, models
from tarmac.plans.training import split_train_test
from tarmac.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES, TARGET
from tarmac.session import scratch_path
from tests.test_models import coordinate_descent, features


def made(n=240, seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a, b = rng.choice(["x", "y", "z", None], p=[0.5, 0.2, 0.2, 0.1]), rng.choice(["p", "q"])
        u, v = (float(t) for t in rng.normal(size=2))
        y = {"x": 1.0, "y": -2.0, "z": 0.5, None: 1.0}[a] + (3 if b == "q" else 0) + 2 * u - v + rng.normal()
        gap = rng.random()
        rows.append((i, a, b, None if gap < 0.1 else float("nan") if gap < 0.15 else u, v, None, "train" if i % 4 else "test", float(y)))
    return rows


DDL = "id int, a string, b string, u double, v double, nothing double, split string, y double"


def matrix(rows, fit_on):
    """Filled one-hot features, means and modes from the rows of ``fit_on``."""
    known = [r[3] for r in fit_on if r[3] is not None and r[3] == r[3]]
    mean = np.mean(known)
    x = []
    for r in rows:
        a = r[1] or "x"
        u = mean if r[3] is None or r[3] != r[3] else r[3]
        x.append([a == "x", a == "y", a == "z", r[2] == "p", r[2] == "q", u, r[4]])
    return np.array(x, dtype=float), np.array([r[7] for r in rows])


def weights(model):
    return [model.levels["a"][k] for k in "xyz"] + [model.levels["b"][k] for k in "pq"] + [model.numbers["u"], model.numbers["v"]]


@pytest.fixture(scope="module")
def summed(spark):
    rows = made()
    df = spark.createDataFrame(rows, DDL)
    return rows, df, linear.Moments(df, ["a", "b"], ["u", "v", "nothing"], "y", "split")


@pytest.mark.parametrize("alpha, ratio", [(0.1, 0.2), (0.01, 0.5), (0.5, 0.9), (0.3, 1.0), (0.3, 0.0)])
def test_elastic_net(summed, alpha, ratio):
    rows, _, moments = summed
    train = [r for r in rows if r[6] == "train"]
    model = moments.design("train").elastic_net(alpha, ratio)
    w, b = coordinate_descent(*matrix(train, train), alpha, ratio)
    assert weights(model) == pytest.approx(w, abs=1e-6) and model.intercept == pytest.approx(b, abs=1e-6)


def test_ridge_least_squares_and_r2(summed):
    rows, _, moments = summed
    train, test = ([r for r in rows if r[6] == s] for s in ("train", "test"))
    x, y = matrix(train, train)
    design = moments.design("train")
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + 7.0 * np.eye(7), xc.T @ yc)
    ridge = design.ridge(7.0)
    assert weights(ridge) == pytest.approx(w, abs=1e-8)
    least = design.least_squares()
    assert weights(least) == pytest.approx(np.linalg.lstsq(xc, yc, rcond=None)[0], abs=1e-7)
    for model in (ridge, least):
        for part, some in (("train", train), ("test", test)):
            xs, ys = matrix(some, train)
            wrong = ((ys - model.intercept - xs @ weights(model)) ** 2).sum()
            assert design.r2(model, part) == (pytest.approx(1 - wrong / ((ys - ys.mean()) ** 2).sum()), len(some))


def test_the_expression_is_the_model(spark, summed):
    rows, df, moments = summed
    train = [r for r in rows if r[6] == "train"]
    model = moments.design("train").ridge(1.0)
    path = scratch_path(spark, "linear")
    model.save(spark, path)
    assert linear.load(spark, path) == model
    x, _ = matrix(rows, train)
    want = dict(zip((r[0] for r in rows), model.intercept + x @ weights(model)))
    scored = linear.score(linear.load(spark, path), df)
    assert scored.columns == [*df.columns, "prediction"]
    assert {r.id: r.prediction for r in scored.collect()} == pytest.approx(want)
    # A category it has not seen adds nothing.
    odd = spark.createDataFrame([(0, "new", "p", 0.0, 0.0, None, "test", 0.0)], DDL)
    assert linear.score(model, odd).first().prediction == pytest.approx(model.intercept + model.levels["b"]["p"])


def test_one_pass(spark, summed, monkeypatch):
    _, df, _ = summed
    seen = []
    monkeypatch.setattr(linear, "cut_lineage", lambda d: seen.append(d) or d)
    linear.Moments(df, ["a", "b"], ["u", "v"], "y", "split")
    assert len(seen) == 1
    plan = seen[0]._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange") == 1 and "Python" not in plan


def test_columns_of_very_different_size(spark):
    rows = [(i, "abcdefgh"[i % 8] if i else "once", "p", 1e-3 * (i % 7), 1e6 * (i % 11), None, "train", float(i % 8 + i % 7 + (50 if not i else 0))) for i in range(400)]
    design = linear.Moments(spark.createDataFrame(rows, DDL), ["a"], ["u", "v"], "y", "split").design("train")
    for model in (design.least_squares(), design.elastic_net(0.0, 0.5), design.ridge(1e-9)):
        assert design.r2(model, "train") == (pytest.approx(1.0, abs=1e-6), 400)


def test_odd_labels_and_splits(spark):
    rows = [(i, "x", "p", 1.0, float(i), None, "train", 2.0) for i in range(8)] + [(9, "x", "p", 1.0, 1.0, None, "train", None)]
    moments = linear.Moments(spark.createDataFrame(rows, DDL), ["a", "b"], ["u", "v"], "y", "split")
    design = moments.design("train")
    model = design.elastic_net(0.1, 0.2)
    assert model.intercept == pytest.approx(2.0) and design.r2(model, "train") == (1.0, 8) and design.r2(model, "test") == (None, 0)
    with pytest.raises(ValueError):
        moments.design("test")


def test_too_many_categories_are_refused(spark, monkeypatch):
    monkeypatch.setattr(linear, "MOST_LEVELS", 2)
    with pytest.raises(ValueError):
        linear.Moments(spark.createDataFrame(made(40), DDL), ["a", "b"], ["u"], "y")


def test_equals_the_library_on_features(spark):
    rows = split_train_test(models.as_doubles(features(spark, 160)), ["id"])
    train = rows.where("split = 'train'")
    fitted = models.build_model(train).fit(train)
    moments = linear.Moments(rows, CATEGORICAL_FEATURES, NUMERIC_FEATURES, TARGET, "split")
    model = moments.design("train").elastic_net(**models.ELASTIC_NET)
    want = {r.id: r.prediction for r in fitted.transform(rows).select("id", "prediction").collect()}
    got = {r.id: r.prediction for r in linear.score(model, rows).select("id", "prediction").collect()}
    assert got == pytest.approx(want, abs=1e-3)


@pytest.mark.parametrize("drop_first", [False, True])
@pytest.mark.parametrize("kind", ["elastic_net", "least_squares", "random_forest", "gradient_boosting"])
def test_compiled_pipelines_equal_their_transform(spark, kind, drop_first):
    rows = models.as_doubles(features(spark, 120))
    estimator = {"elastic_net": lambda: models.elastic_net(rows, TARGET), "least_squares": models.least_squares}.get(kind, getattr(models, kind, None))()
    model = models.build_model(rows, estimator, drop_first=drop_first).fit(rows)
    odd = rows.withColumn("airline_name", F.when(F.col("id") % 5 == 0, F.lit("unseen")).otherwise(F.col("airline_name")))
    odd = odd.withColumn("dep_temperature", F.when(F.col("id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("dep_temperature")))
    want = {r.id: r.prediction for r in model.transform(odd).select("id", "prediction").collect()}
    scored = odd.select("id", compiled.prediction(model).alias("prediction"))
    assert {r.id: r.prediction for r in scored.collect()} == pytest.approx(want)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan and "vector" not in plan


def test_unknown_stages_are_refused(spark):
    rows = models.as_doubles(features(spark, 30))
    model = models.build_model(rows).fit(rows)
    model.stages.insert(0, VectorAssembler(inputCols=["month"], outputCol="m"))
    with pytest.raises(TypeError):
        compiled.prediction(model)
