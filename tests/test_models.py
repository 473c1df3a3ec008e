import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tarmac.operators.validate import accepted_batch, check_rows, split_rows
from tarmac.plans import models
from tarmac.plans.training import split_train_test
from tarmac.schemas import CATEGORICAL_FEATURES, FEATURE_COLUMNS, FEATURES, NUMERIC_FEATURES, TARGET
from tarmac.session import scratch_path


@pytest.fixture(scope="module")
def numbers():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 3)) * [1.0, 2.0, 0.5] + [0.0, 3.0, -1.0]
    y = x @ [2.0, -1.0, 0.05] + 4.0 + rng.normal(size=200)
    return x, y


def coordinate_descent(x, y, alpha, l1_ratio, rounds=3000):
    """Minimises |y - Xw - b|^2 / 2n + alpha * r * |w|_1 + alpha * (1 - r) / 2 * |w|^2."""
    xc, yc, n = x - x.mean(0), y - y.mean(), len(y)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        for j in range(len(w)):
            rho = xc[:, j] @ (yc - xc @ w + xc[:, j] * w[j]) / n
            w[j] = np.sign(rho) * max(abs(rho) - alpha * l1_ratio, 0) / ((xc[:, j] ** 2).mean() + alpha * (1 - l1_ratio))
    return w, y.mean() - x.mean(0) @ w


def frame(spark, x, y):
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, y double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)


@pytest.mark.parametrize("alpha, ratio", [(0.1, 0.2), (0.01, 0.5), (0.5, 0.9), (0.3, 1.0), (0.3, 0.0)])
@pytest.mark.parametrize("solver", ["auto", "l-bfgs"])
def test_elastic_net(spark, numbers, alpha, ratio, solver):
    df = frame(spark, *numbers)
    fitted = models.elastic_net(df, "y", alpha, ratio, solver).fit(df)
    w, b = coordinate_descent(*numbers, alpha, ratio)
    assert fitted.coefficients.toArray() == pytest.approx(w, abs=1e-4) and fitted.intercept == pytest.approx(b, abs=1e-3)


def test_ridge_and_least_squares(spark, numbers):
    x, y = numbers
    df = frame(spark, x, y)
    xc, yc = x - x.mean(0), y - y.mean()
    for fitted, penalty in ((models.ridge(df, "y", 25.0).fit(df), 25.0), (models.least_squares("y").fit(df), 0.0)):
        w = np.linalg.solve(xc.T @ xc + penalty * np.eye(3), xc.T @ yc)
        assert fitted.coefficients.toArray() == pytest.approx(w, abs=1e-5)


def test_constant_label(spark):
    df = frame(spark, np.arange(30.0).reshape(10, 3), np.full(10, 2.0))
    fitted = models.elastic_net(df, "y").fit(df)
    assert fitted.intercept == pytest.approx(2.0) and np.abs(fitted.coefficients.toArray()).max() < 1e-9


def encode(spark, train, test, drop_first):
    t, s = (spark.createDataFrame([(v,) for v in values], "c string") for values in (train, test))
    fitted = Pipeline(stages=models.preprocessing(t, ["c"], [], drop_first=drop_first)).fit(t)
    return [list(r.v) for r in fitted.transform(s).select(vector_to_array("features").alias("v")).collect()]


def test_one_hot(spark):
    train = ["b", "a", "c", "b"]
    assert encode(spark, train, ["a", "b", "c", "new", None], False) == [[1, 0, 0], [0, 1, 0], [0, 0, 1], [0, 0, 0], [0, 1, 0]]
    # Descending order: slots are c, b; the first category and unseen ones have none.
    assert encode(spark, train, ["a", "b", "c", "new"], True) == [[0, 0], [0, 1], [1, 0], [0, 0]]


def test_unknown_values_do_not_disturb_drop_first_on_test_rows(spark):
    assert encode(spark, ["a", "b"], ["zzz"], True) == [[0]]


def features(spark, n=60):
    rows = []
    for i in range(n):
        row = {c: None for c in FEATURE_COLUMNS}
        row |= dict(airline_name=f"A{i % 4}" if i % 9 else None, departure_iata="CDG", arrival_iata=f"X{i % 3}")
        row |= dict(scheduled_hour=i % 24, day_of_week=1 + i % 7, month=4, is_weekend=0)
        row |= dict(departure_delay_actual=float(i % 30), departure_delay_estimated=0.0, arrival_delay_estimated=1.0 * (i % 5))
        row |= dict(flight_duration_scheduled=100.0 + i, dep_temperature=float(i % 11) if i % 6 else None)
        rows.append((i, *row.values(), float(i % 30) * 0.9 + (i % 3)))
    return spark.createDataFrame(rows, f"id int, {FEATURES}, {TARGET} double")


def test_production_model_survives_saving(spark):
    rows = models.as_doubles(features(spark))
    model = models.build_model(rows).fit(rows)
    path = scratch_path(spark, "model")
    models.save_model(model, path)
    again = models.load_model(path)
    a, b = ([r.prediction for r in models.score(m, rows).orderBy("id").collect()] for m in (model, again))
    assert a == b and min(a) >= 0.0
    assert models.r2(models.score(model, rows, clamp=False), TARGET, "prediction").first().r2 > 0.9
    assert set(models.score(model, rows).columns) == {*rows.columns, "prediction"}


def test_columns_without_values_are_left_out(spark):
    rows = models.as_doubles(features(spark))
    usable = models.usable_numeric(rows, NUMERIC_FEATURES)
    assert "dep_temperature" in usable and "arr_temperature" not in usable


def test_fill_values_come_from_training_rows(spark):
    train = spark.createDataFrame([("b", 1.0), ("a", 3.0), (None, None)], "c string, x double")
    fitted = Pipeline(stages=models.preprocessing(train, ["c"], ["x"])).fit(train)
    test = spark.createDataFrame([(None, None)], "c string, x double")
    assert fitted.transform(test).select("c", "x_filled").first() == ("a", 2.0)


def test_comparison_of_all_models(spark):
    rows = split_train_test(models.as_doubles(features(spark, 120)), ["id"])
    scores = {(r.model, r.split): r.r2 for r in models.compare_models(rows).collect()}
    assert len(scores) == 10 and all(v > 0.5 for (m, s), v in scores.items() if s == "train")


def test_split_is_stable(spark):
    rows = spark.range(20_000)
    one = split_train_test(rows, ["id"])
    two = split_train_test(rows.repartition(13), ["id"])
    assert one.join(two, ["id", "split"]).count() == 20_000
    assert abs(one.where("split = 'train'").count() / 20_000 - 0.75) < 0.02


# ---- the feature contract -------------------------------------------------------------------


def contract_row(**changes):
    row = dict.fromkeys(FEATURE_COLUMNS, 1)
    return row | dict(airline_name="A", departure_iata="B", arrival_iata="C") | changes


def frame_of(spark, *rows):
    ddl = ", ".join(f"{c} string" for c in (*FEATURE_COLUMNS, "extra"))
    return spark.createDataFrame([tuple(None if r.get(c) is None else str(r[c]) for c in (*FEATURE_COLUMNS, "extra")) for r in rows], ddl)


@pytest.mark.parametrize(
    "changes, reasons",
    [
        ({}, []),
        ({"extra": "ignored"}, []),
        ({"dep_temperature": None}, []),
        ({"scheduled_hour": None}, ["missing:scheduled_hour"]),
        ({"month": "April"}, ["type:month"]),
        ({"month": "4.5"}, ["type:month"]),
        ({"month": "4.0"}, []),
        ({"arr_weather_bad": "yes", "airline_name": None}, ["missing:airline_name", "type:arr_weather_bad"]),
    ],
)
def test_contract(spark, changes, reasons):
    assert check_rows(frame_of(spark, contract_row(**changes))).first().reasons == reasons


def test_contract_types_and_batches(spark):
    good, bad = contract_row(), contract_row(month="April")
    assert dict(check_rows(frame_of(spark, good)).select(FEATURE_COLUMNS).dtypes) == dict(spark.createDataFrame([], FEATURES).dtypes)
    valid, quarantined = split_rows(frame_of(spark, good, bad))
    assert (valid.count(), quarantined.count()) == (1, 1)
    assert accepted_batch(frame_of(spark, good, good)).count() == 2
    assert accepted_batch(frame_of(spark, good, bad)).count() == 0


def test_absent_required_column(spark):
    df = frame_of(spark, contract_row()).drop("month", "dep_temperature")
    row = check_rows(df).first()
    assert row.reasons == ["missing:month"] and row.dep_temperature is None


def test_categories_are_text(spark):
    df = frame_of(spark, contract_row()).withColumn("airline_name", F.lit(5))
    assert check_rows(df).first().reasons == ["type:airline_name"]
    assert CATEGORICAL_FEATURES == ["airline_name", "departure_iata", "arrival_iata"]
