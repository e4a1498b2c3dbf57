"""Logistic regression by aggregates, against Spark's own and against known weights."""

import math
import random

import pytest

from tickloom.operators import training
from tickloom.operators.logistic import LogisticModel, fit_logistic


def rows(n, weights, intercept, seed=1, scale=1.0):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        x = [rng.gauss(4000, 3), rng.gauss(0, scale)]
        z = intercept + weights[0] * (x[0] - 4000) + weights[1] * x[1]
        out.append((*x, int(rng.random() < 1 / (1 + math.exp(-z)))))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "price double, size double, label int")


@pytest.mark.parametrize("ridge", [0.0, 0.05])
def test_equals_the_library(spark, tmp_path, ridge):
    df = frame(spark, rows(4_000, (0.4, -1.1), 0.3)).cache()
    model = fit_logistic(df, ("price", "size"), ridge=ridge)
    other = training.train_pipeline(df, str(tmp_path / "m"), ridge=ridge).stages[-1]
    assert model.weights == pytest.approx(list(other.coefficients), rel=1e-3)
    assert model.intercept == pytest.approx(other.intercept, rel=1e-3)
    assert model.rounds < 12
    scored = training.score_pipeline(df.selectExpr("'c' contract_id", "1L event_time", "*"), str(tmp_path / "m"))
    assert scored.count() == 4_000


def test_the_likelihood_has_no_better_neighbour(spark):
    data = rows(500, (0.2, 0.7), -0.4, seed=5)
    model = fit_logistic(frame(spark, data), ("price", "size"))

    def slope(k):
        out = 0.0
        for x0, x1, y in data:
            z = model.intercept + model.weights[0] * x0 + model.weights[1] * x1
            out += (y - 1 / (1 + math.exp(-z))) * (1, x0 - 4000, x1)[k]
        return out

    assert all(abs(slope(k)) < 1e-6 for k in range(3))


def test_nulls_are_left_out_and_score_null(spark):
    data = rows(300, (0.5, 0.5), 0.0, seed=2)
    holes = [(None, 1.0, 1), (4000.0, None, 0), (4000.0, 1.0, None)]
    whole, holed = (fit_logistic(frame(spark, d), ("price", "size")) for d in (data, data + holes))
    assert whole.weights == pytest.approx(holed.weights)
    got = holed.transform(frame(spark, holes)).collect()
    assert [r["prediction"] is None for r in got] == [True, True, False]
    assert got[0]["probability"] is None


def test_constant_and_repeated_inputs_change_no_score(spark):
    data = [(*r[:2], r[2]) for r in rows(400, (0.5, -0.5), 0.1, seed=3)]
    df = frame(spark, data).selectExpr("*", "7D AS fixed", "size AS again")
    plain, more = (fit_logistic(df, c) for c in (("price", "size"), ("price", "size", "fixed", "again")))
    a, b = ([r[0] for r in df.select(m.probability()).collect()] for m in (plain, more))
    assert a == pytest.approx(b, abs=1e-9)


def test_separable_labels_end(spark):
    df = frame(spark, [(float(i), 0.0, int(i > 10)) for i in range(20)])
    model = fit_logistic(df, ("price", "size"))
    assert training.model_accuracy(model, df).first()["accuracy"] == 1.0


def test_no_rows(spark):
    with pytest.raises(ValueError, match="no row"):
        fit_logistic(frame(spark, []), ("price",))


def test_saved_and_loaded(spark, tmp_path):
    model = LogisticModel(("price", "size"), (0.25, -1.5), 3.0, 4)
    for _ in range(2):
        model.save(spark, str(tmp_path / "m"))
    assert LogisticModel.load(spark, str(tmp_path / "m")) == model


def test_a_round_is_one_native_aggregate(spark):
    df = frame(spark, rows(50, (0.1, 0.1), 0.0))
    plan = fit_logistic(df, ("price",)).transform(df)._jdf.queryExecution().toString()
    assert "Python" not in plan
