"""Newton steps against a plain solver and against odd inputs."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskloom.operators import logistic


def table(spark, x, y, w):
    rows = [(list(map(float, a)), float(b), float(c)) for a, b, c in zip(x, y, w)]
    return spark.createDataFrame(rows, "x array<double>, y double, w double").repartition(5)


def plain(x, y, w, penalty, steps=50):
    x, beta = np.hstack([x, np.ones((len(x), 1))]), np.zeros(x.shape[1] + 1)
    ridge = np.append(np.full(x.shape[1] - 1, penalty), 0.0)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ beta))
        beta -= np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x / w.sum() + np.diag(ridge), x.T @ (w * (p - y)) / w.sum() + ridge * beta)
    return beta


def test_coefficients_equal_a_plain_solver(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(size=(400, 4))
    x[:130] = x[0]  # a third of the rows are one row
    y = (draw.random(400) < 1 / (1 + np.exp(-(x @ [1.0, -2.0, 0.5, 0.0] + 0.3)))).astype(float)
    w = draw.choice([0.5, 2.0], 400)
    beta, steepest = logistic.fit_coefficients(table(spark, x, y, w), w.sum(), 0.01)
    assert steepest < 1e-9 and np.allclose(beta, plain(x, y, w, 0.01), atol=1e-8)


def test_separable_and_constant_columns_end(spark):
    x = np.column_stack([np.linspace(-1, 1, 60) * 1e3, np.ones(60)])
    y = (x[:, 0] > 0).astype(float)
    beta, steepest = logistic.fit_coefficients(table(spark, x, y, np.ones(60)), 60.0, 0.05)
    assert steepest < 1e-6 and np.isfinite(beta).all() and beta[0] > 0


def test_model_is_saved_and_loaded(spark, tmp_path):
    draw = np.random.default_rng(6)
    rows = table(spark, draw.normal(size=(80, 3)), draw.integers(0, 2, 80), np.ones(80))
    model = logistic.fit(rows.select(array_to_vector("x").alias("features"), "y", "w"), "y", "w", 80.0, 1.0)
    model.write().overwrite().save(f"{tmp_path}/m")
    again = type(model).load(f"{tmp_path}/m")
    data = rows.select(array_to_vector("x").alias("features"))
    assert [r["probability"] for r in model.transform(data).collect()] == [r["probability"] for r in again.transform(data).collect()]


def test_no_rows_is_an_error(spark):
    with pytest.raises(ValueError, match="no rows"):
        logistic.fit_coefficients(spark.range(0).select(F.array(F.lit(1.0)).alias("x"), F.lit(0.0).alias("y"), F.lit(1.0).alias("w")), 1.0, 0.1)
