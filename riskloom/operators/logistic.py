"""Logistic regression by sufficient statistics.

Every pass over the data gives the gradient and the Hessian of the penalized loss as one
aggregate of (columns + 1)^2 / 2 numbers; the step is solved on the driver. The penalty makes
the loss strictly convex, so Newton's method needs about ten passes where a gradient method
needs hundreds; a step that doesn't lower the loss is halved. The result is MLlib's own model
class, so pipelines save, load and transform as before.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import cut_lineage

# tasks get these functions by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ROWS = 4096


@dataclass(frozen=True)
class Statistics:
    """Of the penalized mean loss at some coefficients (the last one is the intercept)."""

    loss: float
    gradient: np.ndarray
    hessian: np.ndarray


def _sums(x: np.ndarray, y: np.ndarray, w: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """Loss, gradient and upper half of the Hessian of some rows, one after the other."""
    x = np.hstack([x, np.ones((len(x), 1))])
    z = x @ beta
    p = 1.0 / (1.0 + np.exp(-np.abs(z)))
    p = np.where(z >= 0, p, 1.0 - p)
    loss = (w * (np.logaddexp(0.0, z) - y * z)).sum()
    hessian = (x * (w * p * (1.0 - p))[:, None]).T @ x
    return np.concatenate([[loss], x.T @ (w * (p - y)), hessian[np.triu_indices(len(beta))]])


def statistics(rows: DataFrame, beta: np.ndarray, total: float, penalty: float) -> Statistics:
    """One pass over (x, y, w); `penalty` is the factor of half the squared coefficients, without the intercept."""
    size = len(beta)
    width = 1 + size + size * (size + 1) // 2
    schema = pa.schema([("i", pa.int32()), ("v", pa.float64())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(width)
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                x = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                sums += _sums(x, *(part.column(i).to_numpy(zero_copy_only=False) for i in (1, 2)), beta)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(sums)], schema=schema)

    found = np.zeros(width)
    for r in rows.mapInArrow(add, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():  # columns squared
        found[r["i"]] = r["v"] / total
    ridge = np.append(np.full(size - 1, penalty), 0.0)
    hessian = np.zeros((size, size))
    hessian[np.triu_indices(size)] = found[1 + size:]
    hessian = hessian + np.triu(hessian, 1).T + np.diag(ridge)
    return Statistics(found[0] + float(ridge @ beta ** 2) / 2, found[1:1 + size] + ridge * beta, hessian)


def weighted_rows(data: DataFrame, label: str, weight: str, features: str = "features") -> DataFrame:
    return data.select(vector_to_array(F.col(features)).alias("x"), F.col(label).cast("double").alias("y"), F.col(weight).cast("double").alias("w"))


def fit_coefficients(rows: DataFrame, total: float, penalty: float, tolerance: float = 1e-9, most: int = 50) -> tuple[np.ndarray, float]:
    """Coefficients with the intercept last, and the largest entry of the gradient there."""
    first = rows.first()
    if first is None:
        raise ValueError("no rows to learn from")
    beta = np.zeros(len(first["x"]) + 1)
    now = statistics(rows, beta, total, penalty)
    for _ in range(most):
        if np.abs(now.gradient).max() < tolerance:
            break
        step = np.linalg.lstsq(now.hessian, now.gradient, rcond=None)[0]
        for half in range(30):
            there = statistics(rows, beta - step * 0.5 ** half, total, penalty)
            if there.loss <= now.loss + 1e-13 * abs(now.loss):
                break
        beta, now = beta - step * 0.5 ** half, there
    return beta, float(np.abs(now.gradient).max())


def fit(data: DataFrame, label: str, weight: str, total: float, c: float) -> LogisticRegressionModel:
    """Penalty ||b||^2 / 2 + C * sum(loss), as a model that pipelines can hold."""
    rows = cut_lineage(weighted_rows(data, label, weight))
    beta, _ = fit_coefficients(rows, total, 1.0 / (c * total))
    context = data.sparkSession.sparkContext
    made = context._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        f"LogisticRegression_{abs(hash(beta.tobytes())):016x}", _py2java(context, Vectors.dense(beta[:-1])), float(beta[-1]))
    model = LogisticRegressionModel(made)
    return model.setFeaturesCol("features")
