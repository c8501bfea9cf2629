"""Main directions of a set of vectors, from their correlation matrix.

Spark computes the matrix (columns x columns) from the rows; only the matrix is
decomposed on the driver. The decomposition is numpy's, which unlike the one
behind MLlib's PCA may run in several driver threads at once.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.rowwise import number


def correlation_of(vectors: DataFrame, column: str) -> np.ndarray:
    """Pearson matrix of a vector column; whatever involves a constant entry is 0."""
    matrix = Correlation.corr(vectors, column).first()[0].toArray()
    undefined = np.isnan(matrix)
    constant = undefined.sum(axis=1) >= max(len(matrix) - 1, 1)
    matrix[undefined] = 0.0
    matrix[constant, constant] = 0.0
    return matrix


def main_directions(rows: DataFrame, array: str, k: int) -> np.ndarray:
    """Unit directions (width x k) of an array column, strongest first."""
    vectors = rows.select(array_to_vector(F.col(array)).alias("_v"))
    _, found = np.linalg.eigh(correlation_of(vectors, "_v"))
    chosen = found[:, ::-1][:, :k]
    sign = np.sign(chosen[np.abs(chosen).argmax(axis=0), np.arange(chosen.shape[1])])
    return chosen * np.where(sign == 0, 1.0, sign)


def along(array: str, direction: np.ndarray) -> str:
    """Projection of an array column onto one direction, as SQL."""
    return "(" + " + ".join(f"{array}[{i}] * {number(w)}" for i, w in enumerate(direction)) + ")"
