"""What moves a score: coefficients, importances and per-account contributions."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.schema import ID

# tasks get these functions by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOP_GLOBAL = 15
TOP_LOCAL = 8


def top_coefficients(spark: SparkSession, names: list[str], coefficients, k: int = TOP_GLOBAL) -> DataFrame:
    """Largest coefficients by size with their odds ratio."""
    rows = spark.createDataFrame(list(zip(names, map(float, coefficients))),
                                 "feature string, coefficient double")
    return rows.withColumn("odds_ratio", F.exp("coefficient")).orderBy(
        F.abs("coefficient").desc(), "feature").limit(k)


def top_importances(spark: SparkSession, names: list[str], importances, k: int = TOP_GLOBAL) -> DataFrame:
    rows = spark.createDataFrame(list(zip(names, map(float, importances))),
                                 "feature string, importance double")
    return rows.orderBy(F.desc("importance"), "feature").limit(k)


def _entries(contributions: dict[str, Column]) -> list[Column]:
    return [F.struct(F.lit(n).alias("feature"), c.cast("double").alias("contribution"))
            for n, c in contributions.items()]


def contribution_rows(df: DataFrame, contributions: dict[str, Column]) -> DataFrame:
    """Long table (ID, feature, contribution)."""
    return df.select(ID, F.inline(F.array(*_entries(contributions))))


def mean_absolute(df: DataFrame, contributions: dict[str, Column], k: int = TOP_GLOBAL) -> DataFrame:
    """Mean absolute contribution per feature over the table, largest first."""
    wide = df.agg(*[F.avg(F.abs(c)).alias(n) for n, c in contributions.items()])
    return wide.unpivot([], list(contributions), "feature", "mean_abs_contribution").orderBy(
        F.desc("mean_abs_contribution"), "feature").limit(k)


def strongest_per_account(df: DataFrame, contributions: dict[str, Column], k: int = TOP_LOCAL) -> DataFrame:
    """The k strongest contributions of each account.

    Chosen inside the row, so no contribution is shuffled to be ranked.
    """
    ranked = F.array_sort(F.array(*[
        F.struct((-F.abs(c)).alias("_key"), F.lit(n).alias("feature"),
                 c.cast("double").alias("contribution"))
        for n, c in contributions.items()
    ]))
    return df.select(ID, F.posexplode(F.slice(ranked, 1, k)).alias("_at", "_top")).select(
        ID, (F.col("_at") + 1).alias("rank"), "_top.feature", "_top.contribution")


def sample_accounts(df: DataFrame, rows: int = 1000) -> DataFrame:
    """Reproducible sample: the first accounts in order of the ID's digest."""
    return df.orderBy(F.md5(F.col(ID).cast("string")), ID).limit(rows)


def split_explained(scored: DataFrame, attributions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accounts that have attributions, accounts that have none)."""
    known = attributions.select(ID).distinct()
    return scored.join(known, ID, "left_semi"), scored.join(known, ID, "left_anti")


def linear_contributions(names: list[str], coefficients, means, values: str = "_x") -> dict[str, Column]:
    """coefficient * (value - mean) over an encoded array column."""
    return {
        n: F.lit(float(w)) * (F.col(values)[i] - F.lit(float(m)))
        for i, (n, w, m) in enumerate(zip(names, coefficients, means))
    }


def encoded_means(encoded: DataFrame) -> list[float]:
    return list(encoded.select(Summarizer.mean(F.col("features"))).first()[0])


def weighted_terms(terms: dict[str, Column], weights: dict[str, float],
                   means: dict[str, float]) -> dict[str, Column]:
    """Contributions of a linear score written over named columns."""
    return {n: F.lit(weights[n]) * (c - F.lit(means[n])) for n, c in terms.items()}


def with_array(encoded: DataFrame) -> DataFrame:
    return encoded.withColumn("_x", vector_to_array("features"))


def tree_nodes(spark: SparkSession, model: PipelineModel, path: str) -> pd.DataFrame:
    """Nodes of a saved tree ensemble: their number is set by trees and depth.

    `value` is the mean outcome of a node: class share in a forest, leaf score in boosting.
    """
    classifier = model.stages[-1]
    classifier.write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data")
    node = "nodeData" if "nodeData" in data.columns else None
    field = (lambda n: F.col(f"{node}.{n}")) if node else F.col
    stats = field("impurityStats").cast("array<double>")
    forest = type(classifier).__name__.startswith("RandomForest")
    whole = F.get(stats, 0) + F.get(stats, 1) if forest else F.get(stats, 0)
    value = F.try_divide(F.get(stats, 1), whole)
    return data.select(
        F.col("treeID").alias("tree"), field("id").alias("id"), value.alias("value"),
        field("leftChild").alias("left"), field("rightChild").alias("right"),
        field("split.featureIndex").alias("feature"),
        F.get(field("split.leftCategoriesOrThreshold"), 0).alias("threshold"),
        field("split.numCategories").alias("categories"),
    ).orderBy("tree", "id").toPandas()


def _packed(nodes: pd.DataFrame, weights: list[float]) -> list[tuple]:
    packed = []
    for tree, part in nodes.groupby("tree", sort=True):
        part = part.sort_values("id")
        packed.append((float(weights[int(tree)]), part["feature"].to_numpy(int),
                       part["threshold"].to_numpy(float), part["left"].to_numpy(int),
                       part["right"].to_numpy(int), part["value"].to_numpy(float),
                       part["categories"].to_numpy(int) >= 0))
    return packed


def _walk(x: np.ndarray, trees: list[tuple], out: np.ndarray) -> None:
    """Add each step's change of node value to the feature that was split on.

    A split on a one-hot column sends one of its two values to the left; any
    other split sends the values up to its threshold.
    """
    rows = np.arange(len(x))
    for weight, feature, threshold, left, right, value, binary in trees:
        at = np.zeros(len(x), dtype=int)
        while True:
            moving = rows[left[at] >= 0]
            if not len(moving):
                break
            here = at[moving]
            split = feature[here]
            seen = x[moving, split]
            goes_left = np.where(binary[here], seen == threshold[here], seen <= threshold[here])
            following = np.where(goes_left, left[here], right[here])
            np.add.at(out, (moving, split), weight * (value[following] - value[here]))
            at[moving] = following


def path_attributions(encoded: DataFrame, nodes: pd.DataFrame, weights: list[float],
                      names: list[str]) -> DataFrame:
    """(ID, entries): path attributions of a tree ensemble per account, in Arrow batches.

    The contributions of an account and the mean root value add up to its score.
    """
    trees = encoded.sparkSession.sparkContext.broadcast(_packed(nodes, weights))

    def explain(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.array(batch.tolist(), dtype=float).reshape(len(batch), -1)
            out = np.zeros_like(x)
            _walk(x, trees.value, out)
            yield pd.Series(list(out))

    explained = F.pandas_udf(explain, "array<double>")
    listed = F.array(*[F.lit(n) for n in names])
    rows = with_array(encoded).select(ID, explained(F.col("_x")).alias("_c"))
    return rows.select(ID, F.arrays_zip(
        listed.alias("feature"), F.col("_c").alias("contribution")).alias("entries"))


def path_contributions(attributions: DataFrame) -> DataFrame:
    """Long table (ID, feature, contribution)."""
    return attributions.select(ID, F.inline("entries"))


def strongest_paths(attributions: DataFrame, k: int = TOP_LOCAL) -> DataFrame:
    """The k strongest entries of each account, chosen inside the row."""
    ranked = F.array_sort(F.transform("entries", lambda e: F.struct(
        (-F.abs(e["contribution"])).alias("_key"), e["feature"].alias("feature"),
        e["contribution"].alias("contribution"))))
    return attributions.select(ID, F.posexplode(F.slice(ranked, 1, k)).alias("_at", "_top")).select(
        ID, (F.col("_at") + 1).alias("rank"), "_top.feature", "_top.contribution")


def global_from_rows(rows: DataFrame, k: int = TOP_GLOBAL) -> DataFrame:
    return rows.groupBy("feature").agg(
        F.avg(F.abs("contribution")).alias("mean_abs_contribution")).orderBy(
        F.desc("mean_abs_contribution"), "feature").limit(k)
