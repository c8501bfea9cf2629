"""Encoders, classifiers and calibration as MLlib pipelines.

Everything fitted comes from the training fold. Only model parameters (medians,
means, coefficients, tree nodes) reach the driver; their number is set by the
columns and the hyperparameters, not by the data.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.rowwise import number
from riskloom.operators import isotonic, logistic
from riskloom.operators.ranking import exact_quantiles
from riskloom.operators.split import class_weights, part_number
from riskloom.schema import CATEGORICAL, ID, NUMERIC, TARGET
from riskloom.session import at_once

SEED = 42
WEIGHT = "_weight"
#: sums of the nodes that a forest grows in one pass: so few that a core's cache holds them. More passes, each over
#: kept rows, cost less than sums read from memory
GROUP_MB = 4
TASK_ROWS = 250_000


def medians(train: DataFrame, columns: list[str] = NUMERIC) -> DataFrame:
    """Exact median of the present values per column.

    One quantile a column needs no narrow bracket, and a coarser sketch is a fifth of the
    work of the single task that joins the partitions' sketches.
    """
    return exact_quantiles(train, columns, [0.5], accuracy=2000).select("feature", F.col("value").alias("median"))


def numeric_statistics(train: DataFrame, columns: list[str] = NUMERIC) -> dict[str, tuple]:
    """Per column: median, and mean and population deviation after imputation."""
    middle = {r["feature"]: r["median"] for r in medians(train, columns).collect()}
    filled = {c: f"coalesce(CAST({c} AS DOUBLE), {number(middle.get(c, 0.0))})" for c in columns}
    row = train.agg(*[F.expr(f"avg({v}) AS {c}_avg") for c, v in filled.items()],
                    *[F.expr(f"stddev_pop({v}) AS {c}_dev") for c, v in filled.items()]).first()
    return {c: (middle.get(c, 0.0), row[f"{c}_avg"], row[f"{c}_dev"] or 1.0) for c in columns}


def _scaling_stage(statistics: dict[str, tuple]) -> SQLTransformer:
    """Imputation and standardization as one projection that saves with the pipeline."""
    parts = [
        f"(coalesce(double(`{c}`), {m!r}D) - {a!r}D) / {s!r}D AS `z_{c}`"
        for c, (m, a, s) in statistics.items()
    ]
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def fit_preprocessor(train: DataFrame) -> PipelineModel:
    """48 scaled numerics and three one-hot codes into `features`; an unknown code is all zeros."""
    scaling = _scaling_stage(numeric_statistics(train))
    indexed, coded = [f"i_{c}" for c in CATEGORICAL], [f"o_{c}" for c in CATEGORICAL]
    indexer = StringIndexer(inputCols=CATEGORICAL, outputCols=indexed,
                            stringOrderType="alphabetAsc", handleInvalid="keep").fit(train)
    encoder = OneHotEncoder(inputCols=indexed, outputCols=coded, dropLast=True).fit(
        indexer.transform(train))
    assembler = VectorAssembler(inputCols=[f"z_{c}" for c in NUMERIC] + coded, outputCol="features")
    return PipelineModel([scaling, indexer, encoder, assembler])


def feature_names(preprocessor: PipelineModel) -> list[str]:
    labels = preprocessor.stages[1].labelsArray
    return list(NUMERIC) + [f"{c}_{v}" for c, found in zip(CATEGORICAL, labels) for v in found]


def one_hot_blocks(preprocessor: PipelineModel) -> dict[str, list[int]]:
    """Positions of each categorical variable in the encoded vector."""
    blocks, start = {}, len(NUMERIC)
    for name, labels in zip(CATEGORICAL, preprocessor.stages[1].labelsArray):
        blocks[name] = list(range(start, start + len(labels)))
        start += len(labels)
    return blocks


def encode(preprocessor: PipelineModel, df: DataFrame) -> DataFrame:
    """(ID, outcome, features) of the encoded table."""
    return preprocessor.transform(df).select(ID, F.col(TARGET).cast("double").alias(TARGET), "features")


def _weights(train: DataFrame, kind: str | None) -> tuple[Column, float]:
    """Class weights as a column, and their sum; two class counts come from the fold."""
    counts = {r["class"]: r for r in class_weights(train).collect()}
    by_class = {c: float(r[f"{kind}_weight"]) if kind else 1.0 for c, r in counts.items()}
    total = sum(by_class[c] * r["n"] for c, r in counts.items())
    column = F.when(F.col(TARGET) == 1, F.lit(by_class.get(1, 1.0))).otherwise(F.lit(by_class.get(0, 1.0)))
    return column, total


def random_forest(trees: int = 300) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol=TARGET, featuresCol="features", weightCol=WEIGHT, numTrees=trees, maxDepth=8,
        minInstancesPerNode=20, maxMemoryInMB=GROUP_MB, seed=SEED)


def evenly_dealt(rows: DataFrame, count: int) -> DataFrame:
    """Rows in tasks of one size, a whole number of rounds of the cluster's cores: a level of a tree waits for its longest task."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores * max(1, math.ceil(count / (cores * TASK_ROWS))))


def gradient_boosting(rounds: int = 300) -> GBTClassifier:
    return GBTClassifier(
        labelCol=TARGET, featuresCol="features", weightCol=WEIGHT, maxIter=rounds, maxDepth=4,
        stepSize=0.05, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=SEED)


def fit_classifier(encoded: DataFrame, name: str, weighting: str | None, c: float = 0.1) -> Transformer:
    """Fit one of the three classifiers on an encoded training fold.

    The fold is not cached here: the fits keep their own compact copy (blocks of
    instances, binned tree points) and read the encoded rows a few times only.
    """
    weight, total = _weights(encoded, weighting)
    weighted = encoded.withColumn(WEIGHT, weight)
    if name == "logistic_regression":
        return logistic.fit(weighted, TARGET, WEIGHT, total, c)
    if name == "random_forest":
        return random_forest().fit(evenly_dealt(weighted, encoded.count()))
    return gradient_boosting().fit(evenly_dealt(weighted, encoded.count()))


WEIGHTING = {
    "logistic_regression": "balanced", "random_forest": "balanced", "gradient_boosting": "positive",
}


def fit_model(train: DataFrame, name: str, preprocessor: PipelineModel | None = None) -> PipelineModel:
    """Preprocessor and class-weighted classifier as one saved-and-loaded pipeline."""
    preprocessor = preprocessor or fit_preprocessor(train)
    classifier = fit_classifier(encode(preprocessor, train), name, WEIGHTING[name])
    return PipelineModel([*preprocessor.stages, classifier])


def probability(column: str = "probability") -> Column:
    return vector_to_array(F.col(column))[1]


def predict_with(model: Transformer, df: DataFrame, name: str = "predicted_pd") -> DataFrame:
    """Input columns plus the positive-class probability."""
    return model.transform(df).select(*[F.col(f"`{c}`") for c in df.columns], probability().alias(name))


@dataclass
class CalibratedModel:
    """Pairs of (pipeline fitted on two parts, isotonic curve of the third); the
    prediction is the mean over the pairs."""

    pairs: list

    def __call__(self, df: DataFrame) -> DataFrame:
        kept = [F.col(f"`{c}`") for c in df.columns]
        parts = []
        for i, (model, curve) in enumerate(self.pairs):
            name = f"_part{i}"
            df = model.transform(df).select(*kept, *parts, probability().alias("_score"))
            df = curve.transform(df).select(*kept, *parts, F.col("_calibrated").alias(name))
            parts.append(F.col(name))
        mean = sum(parts[1:], parts[0]) / F.lit(float(len(parts)))
        return df.select(*kept, mean.alias("predicted_pd"))


def fit_isotonic(scored: DataFrame, score: str = "_score"):
    """Monotone curve from score to observed rate, on unrounded scores.

    Pooling runs over ranges of scores (`isotonic.pooled`). MLlib's regression is then fitted on the two ends of each
    block, where nothing is left to pool; it is what saves, loads and interpolates the curve, so the driver holds the
    blocks and no other rows.
    """
    blocks = isotonic.pooled(scored, score, TARGET)
    end = lambda at: F.struct(F.col(at).alias("_score"), (F.col("hits") / F.col("n")).alias("_rate"), (F.col("n") / 2.0).alias(WEIGHT))
    return IsotonicRegression(featuresCol="_score", labelCol="_rate", weightCol=WEIGHT,
                              predictionCol="_calibrated").fit(blocks.select(F.inline(F.array(end("low"), end("high")))))


def fit_calibrated(train: DataFrame, name: str, parts: int = 3,
                   fit: Callable[[DataFrame, str], PipelineModel] = fit_model) -> CalibratedModel:
    """Isotonic calibration over hash parts of the training fold."""
    part = part_number(SEED, parts)

    def pair(i: int) -> tuple:
        model = fit(train.filter(part != i), name)
        held_out = predict_with(model, train.filter(part == i), "_score")
        return model, fit_isotonic(held_out)

    return CalibratedModel(at_once(train.sparkSession, pair, range(parts)))


def save_calibrated(model: CalibratedModel, path: str) -> None:
    for i, (pipeline, curve) in enumerate(model.pairs):
        pipeline.write().overwrite().save(f"{path}/model_{i}")
        curve.write().overwrite().save(f"{path}/curve_{i}")


def load_calibrated(path: str, parts: int = 3) -> CalibratedModel:
    from pyspark.ml.regression import IsotonicRegressionModel

    return CalibratedModel([
        (PipelineModel.load(f"{path}/model_{i}"), IsotonicRegressionModel.load(f"{path}/curve_{i}"))
        for i in range(parts)
    ])
