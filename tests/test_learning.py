"""Splits, encoders, models, calibration, contributions."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from riskloom.operators import explain, learning, metrics
from riskloom.operators.split import class_weights, part_number, stratified_split
from riskloom.plans import training, warehouse
from riskloom.schema import CATEGORICAL, ID, NUMERIC, TARGET

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def train(spark):
    return warehouse.train_fold(spark, SMALL)


@pytest.fixture(scope="module")
def test(spark):
    return warehouse.test_fold(spark, SMALL)


@pytest.fixture(scope="module")
def prep(train):
    return learning.fit_preprocessor(train)


@pytest.fixture(scope="module")
def logistic(train, prep):
    return learning.fit_model(train, "logistic_regression", prep)


def test_folds_are_exact_and_disjoint(spark):
    df = spark.range(1, 1004).select(F.col("id").alias(ID), (F.col("id") % 3 == 0).cast("int").alias(TARGET))
    folds = stratified_split(df)
    sizes = {(r[TARGET], r["fold"]): r["count"] for r in folds.groupBy(TARGET, "fold").count().collect()}
    positives = sum(1 for i in range(1, 1004) if i % 3 == 0)
    assert sizes[(1, "test")] == positives // 4 and sizes[(0, "test")] == (1003 - positives) // 4
    assert folds.count() == folds.select(ID).distinct().count() == 1003
    again = stratified_split(df.repartition(5))
    assert folds.exceptAll(again).count() == 0


def test_split_without_enough_rows_keeps_all_in_train(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], f"{ID} long, {TARGET} int")
    assert {r["fold"] for r in stratified_split(df).collect()} == {"train"}


def test_weights_balance_the_classes(spark):
    df = spark.createDataFrame([(0,)] * 30 + [(1,)] * 10, f"{TARGET} int")
    rows = {r["class"]: r for r in class_weights(df).collect()}
    assert rows[0]["balanced_weight"] * 30 == rows[1]["balanced_weight"] * 10 == 20
    assert (rows[1]["positive_weight"], rows[0]["positive_weight"]) == (3.0, 1.0)


def test_calibration_parts_cover_every_row_once(train):
    parts = [train.filter(part_number(42, 3) == i).count() for i in range(3)]
    assert sum(parts) == train.count() and min(parts) > 0


def test_encoded_train_is_standardized(train, prep):
    x = np.array([list(r["features"]) for r in learning.encode(prep, train).collect()])
    assert x.shape[1] == len(NUMERIC) + 2 + 4 + 3 == len(learning.feature_names(prep))
    varied = x[:, :len(NUMERIC)].std(axis=0) > 0
    assert np.allclose(x[:, :len(NUMERIC)].mean(axis=0), 0, atol=1e-9)
    assert np.allclose(x[:, :len(NUMERIC)].std(axis=0)[varied], 1, atol=1e-9)
    for block in learning.one_hot_blocks(prep).values():
        assert (x[:, block].sum(axis=1) == 1).all()


def test_unknown_code_is_all_zeros(test, prep):
    strange = test.limit(5).withColumns({c: F.lit(99) for c in CATEGORICAL})
    x = np.array([list(r["features"]) for r in learning.encode(prep, strange).collect()])
    assert (x[:, len(NUMERIC):] == 0).all()


def test_logistic_regression_finds_the_signal_and_its_optimum(train, test, prep, logistic):
    rows = training.model_metrics({"m": logistic}, test).first()
    assert 0.55 < rows["roc_auc"] < 1.0 and rows["ks"] > 0.1
    # gradient of  |w|^2/2 + C * sum(weight * loss)  is zero at the solution
    encoded = learning.encode(prep, train).collect()
    x = np.array([list(r["features"]) for r in encoded])
    y = np.array([r[TARGET] for r in encoded])
    n1 = y.sum()
    weight = np.where(y == 1, len(y) / (2 * n1), len(y) / (2 * (len(y) - n1)))
    w, b = np.array(logistic.stages[-1].coefficients), logistic.stages[-1].intercept
    residual = weight * (1 / (1 + np.exp(-(x @ w + b))) - y)
    gradient = w + 0.1 * (x.T @ residual)
    assert np.abs(gradient).max() < 0.05 * np.abs(0.1 * x.T @ (weight * (0.5 - y))).max()
    assert abs(residual.sum()) < 1.0


def test_saved_pipeline_scores_the_same(test, logistic, tmp_path):
    logistic.write().overwrite().save(str(tmp_path / "m"))
    again = learning.predict_with(PipelineModel.load(str(tmp_path / "m")), test)
    both = learning.predict_with(logistic, test).select(ID, F.col("predicted_pd").alias("p")).join(again, ID)
    assert both.filter(F.col("p") != F.col("predicted_pd")).count() == 0


def test_calibrated_scores_are_monotone_and_keep_the_rate(train, logistic, tmp_path):
    held = learning.predict_with(logistic, train, "_score")
    curve = learning.fit_isotonic(held)
    rows = curve.transform(held).orderBy("_score").collect()
    fitted = np.array([r["_calibrated"] for r in rows])
    assert (np.diff(fitted) >= -1e-12).all()
    assert fitted.sum() == pytest.approx(sum(r[TARGET] for r in rows), rel=1e-6)


def test_calibration_averages_three_pairs_and_reloads(train, test, tmp_path):
    model = learning.fit_calibrated(train, "logistic_regression")
    assert len(model.pairs) == 3
    learning.save_calibrated(model, str(tmp_path / "c"))
    p = {r[ID]: r["predicted_pd"] for r in model(test).collect()}
    q = {r[ID]: r["predicted_pd"] for r in learning.load_calibrated(str(tmp_path / "c"))(test).collect()}
    assert p == q and all(0 <= v <= 1 for v in p.values()) and len(p) == test.count()


def test_linear_contributions_add_up_to_the_margin(test, prep, logistic):
    encoded = learning.encode(prep, test)
    means = explain.encoded_means(encoded)
    fitted = logistic.stages[-1]
    parts = explain.linear_contributions(learning.feature_names(prep), fitted.coefficients, means)
    rows = explain.contribution_rows(explain.with_array(encoded), parts).groupBy(ID).agg(F.sum("contribution").alias("s"))
    base = float(np.dot(fitted.coefficients, means) + fitted.intercept)
    scored = learning.predict_with(logistic, test).select(ID, "predicted_pd").join(rows, ID).collect()
    for r in scored:
        assert 1 / (1 + np.exp(-(base + r["s"]))) == pytest.approx(r["predicted_pd"], abs=1e-9)


@pytest.mark.parametrize("kind", ["forest", "boosting"])
def test_path_contributions_add_up_to_the_score(spark, train, test, prep, kind, tmp_path):
    estimator = learning.random_forest(8) if kind == "forest" else learning.gradient_boosting(4)
    encoded = learning.encode(prep, train).withColumn(learning.WEIGHT, F.lit(1.0))
    fitted = estimator.fit(encoded)
    nodes = explain.tree_nodes(spark, PipelineModel([fitted]), str(tmp_path / kind))
    weights = [1 / 8] * 8 if kind == "forest" else list(fitted.treeWeights)
    root = sum(w * v for w, v in zip(weights, nodes[nodes["id"] == 0].sort_values("tree")["value"]))
    held = learning.encode(prep, test)
    paths = explain.path_attributions(held, nodes, weights, learning.feature_names(prep))
    sums = explain.path_contributions(paths).groupBy(ID).agg(F.sum("contribution").alias("s"))
    score = learning.probability() if kind == "forest" else F.col("_margin")
    scored = fitted.transform(held)
    if kind == "boosting":
        from pyspark.ml.functions import vector_to_array
        scored = scored.withColumn("_margin", vector_to_array("rawPrediction")[1])
    for r in scored.select(ID, score.alias("p")).join(sums, ID).collect():
        assert root + r["s"] == pytest.approx(r["p"], abs=1e-9)
    top = explain.strongest_paths(paths, 3).groupBy(ID).count().select("count").distinct().collect()
    assert [r[0] for r in top] == [3]


def test_best_model_and_comparison(spark):
    rows = spark.createDataFrame([("a", 0.7, 0.5), ("b", 0.65, 0.6)], "model string, roc_auc double, pr_auc double")
    assert metrics.best_model(rows).first()["model"] == "b"
    table = metrics.comparison_table(rows, ["roc_auc", "pr_auc"])
    assert table.columns == ["metric", "a", "b"] and table.count() == 2


def test_studies_say_what_they_could_not_run(train, test, prep):
    few = train.filter(F.col(TARGET) == 0).unionByName(train.filter(F.col(TARGET) == 1).orderBy(ID).limit(4))
    rows = {r["strategy"]: r for r in training.imbalance_study(few, test, prep).collect()}
    assert set(rows) == {"none", "class_weight", "smote"} and rows["none"]["ran"] and rows["none"]["reason"] is None
    assert not rows["smote"]["ran"] and rows["smote"]["roc_auc"] is None and "4 minority rows" in rows["smote"]["reason"]
    again = {r["strategy"]: r for r in training.balanced_retraining(few, test, ["logistic_regression"], prep).collect()}
    assert again["none (baseline)"]["ran"] and not again["synthetic_balanced"]["ran"]


def test_forest_rows_are_dealt_evenly(spark):
    """Whole rounds of the cores, whatever the files of the fold."""
    cores = spark.sparkContext.defaultParallelism
    for rows, rounds in ((1000, 1), (learning.TASK_ROWS * cores + 1, 2)):
        dealt = learning.evenly_dealt(spark.range(0, 1000, 1, 3), rows)
        sizes = dealt.rdd.glom().map(len).collect()
        assert len(sizes) == cores * rounds and sum(sizes) == 1000
        assert max(sizes) <= 1000 / len(sizes) + 3


def test_both_tree_fits_deal_their_rows(train, prep, monkeypatch):
    dealt, whole = [], learning.evenly_dealt
    monkeypatch.setattr(learning, "evenly_dealt", lambda rows, count: dealt.append(count) or whole(rows, count))
    monkeypatch.setattr(learning, "gradient_boosting", lambda make=learning.gradient_boosting: make(2))
    monkeypatch.setattr(learning, "random_forest", lambda make=learning.random_forest: make(2))
    rows = learning.encode(prep, train)
    for name in ("random_forest", "gradient_boosting"):
        learning.fit_classifier(rows, name, "balanced")
    assert dealt == [rows.count()] * 2
