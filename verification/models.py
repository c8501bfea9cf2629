"""Queries that fit models: checked by rows and invariants, not by number."""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.operators import explain, learning, logistic, metrics, resample, scoring
from riskloom.plans import training, warehouse as W
from riskloom.schema import ID, NUMERIC, TARGET
from riskloom.session import cut_lineage, scratch_path
from verification.common import six
from verification.oracle import SCORED
from verification.oracle import six as sql_six
from verification.scores import _FILLED, _with

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
LOGISTIC, FOREST, BOOSTING = training.CANDIDATES


def register(name, query, sql=None):
    QUERIES[name] = query
    if sql is not None:
        ORACLE[name] = sql


def _prep(spark, d) -> PipelineModel:
    return W.once(spark, d, "preprocessor", lambda: learning.fit_preprocessor(W.train_fold(spark, d)))


def _model(spark, d, name) -> PipelineModel:
    return W.once(spark, d, f"model {name}",
                   lambda: learning.fit_model(W.train_fold(spark, d), name, _prep(spark, d)))


def _calibrated(spark, d, name=LOGISTIC) -> learning.CalibratedModel:
    return W.once(spark, d, f"calibrated {name}", lambda: learning.fit_calibrated(W.train_fold(spark, d), name))


def _imbalance(spark, d):
    return W.once(spark, d, "imbalance", lambda: cut_lineage(
        training.imbalance_study(W.train_fold(spark, d), W.test_fold(spark, d), _prep(spark, d))))


def _metrics_of(name):
    return lambda s, d: six(training.model_metrics({name: _model(s, d, name)}, W.test_fold(s, d)))


def l4_one_hot(spark, d):
    """Encoded codes of the test fold, with one code the training fold never saw."""
    test = W.test_fold(spark, d).withColumn("MARRIAGE", F.when(F.col(ID) % 5 == 0, 9).otherwise(F.col("MARRIAGE")))
    prep = _prep(spark, d)
    names = learning.feature_names(prep)
    encoded = explain.with_array(learning.encode(prep, test))
    blocks = learning.one_hot_blocks(prep)
    return encoded.select(ID, *[F.col("_x")[i].alias(names[i]) for block in blocks.values() for i in block])


def l5_encoded(spark, d):
    """Every encoded value of the test fold by name."""
    prep = _prep(spark, d)
    encoded = explain.with_array(learning.encode(prep, W.test_fold(spark, d)))
    names = F.array(*map(F.lit, learning.feature_names(prep)))
    return six(encoded.select(ID, F.inline(F.arrays_zip(names.alias("feature"), F.col("_x").alias("value")))))


def l11_smote(spark, d):
    encoded = cut_lineage(learning.encode(_prep(spark, d), W.train_fold(spark, d)))
    return resample.smote(encoded).select("parent", "neighbour", "copy", F.col("x")[0].alias("first"))


def l15_retraining(spark, d):
    table = training.balanced_retraining(
        W.train_fold(spark, d), W.test_fold(spark, d), prep=_prep(spark, d))
    return six(training.comparison_with_earlier(table, _imbalance(spark, d)))


def l6_optimum(spark, d):
    """Whether the fit ends at the optimum: there weighted scores add up to weighted outcomes and the gradient is zero."""
    encoded = learning.encode(_prep(spark, d), W.train_fold(spark, d))
    weight, total = learning._weights(encoded, "balanced")
    model = _model(spark, d, LOGISTIC).stages[-1]
    beta = np.append(model.coefficients.toArray(), model.intercept)
    rows = logistic.weighted_rows(encoded.withColumn("w", weight), TARGET, "w")
    steepest = np.abs(logistic.statistics(rows, beta, total, 1.0 / (0.1 * total)).gradient).max()
    return six(model.transform(encoded.withColumn("w", weight)).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("w") * vector_to_array("probability")[1]).alias("weighted_positives"),
        F.lit(int(steepest < 1e-6)).alias("at_optimum")))


def _choice(spark, d):
    test = W.test_fold(spark, d)
    return training.brier_choice(learning.predict_with(_model(spark, d, LOGISTIC), test), _calibrated(spark, d)(test))


def x1_coefficients(spark, d):
    model = _model(spark, d, LOGISTIC)
    return explain.top_coefficients(spark, learning.feature_names(_prep(spark, d)), model.stages[-1].coefficients)


def x2_importances(spark, d):
    model = _model(spark, d, FOREST)
    names = learning.feature_names(_prep(spark, d))
    return explain.top_importances(spark, names, model.stages[-1].featureImportances.toArray())


def x3_logistic(spark, d):
    prep, test = _prep(spark, d), W.test_fold(spark, d)
    encoded = learning.encode(prep, test)
    parts = explain.linear_contributions(
        learning.feature_names(prep), _model(spark, d, LOGISTIC).stages[-1].coefficients,
        explain.encoded_means(encoded))
    return explain.mean_absolute(explain.with_array(encoded), parts)


def _forest_paths(spark, d):
    model = _model(spark, d, FOREST)
    prep = _prep(spark, d)
    nodes = W.once(spark, d, "forest nodes", lambda: explain.tree_nodes(spark, model, scratch_path(spark, "forest")))
    trees = model.stages[-1].getNumTrees
    return explain.path_attributions(learning.encode(prep, W.test_fold(spark, d)), nodes, [1.0 / trees] * trees,
                                      learning.feature_names(prep))


def io7_saved_model(spark, d):
    path = scratch_path(spark, "model")
    _model(spark, d, LOGISTIC).write().overwrite().save(path)
    return learning.predict_with(PipelineModel.load(path), W.test_fold(spark, d)).select(ID, "predicted_pd")


def sc1_calibrated(spark, d):
    """Scoring of raw records with the saved and reloaded calibrated model."""
    path = scratch_path(spark, "calibrated")
    learning.save_calibrated(_calibrated(spark, d), path)
    scored = scoring.score_accounts(W.raw_accounts(spark, d), learning.load_calibrated(path), W.thresholds(spark, d))
    return scoring.score_response(scored)


def l16_calibration(spark, d):
    calibrated = cut_lineage(_calibrated(spark, d)(W.test_fold(spark, d)))
    return six(metrics.calibration_table(calibrated, "predicted_pd", TARGET))


def g12_model_card(spark, d):
    rows = training.model_metrics({LOGISTIC: _model(spark, d, LOGISTIC)}, W.test_fold(spark, d))
    return training.model_card(rows, LOGISTIC, _choice(spark, d), W.thresholds(spark, d), W.train_fold(spark, d).count())


def sc3_training(spark, d):
    """The whole run with all three candidates; the result bundle by section."""
    return training.run_training(W.raw_accounts(spark, d), scratch_path(spark, "training"))


# the codes that the training fold has at the sizes of the tests
_CODES = {"SEX": 2, "EDUCATION": 4, "MARRIAGE": 3}
_FLAGS = [(f"{c}_{v}", c, v) for c, most in _CODES.items() for v in range(1, most + 1)]
register("l4_one_hot", l4_one_hot, _with(SCORED, "SELECT ID, " + ", ".join(
    f"CAST({c if c != 'MARRIAGE' else 'CASE WHEN ID % 5 = 0 THEN 9 ELSE MARRIAGE END'} = {v} AS DOUBLE) AS {name}" for name, c, v in _FLAGS) + " FROM scored"))
register("l5_column_transformer", l5_encoded, _with(SCORED + f""", filled AS (SELECT {_FILLED} FROM train),
    tested AS (SELECT ID, SEX, EDUCATION, MARRIAGE, {_FILLED} FROM scored)""", " UNION ALL ".join(
        [f"SELECT ID, '{c}' AS feature, " + sql_six(f"({c} - (SELECT AVG({c}) FROM filled)) / coalesce(nullif((SELECT stddev_pop({c}) FROM filled), 0), 1)")
         + " AS value FROM tested" for c in NUMERIC]
        + [f"SELECT ID, '{name}', CAST({c} = {v} AS DOUBLE) FROM tested" for name, c, v in _FLAGS])))
register("l6_logistic_regression", _metrics_of(LOGISTIC))
register("l6_optimum", l6_optimum, _with(SCORED, f"""
    SELECT COUNT(*) AS rows, {sql_six("SUM(actual_default * (SELECT COUNT(*) FROM train) / (2.0 * (SELECT COUNT(*) FROM train WHERE actual_default = 1)))")} AS weighted_positives,
           1 AS at_optimum FROM train"""))
register("l7_random_forest", _metrics_of(FOREST))
register("l8_gradient_boosting", _metrics_of(BOOSTING))
register("l10_imbalance_study", lambda s, d: six(_imbalance(s, d)))
register("l11_smote", l11_smote)
register("l12_linear_generator", lambda s, d: training.generator_study(
    W.train_fold(s, d), prep=_prep(s, d)))
register("l15_balanced_retraining", l15_retraining)
register("l16_brier_choice", lambda s, d: six(_choice(s, d)))
register("l16_calibrated_table", l16_calibration)
register("x1_odds_ratios", x1_coefficients)
register("x2_importances", x2_importances)
register("x3_logistic_contributions", x3_logistic)
register("x3_forest_contributions", lambda s, d: explain.global_from_rows(
    explain.path_contributions(_forest_paths(s, d))))
register("x4_forest_local", lambda s, d: explain.strongest_paths(_forest_paths(s, d)))
register("io7_saved_model", io7_saved_model)
register("sc1_calibrated_scores", sc1_calibrated)
register("g12_model_card", g12_model_card)
register("sc3_training_run", sc3_training)
