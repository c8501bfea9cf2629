"""The training run: split, study, fit, choose, calibrate, report, store."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.binning import risk_band
from riskloom.operators import explain, learning, metrics, portfolio, resample
from riskloom.operators.clean import clean_accounts
from riskloom.operators.drift import stability_index
from riskloom.operators.features import engineer_features
from riskloom.operators.scoring import band_thresholds, thresholds_of
from riskloom.operators.split import split_summary, stratified_split
from riskloom.schema import FLAGS, ID, NUMERIC, TARGET
from riskloom.session import at_once, cut_lineage, prepare
from riskloom.sources.accounts import write_table

CANDIDATES = ["logistic_regression", "random_forest", "gradient_boosting"]
METRICS = ["roc_auc", "pr_auc", "ks", "brier_score", "precision", "recall", "f1"]


def fit_candidates(train: DataFrame, prep: PipelineModel, names: list[str]) -> dict[str, PipelineModel]:
    fitted = at_once(train.sparkSession, lambda name: learning.fit_model(train, name, prep), names)
    return dict(zip(names, fitted))


def model_scores(models: dict[str, PipelineModel], df: DataFrame) -> DataFrame:
    """Long table (ID, model, predicted_pd, outcome) of every model."""
    parts = [
        learning.predict_with(model, df).select(
            ID, F.lit(name).alias("model"), "predicted_pd", F.col(TARGET).cast("int").alias(TARGET))
        for name, model in models.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def model_metrics(models: dict[str, PipelineModel], test: DataFrame) -> DataFrame:
    return metrics.full_metrics(model_scores(models, test), "predicted_pd", TARGET, ["model"])


def _score_encoded(classifier, encoded: DataFrame, label: str) -> DataFrame:
    return classifier.transform(encoded).select(
        F.lit(label).alias("model"), learning.probability().alias("predicted_pd"),
        F.col(TARGET).cast("int").alias(TARGET))


def _with_refused(done: DataFrame, refused: list[tuple[dict[str, str], str]]) -> DataFrame:
    """Result rows marked as run, and for each refused variant a row without figures that gives the reason."""
    rows = done.withColumns({"ran": F.lit(True), "reason": F.lit(None).cast("string")})
    for labels, reason in refused:
        known = {c: F.lit(v) for c, v in labels.items()} | {"ran": F.lit(False), "reason": F.lit(reason)}
        rows = rows.unionByName(done.sparkSession.range(1).select(
            *[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema.fields]))
    return rows


def imbalance_study(train: DataFrame, test: DataFrame, prep: PipelineModel | None = None) -> DataFrame:
    """Logistic regression (C = 1) without treatment, with class weights, with SMOTE.

    With too few minority rows for SMOTE its row says `ran` = false and why.
    """
    prep = prep or learning.fit_preprocessor(train)
    fold, held_out = learning.encode(prep, train), learning.encode(prep, test)
    strategies, refused = ["smote", "none", "class_weight"], []
    minority = resample.class_sizes(fold)[1]
    if minority <= resample.NEIGHBOURS:
        strategies.remove("smote")
        refused = [({"strategy": "smote"}, f"{minority} minority rows, need more than {resample.NEIGHBOURS}")]

    def strategy_scores(strategy: str) -> DataFrame:
        rows = fold
        if strategy == "smote":
            rows = resample.stack_synthetic(fold, cut_lineage(resample.smote(fold)))
        weighting = "balanced" if strategy == "class_weight" else None
        classifier = learning.fit_classifier(rows, "logistic_regression", weighting, c=1.0)
        return _score_encoded(classifier, held_out, strategy)

    scores = reduce(DataFrame.unionByName, at_once(
        train.sparkSession, strategy_scores, strategies))
    result = metrics.full_metrics(scores, "predicted_pd", TARGET, ["model"], strict=True)
    return _with_refused(result.select(
        F.col("model").alias("strategy"), "roc_auc", "pr_auc",
        F.col("precision").alias("precision_minority"), F.col("recall").alias("recall_minority"),
        F.col("f1").alias("f1_minority")), refused)


def encoded_minority(train: DataFrame, prep: PipelineModel, width: int) -> DataFrame:
    """(ID, x) of class 1 in the encoded space, cut to the first `width` positions."""
    rows = learning.encode(prep, train).filter(F.col(TARGET) == 1)
    return explain.with_array(rows).select(ID, F.slice("_x", 1, width).alias("x"))


def generator_study(train: DataFrame, wanted: int = 1500, prep: PipelineModel | None = None) -> DataFrame:
    """Linear generator on the numeric columns of class 1, with its diagnostics."""
    prep = prep or learning.fit_preprocessor(train)
    width = len(NUMERIC)
    real = cut_lineage(encoded_minority(train, prep, width))
    summary, synthetic = resample.linear_generator(real, width, wanted)
    if not summary["ran"]:
        return train.sparkSession.createDataFrame(
            [("ran", 0.0)], "metric string, value double")

    def named(df: DataFrame) -> DataFrame:
        return df.selectExpr(*[f"x[{i}] AS {n}" for i, n in enumerate(NUMERIC)])

    figures = [(k, float(v)) for k, v in summary.items()]
    return train.sparkSession.createDataFrame(figures, "metric string, value double").unionByName(
        resample.distribution_diagnostics(named(real), named(synthetic), NUMERIC))


def balanced_retraining(train: DataFrame, test: DataFrame, names: list[str] = CANDIDATES,
                        prep: PipelineModel | None = None) -> DataFrame:
    """Every classifier on the original and on the synthetically balanced fold,
    without class weights, measured on the same test fold. Where the generator
    refuses, the rows of the balanced fold say `ran` = false and why."""
    prep = prep or learning.fit_preprocessor(train)
    features = learning.feature_names(prep)
    width = len(features)
    fold, held_out = learning.encode(prep, train), learning.encode(prep, test)
    majority, minority = resample.class_sizes(fold)
    real = encoded_minority(train, prep, width)
    summary, generated = resample.linear_generator(real, width, majority - minority)
    variants, refused = {"none (baseline)": fold}, []
    if not summary["ran"]:
        refused = [({"model": name, "strategy": "synthetic_balanced"}, summary["reason"]) for name in names]
    else:
        valid = resample.make_array_valid(
            generated, width, list(learning.one_hot_blocks(prep).values()),
            [features.index(f) for f in FLAGS])
        variants["synthetic_balanced"] = resample.stack_synthetic(fold, cut_lineage(valid))

    def scores(task: tuple[str, str]) -> DataFrame:
        strategy, name = task
        classifier = learning.fit_classifier(variants[strategy], name, None)
        return _score_encoded(classifier, held_out, name).withColumn("strategy", F.lit(strategy))

    tasks = [(strategy, name) for name in reversed(names) for strategy in variants]
    parts = reduce(DataFrame.unionByName, at_once(train.sparkSession, scores, tasks, threads=6))
    return _with_refused(metrics.full_metrics(parts, "predicted_pd", TARGET, ["model", "strategy"]).select(
        "model", "strategy", "roc_auc", "pr_auc", "recall", "precision", "f1"), refused)


def comparison_with_earlier(retraining: DataFrame, imbalance: DataFrame) -> DataFrame:
    """Retraining rows plus the weighted and SMOTE rows of the imbalance study."""
    earlier = imbalance.filter(F.col("strategy").isin("class_weight", "smote")).select(
        F.lit("logistic_regression").alias("model"), "strategy", "roc_auc", "pr_auc",
        F.col("recall_minority").alias("recall"), F.col("precision_minority").alias("precision"),
        F.col("f1_minority").alias("f1"), "ran", "reason")
    return retraining.unionByName(earlier)


def brier_choice(raw: DataFrame, calibrated: DataFrame) -> DataFrame:
    """Brier score of both versions and the lower one as `chosen`."""
    both = raw.select(F.lit("raw").alias("version"), "predicted_pd", TARGET).unionByName(
        calibrated.select(F.lit("isotonic").alias("version"), "predicted_pd", TARGET))
    scores = metrics.class_metrics(both, "predicted_pd", TARGET, ["version"])
    wide = scores.groupBy().pivot("version", ["raw", "isotonic"]).agg(F.first("brier_score"))
    return wide.select(
        F.col("raw").alias("raw_brier"), F.col("isotonic").alias("isotonic_brier"),
        F.when(F.col("isotonic") < F.col("raw"), "isotonic").otherwise("raw").alias("chosen"))


def model_card(metric_rows: DataFrame, best: str, calibration: DataFrame, cuts: dict[str, float],
               trained_rows: int) -> DataFrame:
    row = metric_rows.filter(F.col("model") == best).withColumn("_one", F.lit(1))
    chosen = calibration.withColumn("_one", F.lit(1))
    used = F.when(F.col("chosen") == "isotonic", F.col("isotonic_brier")).otherwise(F.col("brier_score"))
    return row.join(F.broadcast(chosen), "_one").select(  # one row on each side
        F.col("model").alias("model_name"), F.col("chosen").alias("calibration_method"), "roc_auc",
        "pr_auc", "ks", used.alias("brier_score"),
        *[F.lit(v).alias(k) for k, v in cuts.items()],
        F.lit("class_weight").alias("imbalance_strategy"), F.lit(trained_rows).alias("trained_on_rows"))


def _section(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.lit(name).alias("section"), F.to_json(F.struct("*")).alias("body"))


def run_training(raw: DataFrame, out: str, names: list[str] = CANDIDATES,
                 progress: Callable[[str], None] = lambda _: None) -> DataFrame:
    """Whole run from raw accounts; writes tables, models and results under `out`.

    Returns the result bundle as (section, body) rows with JSON bodies.
    """
    spark: SparkSession = prepare(raw.sparkSession)
    write_table(engineer_features(clean_accounts(raw)), f"{out}/customers")
    customers = spark.read.parquet(f"{out}/customers")
    write_table(stratified_split(customers), f"{out}/folds")
    folds = spark.read.parquet(f"{out}/folds")
    train = folds.filter(F.col("fold") == "train").drop("fold")
    test = folds.filter(F.col("fold") == "test").drop("fold")
    sections = {"split": split_summary(folds)}

    prep = learning.fit_preprocessor(train)
    progress("studies and candidate models")
    studies = {
        "models": lambda: fit_candidates(train, prep, names),
        "imbalance_comparison": lambda: cut_lineage(imbalance_study(train, test, prep)),
        "generator_experiment": lambda: cut_lineage(generator_study(train, prep=prep)),
    }
    done = dict(zip(studies, at_once(spark, lambda make: make(), studies.values())))
    models = done.pop("models")
    sections |= done
    rows = cut_lineage(model_metrics(models, test))
    sections["model_metrics"] = rows
    best = metrics.best_model(rows).first()["model"]

    progress(f"calibration of {best}")
    calibrated = learning.fit_calibrated(train, best)
    raw_test = cut_lineage(learning.predict_with(models[best], test))
    calibrated_test = cut_lineage(calibrated(test))
    choice = cut_lineage(brier_choice(raw_test, calibrated_test))
    sections["calibration"] = choice
    isotonic = choice.first()["chosen"] == "isotonic"
    final_test = calibrated_test if isotonic else raw_test
    final_train = cut_lineage(calibrated(train) if isotonic else learning.predict_with(models[best], train))

    progress("reports")
    cuts = thresholds_of(band_thresholds(final_train.select("predicted_pd")))
    scored = final_test.withColumnRenamed(TARGET, "actual_default").withColumn(
        "risk_band", risk_band(F.col("predicted_pd"), cuts))
    write_table(scored, f"{out}/scored_customers", "risk_band")
    scored = spark.read.parquet(f"{out}/scored_customers")
    sections |= {
        "calibration_table": metrics.calibration_table(scored, "predicted_pd", "actual_default"),
        "psi_train_vs_test_pd": stability_index(final_train, final_test, ["predicted_pd"]),
        "fairness": portfolio.fairness(scored),
        "segmentation_thresholds": spark.createDataFrame([cuts]),
        "expected_loss": portfolio.expected_loss(scored),
        "model_card": model_card(rows, best, choice, cuts, train.count()),
    }
    features = learning.feature_names(prep)
    if "logistic_regression" in models:
        sections["logistic_regression_top_features"] = explain.top_coefficients(
            spark, features, models["logistic_regression"].stages[-1].coefficients)
    if best != "logistic_regression":
        sections[f"{best}_top_features"] = explain.top_importances(
            spark, features, models[best].stages[-1].featureImportances.toArray())

    models[best].write().overwrite().save(f"{out}/models/{best}")
    prep.write().overwrite().save(f"{out}/models/preprocessor")
    learning.save_calibrated(calibrated, f"{out}/models/calibrated")
    bundle = reduce(DataFrame.unionByName, [_section(table, name) for name, table in sections.items()])
    bundle.write.mode("overwrite").json(f"{out}/results")
    return spark.read.schema("section string, body string").json(f"{out}/results")


def portfolio_context(customers: DataFrame, scored: DataFrame, metric_rows: DataFrame,
                      drift: DataFrame) -> DataFrame:
    """Snapshot of the portfolio as one JSON document, for reports and prompts."""
    head = portfolio.headline_numbers(customers, scored).select(
        F.struct("total_customers", "default_rate_pct", "total_exposure").alias("portfolio"),
        F.lit(1).alias("_one"))
    segments = portfolio.segment_summary(scored).groupBy().agg(
        F.array_sort(F.collect_list(F.struct("band_no", "risk_band", "customers", "avg_predicted_pd")))
        .alias("risk_segments"), F.lit(1).alias("_one"))  # four bands
    groups = portfolio.fairness(scored).groupBy().agg(
        F.array_sort(F.collect_list(F.struct("dimension", "group", "n", "actual_default_rate",
                                             "avg_predicted_pd"))).alias("fairness"),
        F.lit(1).alias("_one"))  # a few groups
    quality = metric_rows.select(F.struct("roc_auc", "pr_auc", "ks", "brier_score").alias(
        "model_performance"), F.lit(1).alias("_one"))
    monitoring = drift.select(F.struct("psi").alias("monitoring"), F.lit(1).alias("_one"))
    whole = head
    for part in (segments, groups, quality, monitoring):
        whole = whole.join(part, "_one")  # one row on each side
    return whole.select(F.to_json(F.struct(
        "portfolio", "model_performance", "risk_segments", "monitoring", "fairness")).alias("context"))
