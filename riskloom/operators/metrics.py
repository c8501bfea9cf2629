"""Discrimination, probability quality and calibration of scores.

Every metric row comes from one table: positives and negatives per distinct
score, with running totals from the top.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.binning import CALIBRATION_EDGES, bin_label, bin_number
from riskloom.operators.ranking import (
    cuts_passed, edge_columns, exact_quantiles, ranked_scores, running_totals, score_counts,
)

MODEL = "model"


def _rank_aggregates() -> dict[str, Column]:
    pos, neg = F.col("pos"), F.col("neg")
    wins = F.sum(neg * (F.col("cum_pos") - 0.5 * pos))
    step = F.sum(pos * F.try_divide(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")))
    gap = F.abs(F.try_divide(F.col("cum_pos"), F.col("total_pos"))
                - F.try_divide(F.col("cum_neg"), F.col("total_neg")))
    return {
        "roc_auc": F.try_divide(wins, F.sum(pos).cast("double") * F.sum(neg)),
        "pr_auc": F.try_divide(step, F.sum(pos)),
        "ks": F.max(gap),
    }


def _confusion(threshold: float, strict: bool = False) -> dict[str, Column]:
    """Cell counts at a threshold; the class is inclusive unless `strict`."""
    high = F.col("score") > threshold if strict else F.col("score") >= threshold
    return {
        "tn": F.sum(F.when(high, 0).otherwise(F.col("neg"))).cast("long"),
        "fp": F.sum(F.when(high, F.col("neg")).otherwise(0)).cast("long"),
        "fn": F.sum(F.when(high, 0).otherwise(F.col("pos"))).cast("long"),
        "tp": F.sum(F.when(high, F.col("pos")).otherwise(0)).cast("long"),
    }


def _brier() -> Column:
    squared = (F.col("pos") * F.pow(F.col("score") - 1.0, F.lit(2.0))
               + F.col("neg") * F.pow(F.col("score"), F.lit(2.0)))
    return F.sum(squared) / F.sum(F.col("pos") + F.col("neg"))


def _from_cells() -> dict[str, Column]:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    zero = F.lit(0.0)
    return {
        "precision": F.coalesce(F.try_divide(tp, tp + fp), zero),
        "recall": F.coalesce(F.try_divide(tp, tp + fn), zero),
        "f1": F.coalesce(F.try_divide(2.0 * tp, 2.0 * tp + fp + fn), zero),
    }


def rank_metrics(df: DataFrame, score: str, outcome: str, keys: list[str]) -> DataFrame:
    """ROC-AUC (ties one half), average precision, KS per key."""
    ranked = ranked_scores(df, keys, score, outcome)
    return ranked.groupBy(*keys).agg(*[c.alias(n) for n, c in _rank_aggregates().items()])


def class_metrics(df: DataFrame, score: str, outcome: str, keys: list[str],
                  threshold: float = 0.5, strict: bool = False) -> DataFrame:
    """Confusion cells, precision, recall, F1 and Brier score, without any ranking."""
    cells = score_counts(df, keys, score, outcome).groupBy(*keys).agg(
        _brier().alias("brier_score"),
        *[c.alias(n) for n, c in _confusion(threshold, strict).items()])
    return cells.select("*", *[c.alias(n) for n, c in _from_cells().items()])


def full_metrics(df: DataFrame, score: str, outcome: str, keys: list[str],
                 threshold: float = 0.5, strict: bool = False) -> DataFrame:
    """One complete metric row per key."""
    return metrics_of_counts(score_counts(df, keys, score, outcome), keys, threshold, strict)


def metrics_of_counts(counts: DataFrame, keys: list[str], threshold: float = 0.5, strict: bool = False) -> DataFrame:
    """One complete metric row per key from (keys, score, pos, neg)."""
    ranked = running_totals(counts, "score", ["pos", "neg"], keys, descending=True)
    aggregates = _rank_aggregates() | {"brier_score": _brier()} | _confusion(threshold, strict)
    rows = ranked.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()])
    return rows.select("*", *[c.alias(n) for n, c in _from_cells().items()],
                       F.lit(threshold).alias("threshold"))


def curve_points(df: DataFrame, score: str, outcome: str, keys: list[str]) -> DataFrame:
    """One point of the ROC and the precision-recall curve per distinct score."""
    return ranked_scores(df, keys, score, outcome).select(
        *keys, "score",
        F.try_divide("cum_neg", "total_neg").alias("fpr"),
        F.try_divide("cum_pos", "total_pos").alias("tpr"),
        F.try_divide(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        F.try_divide("cum_pos", "total_pos").alias("recall"),
    )


def best_model(metrics: DataFrame) -> DataFrame:
    """The model with the highest mean of ROC-AUC and average precision."""
    ranked = metrics.withColumn("selection_score", (F.col("roc_auc") + F.col("pr_auc")) / 2.0)
    return ranked.orderBy(F.desc("selection_score"), MODEL).limit(1)


def comparison_table(metrics: DataFrame, shown: list[str]) -> DataFrame:
    """Metrics as rows, models as columns."""
    models = [r[0] for r in metrics.select(MODEL).orderBy(MODEL).collect()]  # one per model
    long = metrics.unpivot([MODEL], shown, "metric", "value")
    return long.groupBy("metric").pivot(MODEL, models).agg(F.first("value"))


def calibration_table(df: DataFrame, score: str, outcome: str) -> DataFrame:
    """Customers, mean PD and observed rate per PD band; empty bands do not appear."""
    column = F.col(score)
    banded = df.select(
        bin_number(column, CALIBRATION_EDGES, include_lowest=True).alias("band_no"),
        bin_label(column, CALIBRATION_EDGES, include_lowest=True).alias("band"),
        column.alias("p"), F.col(outcome).alias("y"))
    return banded.filter(F.col("band").isNotNull()).groupBy("band_no", "band").agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg("p").alias("avg_predicted_pd"),
        F.avg("y").alias("actual_default_rate"),
    ).orderBy("band_no")


def reliability_curve(df: DataFrame, score: str, outcome: str, bins: int = 10) -> DataFrame:
    """Mean PD against observed rate in quantile bins; a value on an edge belongs below it."""
    inner = [i / bins for i in range(1, bins)]
    edges = edge_columns(exact_quantiles(df, [score], inner), inner)
    counts = score_counts(df, [], score, outcome).withColumn("feature", F.lit(score))
    # `edges` has one row
    placed = counts.join(F.broadcast(edges), "feature").withColumn(
        "bin", cuts_passed(F.col("score"), len(inner), inclusive=False))
    size = F.sum(F.col("pos") + F.col("neg"))
    return placed.groupBy("bin").agg(
        size.alias("customers"),
        (F.sum(F.col("score") * (F.col("pos") + F.col("neg"))) / size).alias("mean_predicted"),
        (F.sum("pos") / size).alias("fraction_positive"),
    ).orderBy("bin")
