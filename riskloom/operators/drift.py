"""Population stability, drift tables and retraining triggers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.numbers import to_long
from riskloom.operators.ranking import cuts_passed, edge_columns, exact_quantiles
from riskloom.session import cut_lineage

FLOOR = 1e-6
EDGES = [i / 10 for i in range(1, 10)]


def stability_edges(expected: DataFrame, features: list[str]) -> DataFrame:
    """Inner decile cuts of the reference data: one row per feature, stored because
    both sides and the list of bins read them."""
    return cut_lineage(edge_columns(exact_quantiles(expected, features, EDGES), EDGES))


def _binned(df: DataFrame, features: list[str], edges: DataFrame, by: list[str]) -> DataFrame:
    """Rows per bin `[low, high)`. `edges` has one row per feature."""
    values = to_long(df, features, keep=by).filter(F.col("value").isNotNull())
    placed = values.join(F.broadcast(edges), "feature")
    return placed.groupBy(*by, "feature", cuts_passed(F.col("value"), len(EDGES), True).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))


def _shares(counts: DataFrame, by: list[str], name: str) -> DataFrame:
    part = Window.partitionBy(*by, "feature")  # at most ten bins
    return counts.select(*by, "feature", "bin", (F.col("n") / F.sum("n").over(part)).alias(name))


def _all_bins(edges: DataFrame) -> DataFrame:
    cuts = F.lit(0)
    for i in range(len(EDGES)):
        cuts = cuts + F.col(f"_e{i}").isNotNull().cast("int")
    return edges.select("feature", F.explode(F.sequence(F.lit(0), cuts)).alias("bin"))


def stability_index(expected: DataFrame, actual: DataFrame, features: list[str],
                    by: list[str] | None = None) -> DataFrame:
    """PSI per feature (and per `by` group of the actual data).

    Bins come from the reference data only; a bin that is empty on either side
    still counts, with a floored share.
    """
    by = by or []
    edges = stability_edges(expected, features)
    return index_against(edges, _binned(expected, features, edges, []), actual, features, by)


def index_against(edges: DataFrame, expected_counts: DataFrame, actual: DataFrame,
                  features: list[str], by: list[str]) -> DataFrame:
    return index_of_counts(edges, expected_counts, _binned(actual, features, edges, by), by)


def reference_counts(reference: DataFrame, features: list[str], edges: DataFrame) -> DataFrame:
    """(feature, bin, n) of the reference: all that later periods need of it."""
    return _binned(reference, features, edges, [])


def index_of_counts(edges: DataFrame, expected_counts: DataFrame, actual_counts: DataFrame, by: list[str]) -> DataFrame:
    actual_counts = cut_lineage(actual_counts)  # a row per bin, read twice below
    grid = actual_counts.select(*by, "feature").distinct().join(_all_bins(edges), "feature")
    filled = grid.join(
        _shares(expected_counts, [], "expected"), ["feature", "bin"], "left"
    ).join(_shares(actual_counts, by, "actual"), [*by, "feature", "bin"], "left")

    def floored(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(FLOOR))

    term = (floored("actual") - floored("expected")) * F.log(floored("actual") / floored("expected"))
    return filled.groupBy(*by, "feature").agg(F.sum(term).alias("psi"))


def drift_flag(index: Column) -> Column:
    return (
        F.when(index < 0.10, "stable").when(index < 0.25, "moderate_shift_investigate")
        .otherwise("major_shift_investigate_urgently")
    )


def feature_drift(reference: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """PSI and flag for every feature that both tables have, largest first."""
    shared = [f for f in features if f in reference.columns and f in current.columns]
    return stability_index(reference, current, shared).withColumn(
        "flag", drift_flag(F.col("psi"))).orderBy(F.desc("psi"), "feature")


def prediction_drift(reference: DataFrame, current: DataFrame, score: str) -> DataFrame:
    """Means, population deviations and PSI of the score on both sides."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.avg(score).alias(f"{name}_avg_pd"),
                      F.stddev_pop(score).alias(f"{name}_pd_std")
                      ).withColumn("feature", F.lit(score))

    index = stability_index(reference, current, [score])
    return index.join(side(reference, "reference"), "feature").join(
        side(current, "current"), "feature").drop("feature")


def band_divergence(scored: DataFrame, period: str, tolerance: float = 0.30) -> DataFrame:
    """Bands whose observed rate left the mean PD by more than `tolerance`
    (relative) in a period and in the period before it."""
    rates = scored.filter(F.col("risk_band").isNotNull()).groupBy("risk_band", period).agg(
        F.avg("predicted_pd").alias("avg_predicted_pd"),
        F.avg("actual_default").alias("actual_default_rate"))
    apart = F.try_divide(
        F.abs(F.col("actual_default_rate") - F.col("avg_predicted_pd")), F.col("avg_predicted_pd"))
    history = Window.partitionBy("risk_band").orderBy(period)  # one row per period
    diverged = rates.withColumn("relative_gap", apart).withColumn(
        "diverged", (F.col("relative_gap") > tolerance).cast("int"))
    before = F.coalesce(F.lag("diverged").over(history), F.lit(0))
    return diverged.withColumn("twice", F.col("diverged") * before)


def retraining_triggers(reference: DataFrame, current: DataFrame, validated: DataFrame,
                        periods: DataFrame, period: str, features: list[str],
                        brier_margin: float = 0.01) -> DataFrame:
    """One row per (trigger, period) with the observed value, its limit and `fired`.

    `validated` is the metric row of the test fold, `periods` the metric rows per
    monitoring period. A policy change cannot be computed and is not listed.
    """
    index = stability_index(reference, current, ["predicted_pd", *features], by=[period])
    twice = band_divergence(current, period).groupBy(period).agg(F.max("twice").alias("twice"))
    return trigger_rows(index, validated, periods, twice, period, brier_margin)


def trigger_rows(index: DataFrame, validated: DataFrame, periods: DataFrame, twice: DataFrame, period: str,
                 brier_margin: float = 0.01) -> DataFrame:
    """The triggers from stability per (period, feature), metrics per period and bands off twice per period."""
    def rows(table: DataFrame, name: str, value: Column, limit: Column, fired: Column):
        return table.select(F.lit(name).alias("trigger"), F.col(period).alias("period"),
                            value.cast("double").alias("value"), limit.cast("double").alias("limit"),
                            F.coalesce(fired.cast("int"), F.lit(0)).alias("fired"))

    score_drift = index.filter(F.col("feature") == "predicted_pd")
    worst = index.filter(F.col("feature") != "predicted_pd").groupBy(period).agg(
        F.max("psi").alias("psi"))
    base = validated.select(F.col("roc_auc").alias("base_auc"), F.col("brier_score").alias("base_brier"),
                            F.lit(1).alias("_one"))
    compared = periods.withColumn("_one", F.lit(1)).join(F.broadcast(base), "_one")  # one row
    fall = F.col("base_auc") - F.col("roc_auc")
    rise = F.col("brier_score") - F.col("base_brier")
    limit = F.lit(0.25)
    parts = [
        rows(score_drift, "predicted_pd_psi", F.col("psi"), limit, F.col("psi") > limit),
        rows(compared, "roc_auc_drop", fall, F.lit(0.03), fall > 0.03),
        rows(compared, "brier_increase", rise, F.lit(brier_margin), rise > brier_margin),
        rows(twice, "band_divergence_two_periods", F.col("twice"), F.lit(0.30), F.col("twice") == 1),
        rows(worst, "feature_psi", F.col("psi"), limit, F.col("psi") > limit),
    ]
    return reduce(DataFrame.unionByName, parts)
