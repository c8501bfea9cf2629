"""Probability of default, risk band and class for account records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.binning import risk_band
from riskloom.functions.numbers import micro
from riskloom.operators.clean import clean_accounts
from riskloom.operators.features import engineer_features
from riskloom.operators.ranking import exact_quantiles
from riskloom.schema import TARGET

Predictor = Callable[[DataFrame], DataFrame]

# The scorecard and the shares that cut the training scores into bands.
SCORECARD = {
    "intercept": -2.0, "N_MONTHS_DELINQUENT": 0.35, "PAY_0_LATE": 0.45, "UTIL_AVG": 0.10,
}
BAND_SHARES = {"low_max": 0.50, "moderate_max": 0.80, "high_max": 0.95}


def scorecard_terms() -> dict[str, Column]:
    """The variables of the scorecard."""
    return {
        "N_MONTHS_DELINQUENT": F.col("N_MONTHS_DELINQUENT").cast("double"),
        "PAY_0_LATE": F.greatest(F.col("PAY_0"), F.lit(0)).cast("double"),
        "UTIL_AVG": F.col("UTIL_AVG"),
    }


def logistic(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def scorecard_margin(weights: dict[str, float] = SCORECARD) -> Column:
    margin = F.lit(weights["intercept"])
    for name, term in scorecard_terms().items():
        margin = margin + F.lit(weights[name]) * term
    return margin


def scorecard_predictor(weights: dict[str, float] = SCORECARD) -> Predictor:
    """Closed-form predictor: one column expression over the featured table."""
    def predict(featured: DataFrame) -> DataFrame:
        return featured.withColumn("predicted_pd", micro(logistic(scorecard_margin(weights))))

    return predict


def band_thresholds(train_scores: DataFrame, score: str = "predicted_pd") -> DataFrame:
    """The three cut points of the training scores as one row."""
    cuts = exact_quantiles(train_scores, [score], list(BAND_SHARES.values()))
    return cuts.groupBy().agg(*[
        F.max(F.when(F.col("prob") == share, F.col("value"))).alias(name)
        for name, share in BAND_SHARES.items()
    ])


def thresholds_of(row: DataFrame) -> dict[str, float]:
    """The one threshold row as plain numbers, as a scoring job takes them."""
    return {name: float(value) for name, value in row.first().asDict().items()}


def predicted_class(score: str = "predicted_pd") -> Column:
    return (F.col(score) >= 0.5).cast("int")


def add_band_and_class(df: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    return df.select(
        "*", risk_band(F.col("predicted_pd"), thresholds).alias("risk_band"),
        predicted_class().alias("predicted_class"))


def score_accounts(raw: DataFrame, predict: Predictor, thresholds: dict[str, float]) -> DataFrame:
    """Raw records to scored records: clean, derive features, predict, band.

    Row-wise throughout, so the same function serves a batch and a stream. The
    outcome column is not needed and is dropped when present.
    """
    featured = engineer_features(clean_accounts(raw))
    featured = featured.drop(TARGET) if TARGET in featured.columns else featured
    return add_band_and_class(predict(featured), thresholds)


def score_response(scored: DataFrame) -> DataFrame:
    return scored.select("ID", "predicted_pd", "risk_band", "predicted_class")


def score_batch(records: DataFrame, predict: Predictor, thresholds: dict[str, float]) -> DataFrame:
    """Batch request: an empty list of records is an error."""
    if records.isEmpty():
        raise ValueError("no customers provided")
    return score_response(score_accounts(records, predict, thresholds))


PROMPT_TURNS = 10


def prompt_rows(conversations: DataFrame, context: DataFrame, turns: int = PROMPT_TURNS) -> DataFrame:
    """Per conversation: its last turns in order and the verified context as JSON.

    `row_number() <= k` is applied per task before the shuffle, so a conversation
    of any length sends only k rows per task. `context` is one row with `context`.
    """
    newest = Window.partitionBy("conv_id").orderBy(F.desc("turn"), F.desc("role"), F.desc("text"))
    recent = conversations.select("conv_id", "turn", "role", "text").withColumn(
        "_back", F.row_number().over(newest)).filter(F.col("_back") <= turns)
    lines = recent.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("_turns"))
    history = F.array_join(
        F.transform("_turns", lambda t: F.concat(t["role"], F.lit(": "), t["text"])), "\n")
    one = context.select("context", F.lit(1).alias("_one"))
    return lines.select("conv_id", "n_turns", history.alias("history"), F.lit(1).alias("_one")).join(
        F.broadcast(one), "_one").drop("_one")
