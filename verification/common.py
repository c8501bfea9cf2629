"""Shared pieces of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.numbers import micro
from riskloom.operators.scoring import SCORECARD, logistic, scorecard_margin
from riskloom.plans import warehouse
from riskloom.schema import NUMERIC

# Second scorecard, so that model comparisons have two models to compare.
OTHER_CARD = {"intercept": -1.5, "N_MONTHS_DELINQUENT": 0.20, "PAY_0_LATE": 0.60, "UTIL_AVG": 0.30}


def six(df: DataFrame) -> DataFrame:
    """Doubles at six decimals, cut just beside the half as in the SQL, so that two
    engines agree on every digit shown."""
    return df.selectExpr(*[
        f"CAST(floor(`{f.name}` * 1e6D + 0.4999D) AS DOUBLE) / 1e6D AS `{f.name}`"
        if isinstance(f.dataType, T.DoubleType) else f"`{f.name}`" for f in df.schema.fields
    ])


def two_models(spark: SparkSession, folder: str) -> DataFrame:
    """(model, p, y) of two scorecards on the scored test fold, from one scan."""
    scored = warehouse.scored_customers(spark, folder)
    cards = {"first": SCORECARD, "second": OTHER_CARD}
    scores = F.array(*[
        F.struct(F.lit(name).alias("model"), micro(logistic(scorecard_margin(card))).alias("p"))
        for name, card in cards.items()
    ])
    return scored.select(F.col("actual_default").alias("y"), F.inline(scores))


def monitored(spark: SparkSession, folder: str) -> DataFrame:
    """Scored test fold in four monitoring periods, by ID."""
    return warehouse.scored_customers(spark, folder).withColumn(
        "period", (F.lit(1) + F.col("ID") % 4).cast("int"))


def six_features(df: DataFrame) -> DataFrame:
    """The numeric features at six decimals, all else as it is: a trend that is zero but for its
    last bit would otherwise fall on either side of a cut at zero."""
    return df.withColumns({c: F.expr(f"CAST(floor(CAST(`{c}` AS DOUBLE) * 1e6D + 0.4999D) AS DOUBLE) / 1e6D") for c in NUMERIC})
