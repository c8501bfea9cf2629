"""Stored tables that reports and models read.

Like the account database of a risk department: the panel is derived once and
written, and every report reads only the columns and bands it needs. Tables are
written to the shared folder, once per application and source folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.binning import risk_band
from riskloom.operators.clean import clean_accounts
from riskloom.operators.features import engineer_features
from riskloom.operators.scoring import band_thresholds, scorecard_predictor, thresholds_of
from riskloom.operators.split import stratified_split
from riskloom.schema import TARGET
from riskloom.session import prepare, scratch_path
from riskloom.sources.accounts import write_table
from riskloom.sources.panel import account_panel

_WRITTEN: dict[tuple[str, str, str], object] = {}


def once(spark: SparkSession, folder: str, name: str, make):
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _WRITTEN:
        prepare(spark)
        _WRITTEN[key] = make()
    return _WRITTEN[key]


def _stored(spark: SparkSession, folder: str, name: str, build, partition_by: str | None = None) -> DataFrame:
    path = once(spark, folder, name,
                 lambda: write_table(build(), scratch_path(spark, name), partition_by))
    return spark.read.parquet(path)


def raw_accounts(spark: SparkSession, folder: str) -> DataFrame:
    return _stored(spark, folder, "raw_accounts", lambda: account_panel(spark, folder))


def featured(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned accounts with the 39 columns, computed from the stored panel."""
    return engineer_features(clean_accounts(raw_accounts(spark, folder)))


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return _stored(spark, folder, "customers", lambda: featured(spark, folder))


def folds(spark: SparkSession, folder: str) -> DataFrame:
    """`customers` with the fold of each account."""
    return _stored(spark, folder, "folds", lambda: stratified_split(customers(spark, folder)))


def train_fold(spark: SparkSession, folder: str) -> DataFrame:
    return folds(spark, folder).filter(F.col("fold") == "train").drop("fold")


def test_fold(spark: SparkSession, folder: str) -> DataFrame:
    return folds(spark, folder).filter(F.col("fold") == "test").drop("fold")


def scored_population(spark: SparkSession, folder: str) -> DataFrame:
    """Both folds with the scorecard PD; the outcome is `actual_default`."""
    predict = scorecard_predictor()
    return predict(folds(spark, folder)).withColumnRenamed(TARGET, "actual_default")


def thresholds(spark: SparkSession, folder: str) -> dict[str, float]:
    """Band cut points of the training fold."""
    def compute():
        train = scored_population(spark, folder).filter(F.col("fold") == "train")
        return thresholds_of(band_thresholds(train.select("predicted_pd")))

    return once(spark, folder, "thresholds", compute)


def scored_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Scored test fold, one folder per risk band."""
    def build():
        cuts = thresholds(spark, folder)
        test = scored_population(spark, folder).filter(F.col("fold") == "test").drop("fold")
        return test.withColumn("risk_band", risk_band(F.col("predicted_pd"), cuts))

    return _stored(spark, folder, "scored_customers", build, "risk_band")
