"""Scoring of records as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from riskloom.operators.audit import split_valid
from riskloom.operators.scoring import Predictor, score_accounts, score_response
from riskloom.schema import account_schema


def record_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Scoring requests as JSON files that land in a folder."""
    reader = spark.readStream.schema(account_schema(target=None))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(folder)


def scored_stream(records: DataFrame, predict: Predictor, thresholds: dict[str, float]) -> DataFrame:
    """Valid records of the stream with PD, band and class. No state is kept."""
    valid, _ = split_valid(records)
    return score_response(score_accounts(valid, predict, thresholds))


def quarantine_stream(records: DataFrame) -> DataFrame:
    """Records that broke a rule, with the names of the rules."""
    return split_valid(records)[1]


def run_once(stream: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Process everything that is waiting into Parquet, exactly once per record."""
    return (stream.writeStream.format("parquet").outputMode("append")
            .option("path", sink).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
