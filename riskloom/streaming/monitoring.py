"""Windowed monitoring of scored records and of any numeric feature."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.drift import EDGES, FLOOR, drift_flag


def event_stream(spark: SparkSession, path: str, like: DataFrame, time: str = "ts") -> DataFrame:
    """A Parquet folder or file replayed as a stream.

    Watermarks need an instant: a time without zone is read as UTC, whatever the
    time zone of the session.
    """
    folder, _, name = path.rstrip("/").rpartition("/")
    stream = spark.readStream.schema(like.schema).option("pathGlobFilter", name).parquet(folder)
    if isinstance(like.schema[time].dataType, T.TimestampNTZType):
        stream = stream.withColumn(
            time, F.from_utc_timestamp(F.col(time).cast("timestamp"), F.current_timezone()))
    return stream


def utc_day(time: str) -> Column:
    """Calendar day of an instant in UTC."""
    return F.date_format(F.to_utc_timestamp(F.col(time), F.current_timezone()), "yyyy-MM-dd")


def fixed_edges(row: DataFrame) -> list[float]:
    """Inner cut points of one feature, from the reference batch: nine numbers at most."""
    found = row.first()
    return [found[f"_e{i}"] for i in range(len(EDGES)) if found[f"_e{i}"] is not None]


def _bin(value: Column, edges: list[float]) -> Column:
    number = F.lit(0)
    for edge in edges:
        number = number + (value >= F.lit(edge)).cast("int")
    return number


def window_counts(stream: DataFrame, time: str, value: str, edges: list[float], length: str = "1 day",
                  late: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Count, mean and deviation of a value per time window, with the count of each
    reference bin. Sums and counts only, so the state is one small row per window
    and late rows merge in until the watermark passes."""
    number = _bin(F.col(value), edges)
    bins = [F.sum((number == i).cast("long")).alias(f"bin_{i}") for i in range(len(edges) + 1)]
    return stream.filter(F.col(value).isNotNull()).withWatermark(time, late).groupBy(
        F.window(time, length, slide).alias("w") if slide else F.window(time, length).alias("w")
    ).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"),
          F.stddev_pop(value).alias("std"), F.max(time).alias("last"), *bins
          ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "mean", "std", "last",
                   *[f"bin_{i}" for i in range(len(edges) + 1)])


def newest_windows(written: DataFrame, late: str = "1 hour") -> DataFrame:
    """Windows of an upsert table as written last, the open ones with `open` = 1.

    Counts only grow, so the row with the most records is the newest. A window is
    closed when the watermark, the latest time seen less the delay, has passed its end.
    """
    rest = [c for c in written.columns if c not in ("window_start", "number")]
    newest = written.groupBy("window_start").agg(F.max_by(F.struct(*rest), "n").alias("_last")).select(
        "window_start", *[F.col(f"_last.{c}").alias(c) for c in rest])
    seen = written.agg(F.max("last").alias("_seen"))  # one row
    passed = F.col("window_end") <= F.col("_seen") - F.expr(f"INTERVAL {late}")
    return newest.join(F.broadcast(seen)).withColumn("open", (~passed).cast("int")).drop("_seen", "last", "window_end")


def window_stability(counts: DataFrame, reference: list[float]) -> DataFrame:
    """PSI and flag per finished window against reference shares per bin."""
    index = F.lit(0.0)
    for i, share in enumerate(reference):
        floor = F.lit(share if share > 0 else FLOOR)
        actual = F.col(f"bin_{i}") / F.col("n")
        actual = F.when(actual == 0, F.lit(FLOOR)).otherwise(actual)
        index = index + (actual - floor) * F.log(actual / floor)
    return counts.select("window_start", "n", "mean", "std", index.alias("psi"), *[c for c in ("open",) if c in counts.columns]).withColumn(
        "flag", drift_flag(F.col("psi")))


def reference_shares(reference: DataFrame, value: str, edges: list[float]) -> list[float]:
    """Share of the reference rows in each bin: ten numbers at most."""
    number = _bin(F.col(value), edges)
    row = reference.filter(F.col(value).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum((number == i).cast("long")).alias(f"b{i}") for i in range(len(edges) + 1)]).first()
    return [row[f"b{i}"] / row["n"] for i in range(len(edges) + 1)]


def window_quality(stream: DataFrame, time: str, score: str, outcome: str, length: str = "1 day",
                   late: str = "1 hour", threshold: float = 0.5) -> DataFrame:
    """Brier score and confusion cells per time window."""
    p, y = F.col(score), F.col(outcome)
    high = p >= threshold

    def cell(predicted: Column, actual: int) -> Column:
        return F.sum((predicted & (y == actual)).cast("long"))

    return stream.withWatermark(time, late).groupBy(F.window(time, length).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.pow(p - y, F.lit(2.0))).alias("brier_score"),
        cell(high, 1).alias("tp"), cell(high, 0).alias("fp"),
        cell(~high, 1).alias("fn"), cell(~high, 0).alias("tn"), F.max(time).alias("last"),
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "last", "n", "brier_score", "tp", "fp", "fn", "tn")


def run_to_table(stream: DataFrame, sink: str, checkpoint: str, mode: str = "append") -> None:
    """Drain the waiting input into Parquet and stop."""
    query = (stream.writeStream.format("parquet").outputMode(mode).option("path", sink)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()

