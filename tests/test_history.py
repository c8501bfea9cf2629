"""State across micro-batches: what is written doesn't depend on how rows arrive or on restarts."""

import pytest
from pyspark.sql import functions as F

from riskloom.operators import drift
from riskloom.operators.metrics import full_metrics
from riskloom.session import scratch_path
from riskloom.streaming import history, monitoring
from verification import streams

SCHEMA = "ts timestamp, p double, y int, risk_band string, predicted_pd double, actual_default int"
BANDS = ["Low", "Moderate", "High"]


@pytest.fixture(scope="module")
def rows(spark):
    """Six days of scored records; a third of them in one band and with one score."""
    table = spark.range(1200).select(
        (F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 432)).alias("ts"),
        F.when(F.col("id") % 3 == 0, 0.25).otherwise((F.col("id") * 37 % 211) / 211).alias("p"),
        (F.xxhash64("id") % 4 == 0).cast("int").alias("y"),
        F.when(F.col("id") % 3 == 0, "Low").otherwise(F.element_at(F.array(*map(F.lit, BANDS)), (F.col("id") % 7 % 3 + 1).cast("int"))).alias("risk_band"), "id")
    return table.withColumns({"predicted_pd": F.col("p"), "actual_default": F.col("y")}).cache()


def replay(spark, start, parts, sink, progress):
    """Land the parts one by one; every landing is a run of its own that continues the one before."""
    folder = scratch_path(spark, "landed")
    for part in parts:
        part.select("ts", "p", "y", "risk_band", "predicted_pd", "actual_default").write.mode("append").parquet(folder)
        history.run_upserts(start(spark.readStream.schema(SCHEMA).parquet(folder)), sink, progress)
    return spark.read.parquet(sink)


def metric_rows(df):
    return sorted((str(r["window_start"]), r["tp"], r["fp"], r["fn"], r["tn"], *(round(r[c], 12) for c in ("roc_auc", "pr_auc", "ks", "brier_score"))) for r in df.collect())


@pytest.mark.parametrize("order", ["time", "mixed"])
def test_rank_metrics_of_windows_in_any_arrival(spark, rows, order):
    history.with_state(spark)
    cut = F.col("id") * 3 / 1200 if order == "time" else F.pmod(F.xxhash64("id"), F.lit(3))
    parts = [rows.filter(F.floor(cut) == i) for i in range(3)]
    late = "1 hour" if order == "time" else "30 days"
    sink, progress = scratch_path(spark, "sink"), scratch_path(spark, "progress")
    written = replay(spark, lambda s: history.score_counts(s, "ts", "p", "y", late=late), parts, sink, progress)
    found = history.window_rank_metrics(written)
    whole = full_metrics(rows.withColumn("window_start", F.date_trunc("day", "ts")), "p", "y", ["window_start"])
    assert metric_rows(found) == metric_rows(whole)
    states = [r["open"] for r in found.orderBy("window_start").collect()]
    assert states == ([0, 0, 0, 0, 0, 1] if order == "time" else [1] * 6)


def test_a_batch_written_twice_changes_nothing(spark, rows):
    history.with_state(spark)
    sink = scratch_path(spark, "sink")
    written = replay(spark, lambda s: history.score_counts(s, "ts", "p", "y"), [rows], sink, scratch_path(spark, "progress"))
    once = metric_rows(history.window_rank_metrics(written))
    assert metric_rows(history.window_rank_metrics(written.unionByName(written))) == once


def test_bands_off_twice_after_restarts(spark, rows):
    history.with_state(spark)
    batch = drift.band_divergence(rows.withColumn("day", F.date_trunc("day", "ts")), "day", 0.3)
    wanted = sorted((r["risk_band"], str(r["day"]), bool(r["twice"])) for r in batch.collect())
    parts = [rows.filter(F.floor(F.col("id") / 300) == i) for i in range(4)]
    written = replay(spark, lambda s: history.band_history(s, "ts", "1 day"), parts, scratch_path(spark, "sink"), scratch_path(spark, "progress"))
    newest = history.newest_bands(written)
    found = sorted((r["risk_band"], str(r["day"]), r["twice"]) for r in newest.withColumn("day", F.timestamp_micros("period_start")).collect())
    assert found == wanted and any(x[2] for x in wanted)
    closed = {str(r["day"])[:10]: r["closed"] for r in newest.withColumn("day", F.timestamp_micros("period_start")).collect()}
    assert [closed[d] for d in sorted(closed)] == [True] * 5 + [False]


def test_feature_counts_equal_the_batch(spark, rows):
    edges = drift.stability_edges(rows.limit(400), ["p"])
    folder, sink = scratch_path(spark, "landed"), scratch_path(spark, "sink")
    rows.select("ts", "p").repartition(3).write.parquet(folder)
    stream = spark.readStream.schema("ts timestamp, p double").option("maxFilesPerTrigger", 1).parquet(folder)
    history.run_upserts(history.feature_counts(stream, "ts", ["p"], edges, "1 day", "30 days"), sink, scratch_path(spark, "progress"), "update")
    newest = spark.read.parquet(sink).groupBy("window_start", "feature", "bin").agg(F.max("n").alias("n"))
    days = rows.withColumn("window_start", F.unix_micros(F.date_trunc("day", "ts")))
    counts = drift._binned(days, ["p"], edges, ["window_start"])
    assert newest.exceptAll(counts.select(*newest.columns)).count() == 0 and newest.count() == counts.count()


def test_newest_windows_tell_open_ones(spark, rows):
    sink, folder = scratch_path(spark, "sink"), scratch_path(spark, "landed")
    rows.select("ts", "p").write.parquet(folder)
    stream = spark.readStream.schema("ts timestamp, p double").parquet(folder)
    history.run_upserts(monitoring.window_counts(stream, "ts", "p", [0.5]), sink, scratch_path(spark, "progress"), "update")
    newest = monitoring.newest_windows(spark.read.parquet(sink)).orderBy("window_start").collect()
    assert [r["open"] for r in newest] == [0] * 5 + [1] and sum(r["n"] for r in newest) == 1200


def test_a_replayed_period_is_read_by_many_tasks(spark, monkeypatch):
    """The files of a period grow with its rows, and a batch takes the files of one period."""
    folder = "/root/testdata/sf0.01"
    monkeypatch.setattr(streams, "FILE_ROWS", 10)
    landed = streams._replayed_periods(spark, folder)()
    sink = scratch_path(spark, "sink")
    history.run_upserts(landed.select("period", F.input_file_name().alias("file"), "ID"), sink, scratch_path(spark, "progress"))
    batches = spark.read.parquet(sink).groupBy("number").agg(
        F.countDistinct("period").alias("periods"), F.countDistinct("file").alias("files"), F.count("*").alias("n")).collect()
    whole = streams.monitored(spark, folder).groupBy("period").count().collect()
    files = min(r["count"] for r in whole) // 10
    assert files > 1 and [(r["periods"], r["files"]) for r in batches] == [(1, files)] * 4
    assert sorted(r["n"] for r in batches) == sorted(r["count"] for r in whole)
