"""Streams replayed to the end from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import drift, metrics, scoring
from riskloom.plans import warehouse as W
from riskloom.schema import ID, NUMERIC, TARGET
from riskloom.session import cut_lineage, scratch_path
from riskloom.sources.panel import read_table
from riskloom.streaming import history, monitoring, scoring as arriving
from verification.common import monitored, six, six_features
from verification.oracle import MODELS, PANEL, SCORED, psi
from verification.oracle import six as sql_six
from verification.scores import ORACLE as _SCORES

ORACLE_D7 = _SCORES["d7_retraining_triggers"]

QUERIES, ORACLE = {}, {}


def register(name, query, sql=None):
    QUERIES[name] = query
    if sql is not None:
        ORACLE[name] = sql


def _landed(spark, d, bent=False):
    """The panel as JSON requests in a folder that a stream watches."""
    folder = scratch_path(spark, "landing")
    records = W.raw_accounts(spark, d).drop(TARGET)
    if bent:
        records = records.withColumn("SEX", F.when(F.col(ID) % 7 == 0, 3).otherwise(F.col("SEX")))
    records.write.json(folder)
    return folder


def st1_scored(spark, d):
    records = arriving.record_stream(spark, _landed(spark, d), files_per_trigger=1)
    scored = arriving.scored_stream(records, scoring.scorecard_predictor(), W.thresholds(spark, d))
    sink = scratch_path(spark, "scored_stream")
    arriving.run_once(scored, sink, scratch_path(spark, "progress")).awaitTermination()
    return spark.read.parquet(sink)


def st1_quarantine(spark, d):
    records = arriving.record_stream(spark, _landed(spark, d, bent=True))
    sink = scratch_path(spark, "quarantine")
    arriving.run_once(arriving.quarantine_stream(records), sink, scratch_path(spark, "progress")).awaitTermination()
    return spark.read.parquet(sink).select(ID, F.array_join("problems", "; ").alias("problems"))


def _events(spark, d):
    events = read_table(spark, d, "events")
    return events, monitoring.event_stream(spark, f"{d}/events.parquet", events)


def _reference(events):
    return events.filter(F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")).select("value")


def st2_windows(spark, d):
    """PSI, mean and deviation of the event value per day against the first half."""
    events, stream = _events(spark, d)
    reference = _reference(events)
    edges = monitoring.fixed_edges(drift.stability_edges(reference, ["value"]))
    counts = monitoring.window_counts(stream, "ts", "value", edges)
    sink = scratch_path(spark, "windows")
    history.run_upserts(counts, sink, scratch_path(spark, "progress"), "update")
    shares = monitoring.reference_shares(reference, "value", edges)
    return six(monitoring.window_stability(monitoring.newest_windows(spark.read.parquet(sink)), shares)).withColumn(
        "window_start", monitoring.utc_day("window_start"))


def _scored_events(stream):
    """Event stream with a score and an outcome, for the quality monitors."""
    return stream.select("ts", (F.col("value") / (F.col("value") + 50.0)).alias("p"),
                         (F.col("event_type") == "purchase").cast("int").alias("y"))


def st2_quality(spark, d):
    _, stream = _events(spark, d)
    sink = scratch_path(spark, "quality")
    quality = monitoring.window_quality(_scored_events(stream), "ts", "p", "y")
    history.run_upserts(quality, sink, scratch_path(spark, "progress"), "update")
    return six(monitoring.newest_windows(spark.read.parquet(sink))).withColumn("window_start", monitoring.utc_day("window_start"))


def st2_ranks(spark, d):
    """Exact rank metrics per day from state that merges however the rows arrive."""
    _, stream = _events(history.with_state(spark), d)
    sink = scratch_path(spark, "ranks")
    history.run_upserts(history.score_counts(_scored_events(stream), "ts", "p", "y"), sink, scratch_path(spark, "progress"))
    return six(history.window_rank_metrics(spark.read.parquet(sink)).drop("threshold")).withColumn(
        "window_start", monitoring.utc_day("window_start"))


def st2_sliding(spark, d):
    """PSI of the event value over three days, every day."""
    events, stream = _events(spark, d)
    reference = _reference(events)
    edges = monitoring.fixed_edges(drift.stability_edges(reference, ["value"]))
    counts = monitoring.window_counts(stream, "ts", "value", edges, length="3 days", slide="1 day")
    sink = scratch_path(spark, "sliding")
    history.run_upserts(counts, sink, scratch_path(spark, "progress"), "update")
    shares = monitoring.reference_shares(reference, "value", edges)
    rows = monitoring.window_stability(monitoring.newest_windows(spark.read.parquet(sink)), shares)
    return six(rows.select("window_start", "n", "psi", "open")).withColumn("window_start", monitoring.utc_day("window_start"))


#: rows in a file of a replayed period; a file is read by one task
FILE_ROWS = 10_000


def _replayed_periods(spark, d):
    """The scored test fold as a stream: a day per monitoring period; periods arrive one by one, each in files of its own."""
    folder = scratch_path(spark, "periods")
    day = F.timestamp_micros(F.lit(1704067200_000000) + F.col("period").cast("long") * 86400_000000 + F.col(ID) % 86400 * 1_000_000)
    landed = six_features(monitored(spark, d)).withColumn("ts", day)
    sizes = {r["period"]: r["count"] for r in monitored(spark, d).groupBy("period").count().collect()}  # four rows
    files = max(1, min(sizes.values(), default=0) // FILE_ROWS)
    for period in range(1, 5):
        landed.filter(F.col("period") == period).repartition(files).write.mode("append").parquet(folder)
    schema = spark.read.parquet(folder).schema
    return lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def d7_stream(spark, d):
    """Retraining triggers of replayed periods, from state that goes on from one period to the next."""
    history.with_state(spark)
    train = six_features(W.scored_population(spark, d).filter(F.col("fold") == "train"))
    features = ["predicted_pd", *NUMERIC]
    edges = drift.stability_edges(train, features)
    expected = cut_lineage(drift.reference_counts(train, features, edges))
    stream = _replayed_periods(spark, d)
    day, late = "1 day", "2 days"
    parts = {
        "scores": (history.score_counts(stream(), "ts", "predicted_pd", "actual_default", day, late), "append"),
        "bands": (history.band_history(stream(), "ts", day, late), "append"),
        "bins": (history.feature_counts(stream(), "ts", features, edges, day, late), "update"),
    }
    written = {}
    for name, (rows, mode) in parts.items():
        written[name], progress = scratch_path(spark, name), scratch_path(spark, "progress")
        history.run_upserts(rows, written[name], progress, mode)
    validated = metrics.full_metrics(
        W.scored_customers(spark, d).withColumn("model", F.lit("scorecard")), "predicted_pd", "actual_default", ["model"])
    rows = history.replayed_triggers(*[spark.read.parquet(written[n]) for n in parts], edges, expected, validated)
    number = ((F.col("period") - 1704067200_000000) / 86400_000000).cast("int")
    return six(rows.withColumn("period", number))


register("st1_scored_stream", st1_scored, f"""WITH {SCORED}
    SELECT ID, predicted_pd, risk_band, CAST(predicted_pd >= 0.5 AS INTEGER) AS predicted_class FROM banded""")
register("st1_quarantine_stream", st1_quarantine, f"""WITH {PANEL}
    SELECT ID, 'SEX out of range' AS problems FROM panel WHERE ID % 7 = 0""")
# a day is open until the watermark passes its end
_OPEN = "CAST({} + INTERVAL 1 DAY > (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR AS INTEGER)"
register("st2_window_stability", st2_windows, """WITH before AS (SELECT value FROM events WHERE ts < TIMESTAMP '2024-01-16'),
    days AS (SELECT ts, value, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS day FROM events), """ + psi(
    "before", "days", ["value"], by="day") + f"""
    SELECT strftime(DATE '2024-01-01' + CAST(period AS INTEGER), '%Y-%m-%d') AS window_start, n, {sql_six("mean")} AS mean,
           {sql_six("std")} AS std, {sql_six("psi")} AS psi,
           CASE WHEN psi < 0.10 THEN 'stable' WHEN psi < 0.25 THEN 'moderate_shift_investigate'
                ELSE 'major_shift_investigate_urgently' END AS flag,
           {_OPEN.format("DATE '2024-01-01' + CAST(period AS INTEGER)")} AS open
    FROM psi JOIN (SELECT day AS period, COUNT(*) AS n, AVG(value) AS mean, stddev_pop(value) AS std FROM days GROUP BY 1) USING (period)""")
register("st2_window_quality", st2_quality, f"""
    WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS window_start, value / (value + 50) AS p,
                      CAST(event_type = 'purchase' AS INTEGER) AS y,
                      {_OPEN.format("date_trunc('day', ts)")} AS open FROM events)
    SELECT window_start, COUNT(*) AS n, {sql_six("AVG(power(p - y, 2))")} AS brier_score,
           COUNT(*) FILTER (WHERE p >= 0.5 AND y = 1) AS tp, COUNT(*) FILTER (WHERE p >= 0.5 AND y = 0) AS fp,
           COUNT(*) FILTER (WHERE p < 0.5 AND y = 1) AS fn, COUNT(*) FILTER (WHERE p < 0.5 AND y = 0) AS tn, MAX(open) AS open
    FROM e GROUP BY window_start""")
_DAILY = MODELS[MODELS.index("two AS ("):].replace(
    MODELS[MODELS.index("two AS ("):MODELS.index("curve AS (")],
    "two AS (SELECT strftime(ts, '%Y-%m-%d') AS model, value / (value + 50) AS p, CAST(event_type = 'purchase' AS INTEGER) AS y FROM events),\n")
_SHOWN = ", ".join(f"{sql_six(c)} AS {c}" for c in ("roc_auc", "pr_auc", "ks", "brier_score", "precision", "recall", "f1"))
register("st2_rank_metrics", st2_ranks, f"""WITH {_DAILY}
    SELECT model AS window_start, {_SHOWN}, tn, fp, fn, tp, {_OPEN.format("CAST(model AS DATE)")} AS open
    FROM classed JOIN ranks USING (model)""")
register("st2_sliding_stability", st2_sliding, """WITH before AS (SELECT value FROM events WHERE ts < TIMESTAMP '2024-01-16'),
    days AS (SELECT value, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) - back AS day FROM events, range(3) AS r(back)), """ + psi(
    "before", "days", ["value"], by="day") + f"""
    SELECT strftime(DATE '2024-01-01' + CAST(period AS INTEGER), '%Y-%m-%d') AS window_start, n, {sql_six("psi")} AS psi,
           CAST(DATE '2024-01-01' + CAST(period AS INTEGER) + INTERVAL 3 DAY > (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR AS INTEGER) AS open
    FROM psi JOIN (SELECT day AS period, COUNT(*) AS n FROM days GROUP BY 1) USING (period)""")
register("d7_triggers_on_stream", d7_stream, ORACLE_D7)
