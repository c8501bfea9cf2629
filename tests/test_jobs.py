"""Sources, stored tables, streams, the registry and the plans."""

import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from riskloom.operators import metrics, portfolio, scoring
from riskloom.operators.features import engineer_features
from riskloom.plans import training, warehouse
from riskloom.schema import ID, RISK_BANDS, TARGET
from riskloom.session import cut_lineage, scratch_path, shared_folder
from riskloom.sources import accounts
from riskloom.streaming import monitoring, scoring as arriving
from verification import models
from verification.check import compare
from verification.common import two_models


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, folder, connection, name):
    assert compare(entry.queries()[name](spark, folder), connection, entry.oracle_sql()[name]) == ""


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["N_MONTHS_DELINQUENT", "n_customers", "default_rate_pct"]


@pytest.mark.parametrize("name", ["l6_logistic_regression", "l4_one_hot", "x1_odds_ratios", "io7_saved_model"])
def test_model_queries_give_rows(spark, folder, name):
    assert models.QUERIES[name](spark, folder).count() > 0


def test_csv_reads_columns_by_header(spark, tmp_path):
    path = str(tmp_path / "small.csv")
    with open(path, "w") as out:
        out.write("AGE,ID,default.payment.next.month,LIMIT_BAL\n24,1,1,20000\n30,2,0,50000\n")
    df = accounts.read_accounts(spark, path)
    assert dict(df.dtypes) == {"AGE": "int", "ID": "bigint", "default.payment.next.month": "int", "LIMIT_BAL": "double"}
    assert [r["ID"] for r in df.collect()] == [1, 2]
    assert TARGET in accounts.with_target_name(df).columns


def test_missing_file_is_an_error_with_guidance(spark, tmp_path, monkeypatch):
    with pytest.raises(FileNotFoundError, match="no account table"):
        accounts.read_accounts(spark, str(tmp_path / "none.csv"))
    monkeypatch.setenv(accounts.PATH_VARIABLE, "from_environment")
    assert accounts.resolve_path(spark) == "from_environment"
    assert accounts.resolve_path(spark, "given") == "given"
    monkeypatch.delenv(accounts.PATH_VARIABLE)
    assert accounts.resolve_path(spark, default="fallback") == "fallback"
    with pytest.raises(ValueError):
        accounts.resolve_path(spark)


def test_sql_tables_are_replaced(spark, folder):
    accounts.publish(spark.range(3).toDF("x"), "replaced")
    accounts.publish(spark.range(5).toDF("x"), "replaced")
    assert spark.table("replaced").count() == 5


def test_empty_batch_is_an_error(spark, folder):
    empty = warehouse.raw_accounts(spark, folder).limit(0)
    with pytest.raises(ValueError, match="no customers"):
        scoring.score_batch(empty, scoring.scorecard_predictor(), warehouse.thresholds(spark, folder))


def test_stream_equals_batch(spark, folder):
    raw = warehouse.raw_accounts(spark, folder).drop(TARGET)
    landing, sink = scratch_path(spark, "landing"), scratch_path(spark, "sink")
    raw.repartition(3).write.json(landing)
    cuts = warehouse.thresholds(spark, folder)
    stream = arriving.scored_stream(arriving.record_stream(spark, landing, 1), scoring.scorecard_predictor(), cuts)
    arriving.run_once(stream, sink, scratch_path(spark, "progress")).awaitTermination()
    batch = scoring.score_response(scoring.score_accounts(raw, scoring.scorecard_predictor(), cuts))
    replayed = spark.read.parquet(sink)
    assert replayed.exceptAll(batch).count() == 0 and batch.exceptAll(replayed).count() == 0


def test_stream_restart_scores_only_new_files(spark, folder):
    raw = warehouse.raw_accounts(spark, folder).drop(TARGET)
    landing, sink, progress = (scratch_path(spark, n) for n in ("landing", "sink", "progress"))
    cuts = warehouse.thresholds(spark, folder)
    for half in (0, 1):
        raw.filter(F.col(ID) % 2 == half).coalesce(1).write.mode("append").json(landing)
        stream = arriving.scored_stream(arriving.record_stream(spark, landing), scoring.scorecard_predictor(), cuts)
        arriving.run_once(stream, sink, progress).awaitTermination()
    assert spark.read.parquet(sink).count() == raw.count()


def test_late_rows_are_dropped_after_the_watermark(spark):
    source, sink, progress = (scratch_path(spark, n) for n in ("late", "sink", "progress"))
    schema = "ts timestamp, value double"

    def land(*times):
        rows = spark.createDataFrame([(t, 1.0) for t in times], "t string, value double")
        rows.select(F.to_timestamp("t").alias("ts"), "value").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        monitoring.run_to_table(monitoring.window_counts(stream, "ts", "value", [0.5]), sink, progress)

    land("2024-01-01 10:00:00", "2024-01-01 11:00:00", "2024-01-03 00:00:00")
    land("2024-01-01 12:00:00", "2024-01-05 00:00:00")  # the first row is late, its day is closed
    rows = {str(r["window_start"])[:10]: r["n"] for r in spark.read.parquet(sink).collect()}
    assert rows == {"2024-01-01": 2, "2024-01-03": 1}


def test_all_bands_are_listed_even_when_empty(spark, folder):
    only_low = warehouse.scored_customers(spark, folder).filter(F.col("risk_band") == RISK_BANDS[0])
    rows = portfolio.band_counts(only_low).collect()
    assert [r["risk_band"] for r in rows] == RISK_BANDS
    assert rows[0]["customers"] > 0 and [r["customers"] for r in rows[1:]] == [None, None, None]


def test_band_counts_add_up(spark, folder):
    scored = warehouse.scored_customers(spark, folder)
    assert sum(r["customers"] or 0 for r in portfolio.band_counts(scored).collect()) == scored.count()


def test_expected_loss_scales_with_the_scenario(spark, folder):
    rows = {r["lgd"]: r["total_expected_loss"] for r in
            portfolio.expected_loss(warehouse.scored_customers(spark, folder)).collect()}
    assert rows[0.6] / rows[0.45] == pytest.approx(0.6 / 0.45) and rows[0.75] > rows[0.6]


def test_prompt_keeps_the_last_ten_turns(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", f"t{t}") for t in range(14)] + [(2, 0, "user", "hello")]
    talk = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    context = spark.createDataFrame([('{"a":1}',)], "context string")
    found = {r["conv_id"]: r for r in scoring.prompt_rows(talk, context).collect()}
    assert found[1]["n_turns"] == 10 and found[1]["history"].startswith("assistant: t4\nuser: t5")
    assert found[2]["history"] == "user: hello" and found[2]["context"] == '{"a":1}'


def test_context_is_one_document(spark, folder):
    body = json.loads(entry.queries()["g10_portfolio_context"](spark, folder).first()["context"])
    assert set(body) == {"portfolio", "model_performance", "risk_segments", "monitoring", "fairness"}
    assert len(body["risk_segments"]) == 4


def test_training_run_with_one_candidate(spark, folder):
    out = scratch_path(spark, "run")
    raw = warehouse.raw_accounts(spark, "/root/testdata/sf0.01")
    bundle = training.run_training(raw, out, ["logistic_regression"])
    sections = {r["section"] for r in bundle.select("section").distinct().collect()}
    assert {"split", "imbalance_comparison", "generator_experiment", "model_metrics", "calibration",
            "calibration_table", "psi_train_vs_test_pd", "fairness", "segmentation_thresholds",
            "expected_loss", "model_card", "logistic_regression_top_features"} <= sections
    assert spark.read.parquet(f"{out}/scored_customers").count() == 374


def test_checkpoints_go_to_the_shared_folder(spark):
    assert cut_lineage(spark.range(3)).count() == 3
    assert spark.sparkContext._jsc.sc().getCheckpointDir().get() == shared_folder(spark)


# ---- plans ----

def test_features_compile_without_python(spark, folder):
    text = plan(engineer_features(warehouse.raw_accounts(spark, folder)))
    assert "Python" not in text and "Exchange" not in text


def test_reports_read_only_their_columns(spark, folder):
    text = plan(portfolio.rate_by_delinquency(warehouse.customers(spark, folder)))
    schema = text[text.index("ReadSchema"):]
    assert "default_next_month" in schema and "N_MONTHS_DELINQUENT" in schema and "BILL_AMT1" not in schema


def test_top_k_and_band_pruning(spark, folder):
    text = plan(portfolio.highest_risk(warehouse.scored_customers(spark, folder)))
    assert "TakeOrderedAndProject" in text and "PartitionFilters: [isnotnull(risk_band" in text


def test_rank_metrics_have_no_window_over_the_whole_table(spark, folder):
    text = plan(metrics.full_metrics(two_models(spark, folder), "p", "y", ["model"]))
    assert "SinglePartition" not in text and "_range" in text


def test_turns_are_limited_before_the_shuffle(spark, folder):
    talk = spark.read.parquet(f"{folder}/conversations.parquet")
    text = plan(scoring.prompt_rows(talk, spark.createDataFrame([("{}",)], "context string")))
    assert "WindowGroupLimit" in text
