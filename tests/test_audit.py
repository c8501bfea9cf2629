"""Audits and record constraints on small dirty tables."""

from pyspark.sql import functions as F

from riskloom.operators import audit
from riskloom.operators.clean import clean_accounts
from riskloom.schema import TARGET
from tests.test_features import accounts


def values(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_duplicates_count_rows_beyond_the_first(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, "a"), (2, "b"), (None, "x"), (None, "x"), (None, "y")],
                               "ID long, v string")
    found = values(audit.audit_duplicates(df), "metric")
    assert found[("duplicate_rows",)]["value"] == 3  # two (1, a), one (NULL, x)
    assert found[("duplicate_ids",)]["value"] == 5  # two 1, one 2, two NULL


def test_duplicates_without_ids(spark):
    found = values(audit.audit_duplicates(spark.createDataFrame([("a",), ("a",)], "v string")), "metric")
    assert found[("duplicate_rows",)]["value"] == 1 and found[("duplicate_ids",)]["value"] is None


def test_ids_must_be_one_to_n(spark):
    def sequential(ids):
        return audit.audit_ids(spark.createDataFrame([(i,) for i in ids], "ID long")).first()["id_is_sequential"]

    assert sequential([3, 1, 2]) == 1
    assert sequential([1, 2, 4]) == 0
    assert sequential([1, 2, 2]) == 0
    assert sequential([0, 1, 2]) == 0
    assert sequential([1, 2, None]) == 0


def test_missing_counts_every_column(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 4.0)], "ID long, v double")
    found = values(audit.audit_missing(df), "column")
    assert found[("ID",)]["missing_count"] == 0
    assert (found[("v",)]["missing_count"], found[("v",)]["missing_pct"]) == (2, 66.6667)


def test_code_counts_include_null(spark):
    df = accounts(spark, dict(EDUCATION=None), dict(EDUCATION=0), dict(EDUCATION=0))
    found = values(audit.audit_categories(df), "column", "code")
    assert found[("EDUCATION", None)]["n"] == 1 and found[("EDUCATION", 0)]["n"] == 2


def test_status_columns_leave_out_payments(spark):
    df = accounts(spark)
    assert audit.status_columns(df) == ["PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6"]


def test_numeric_summary_uses_sample_deviation(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 10]], "v double")
    found = values(audit.audit_numeric(df, digits=2), "column", "metric")
    assert found[("v", "std")]["value"] == 4.08
    assert (found[("v", "p50")]["value"], found[("v", "p25")]["value"]) == (2.5, 1.75)


def test_full_audit_has_every_section(spark):
    df = accounts(spark, dict(ID=1), dict(ID=2), target=TARGET)
    sections = {r["section"] for r in audit.full_audit(df).select("section").distinct().collect()}
    assert sections == {"schema", "missing", "numeric", "negative_bills", "duplicates", "categorical",
                        "status", "target", "id_uniqueness"}


def test_quarantine_names_the_broken_rules(spark):
    df = accounts(spark, dict(ID=1), dict(ID=2, SEX=3, LIMIT_BAL=0.0), dict(ID=3, PAY_AMT1=-1.0, AGE=17),
                  dict(ID=4, MARRIAGE=None), dict(ID=5, EDUCATION=7))
    valid, quarantined = audit.split_valid(df)
    assert [r["ID"] for r in valid.collect()] == [1]
    problems = {r["ID"]: sorted(r["problems"]) for r in quarantined.collect()}
    assert problems == {2: ["LIMIT_BAL not positive", "SEX out of range"], 3: ["AGE out of range", "PAY_AMT1 negative"],
                        4: ["MARRIAGE missing"], 5: ["EDUCATION out of range"]}


def test_cleaning_keeps_the_row_count(spark):
    df = accounts(spark, *[dict(ID=i, EDUCATION=i % 7, MARRIAGE=i % 4) for i in range(20)])
    assert clean_accounts(df).count() == df.count() == 20
    assert clean_accounts(df).filter(F.col("EDUCATION").isin(0, 5, 6)).count() == 0


def test_nan_money_is_quarantined(spark):
    rows = accounts(spark, {}, {"ID": 2}).withColumn("LIMIT_BAL", F.when(F.col("ID") == 1, float("nan")).otherwise(F.col("LIMIT_BAL")))
    found = [r["problems"] for r in audit.record_problems(rows).collect()]
    assert ["LIMIT_BAL not a number" in p for p in found].count(True) == rows.filter("ID = 1").count() > 0


def test_ids_of_a_table_without_them(spark):
    row = audit.audit_ids(spark.createDataFrame([("a",), ("b",)], "v string")).first()
    assert (row["n_unique_ids"], row["n_rows"], row["id_min"], row["id_is_sequential"]) == (None, 2, None, 0)


def test_json_lines_keep_the_outcome(spark, tmp_path):
    from riskloom.sources.accounts import read_accounts

    raw = accounts(spark, {}, {"ID": 2}).withColumn(TARGET, F.lit(1))
    raw.write.json(f"{tmp_path}/accounts.json")
    assert [r[TARGET] for r in read_accounts(spark, f"{tmp_path}/accounts.json").collect()] == [1, 1]
