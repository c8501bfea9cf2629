"""Features, cleaning and bins on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from riskloom.functions import binning as B
from riskloom.operators.clean import clean_accounts, find_target
from riskloom.operators.features import engineer_features
from riskloom.schema import ALL_FEATURES, BILLS, PAYMENTS, STATUS, TARGET, account_schema

EXAMPLE = dict(
    ID=1, LIMIT_BAL=20000.0, SEX=2, EDUCATION=2, MARRIAGE=1, AGE=24,
    **dict(zip(STATUS, [2, 2, -1, -1, -2, -2])),
    **dict(zip(BILLS, [3913.0, 3102.0, 689.0, 0.0, 0.0, 0.0])),
    **dict(zip(PAYMENTS, [0.0, 689.0, 0.0, 0.0, 0.0, 0.0])),
)


def accounts(spark, *changes, target=None):
    schema = account_schema(target)
    rows = [{**EXAMPLE, TARGET: 0, **c} for c in changes or [{}]]
    return spark.createDataFrame([tuple(r[n] for n in schema.fieldNames()) for r in rows], schema)


def features(spark, **changes):
    return engineer_features(clean_accounts(accounts(spark, changes))).first()


def test_example_record(spark):
    row = features(spark)
    assert [round(row[f"UTIL_{i}"], 5) for i in range(1, 7)] == [0.19565, 0.1551, 0.03445, 0.0, 0.0, 0.0]
    assert round(row["UTIL_AVG"], 4) == 0.0642
    assert (row["PAYCOV_1"], row["PAYCOV_2"], row["PAYCOV_3"]) == (0.0, 1.0, None)
    assert (row["PAYCOV_AVG"], row["PAYCOV_TREND"]) == (0.5, -1.0)
    assert (row["N_MONTHS_DELINQUENT"], row["MAX_DELINQUENCY"], row["RECENT_DELINQUENCY"]) == (2, 2, 1)
    assert row["AVG_DELINQUENCY_SEVERITY"] == pytest.approx(4 / 6)
    assert (row["SEVERE_DELINQUENCY_FLAG"], row["PERSISTENT_DELINQUENCY_FLAG"]) == (0, 0)
    assert row["UTILIZATION_STRESS_FLAG"] == 0


def test_there_are_39_features(spark):
    df = engineer_features(clean_accounts(accounts(spark, target=TARGET)))
    assert len(ALL_FEATURES) == 39 and len(df.columns) == 64
    assert set(ALL_FEATURES) <= set(df.columns)


def test_undefined_coverage_is_null_not_zero(spark):
    none = features(spark, **{b: 0.0 for b in BILLS})
    assert none["PAYCOV_AVG"] is None and none["PAYCOV_TREND"] is None and none["PAYCOV_LATEST"] is None
    one = features(spark, **dict(zip(BILLS, [0.0, 100.0, 0.0, 0.0, 0.0, 0.0])), PAY_AMT1=50.0)
    assert one["PAYCOV_AVG"] == 0.5 and one["PAYCOV_TREND"] is None


def test_coverage_slope_uses_compacted_positions(spark):
    row = features(spark, **dict(zip(BILLS, [0.0, 100.0, 0.0, 100.0, 0.0, 100.0])),
                   PAY_AMT1=300.0, PAY_AMT3=200.0, PAY_AMT5=100.0)
    assert (row["PAYCOV_1"], row["PAYCOV_3"], row["PAYCOV_5"]) == (3.0, 2.0, 1.0)
    assert row["PAYCOV_TREND"] == pytest.approx(1.0)


def test_constant_series_has_zero_trend_and_spread(spark):
    row = features(spark, **{b: 123.45 for b in BILLS})
    assert (row["BILL_TREND"], row["BILL_VOLATILITY"], row["UTIL_TREND"]) == (0.0, 0.0, 0.0)


def test_clips(spark):
    high = features(spark, LIMIT_BAL=100.0, **{b: 1e6 for b in BILLS}, **{p: 1e7 for p in PAYMENTS})
    assert (high["UTIL_AVG"], high["PAYCOV_1"], high["PAYMENT_CAPACITY"]) == (3.0, 5.0, 2.0)
    low = features(spark, LIMIT_BAL=100.0, **{b: -1e6 for b in BILLS})
    assert (low["UTIL_MIN"], low["BALANCE_TO_LIMIT_LATEST"]) == (-2.0, -2.0)


def test_slope_flips_when_the_series_is_reversed(spark):
    bills = [5.0, 9.0, 1.0, 7.0, 2.0, 30.0]
    there = features(spark, **dict(zip(BILLS, bills)))
    back = features(spark, **dict(zip(BILLS, bills[::-1])))
    assert there["BILL_TREND"] == pytest.approx(-back["BILL_TREND"])
    assert there["BILL_VOLATILITY"] == pytest.approx(back["BILL_VOLATILITY"])


def test_cleaning_folds_codes_and_keeps_rows(spark):
    changes = [dict(EDUCATION=e, MARRIAGE=m) for e, m in
               [(0, 0), (1, 1), (5, 2), (6, 3), (4, None), (7, 0), (None, 1)]]
    rows = clean_accounts(accounts(spark, *changes)).select("EDUCATION", "MARRIAGE").collect()
    assert [tuple(r) for r in rows] == [(4, 3), (1, 1), (4, 2), (4, 3), (4, None), (7, 3), (None, 1)]


@pytest.mark.parametrize("spelling", ["default payment next month", "default.payment.next.month", "default"])
def test_every_target_spelling_is_renamed(spark, spelling):
    df = accounts(spark, target=TARGET).withColumnRenamed(TARGET, spelling)
    assert find_target(df) == spelling
    assert clean_accounts(df).columns[-1] == TARGET


def test_missing_target_is_an_error(spark):
    with pytest.raises(KeyError):
        find_target(accounts(spark))


def test_right_closed_bins(spark):
    values = [(v,) for v in [0.0, 0.05, 0.0500001, 0.5, 1.0, -0.1, 1.1]]
    df = spark.createDataFrame(values, "p double")
    label = B.bin_label(F.col("p"), B.CALIBRATION_EDGES, include_lowest=True)
    assert [r[0] for r in df.select(label).collect()] == [
        "(-0.001, 0.05]", "(-0.001, 0.05]", "(0.05, 0.1]", "(0.4, 1.0]", "(0.4, 1.0]", None, None]
    ages = spark.createDataFrame([(a,) for a in [20, 30, 31, 80, 81]], "a int")
    assert [r[0] for r in ages.select(B.bin_label(F.col("a"), B.FAIRNESS_AGE_EDGES)).collect()] == [
        None, "(20, 30]", "(30, 40]", "(60, 80]", None]


def test_risk_band_closes_on_its_threshold(spark):
    cuts = {"low_max": 0.1, "moderate_max": 0.3, "high_max": 0.6}
    df = spark.createDataFrame([(v,) for v in [0.0, 0.1, 0.3, 0.30001, 0.6, 1.0]], "p double")
    assert [r[0] for r in df.select(B.risk_band(F.col("p"), cuts)).collect()] == [
        "Low Risk", "Low Risk", "Moderate Risk", "High Risk", "High Risk", "Very High Risk"]


def test_whole_cents_equal_round(spark):
    """Halves away from zero on both sides, at the last bit beside a half, and NULL."""
    from riskloom.sources.panel import whole

    values = [0.0, 0.5, -0.5, 1.5, 2.5, -2.5, 0.49999999999999994, -0.49999999999999994, 1234.4999999999998, 105000.00000000001,
              -99.49999999999999, 4503599627370495.5, 9007199254740993.0, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select(whole(F.col("x")).alias("a"), F.round("x").cast("long").alias("b")).collect()
    assert [r["a"] for r in rows] == [r["b"] for r in rows]


def test_wide_loops_are_split(spark):
    """A stored table of 65 columns is read without one generated loop over all of them."""
    from riskloom.session import prepare

    assert int(prepare(spark).conf.get("spark.sql.codegen.hugeMethodLimit")) <= 4000
