"""Portfolio reports over the `customers` and `scored_customers` tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.binning import (
    AGE_EDGES, FAIRNESS_AGE_EDGES, UTILIZATION_EDGES, bin_label, bin_number,
    left_closed_age,
)
from riskloom.functions.numbers import half_up
from riskloom.schema import EDUCATION_LABELS, LGD_SCENARIOS, RISK_BANDS, TARGET, TOP_BANDS

MONEY = "decimal(18,2)"


def _rows() -> Column:
    return F.count(F.lit(1)).alias("n_customers")


def _rate_pct(target: str = TARGET) -> Column:
    return half_up(F.avg(target) * 100.0, 2).alias("default_rate_pct")


def _exposure(name: str) -> Column:
    return F.sum(F.col("LIMIT_BAL").cast(MONEY)).cast("double").alias(name)


def _average_limit() -> Column:
    return half_up(F.avg("LIMIT_BAL"), 0).alias("avg_credit_limit")


def portfolio_size(customers: DataFrame) -> DataFrame:
    return customers.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.sum(TARGET).cast("long").alias("total_defaulters"), _rate_pct())


def limit_by_outcome(customers: DataFrame) -> DataFrame:
    return customers.groupBy(TARGET).agg(
        _rows(), _average_limit(), half_up(F.avg("UTIL_AVG"), 3).alias("avg_utilization"))


def risk_by_band(scored: DataFrame) -> DataFrame:
    return scored.groupBy("risk_band").agg(
        _rows(), half_up(F.avg("predicted_pd"), 4).alias("avg_predicted_pd"),
        half_up(F.avg("actual_default") * 100.0, 2).alias("actual_default_rate_pct"),
        _exposure("total_exposure")).orderBy("avg_predicted_pd")


def rate_by_delinquency(customers: DataFrame) -> DataFrame:
    return customers.groupBy("N_MONTHS_DELINQUENT").agg(_rows(), _rate_pct()).orderBy(
        "N_MONTHS_DELINQUENT")


def highest_risk(scored: DataFrame, rows: int = 25) -> DataFrame:
    return scored.filter(F.col("risk_band") == RISK_BANDS[-1]).select(
        "ID", "LIMIT_BAL", "predicted_pd", "risk_band", "N_MONTHS_DELINQUENT", "UTIL_LATEST",
        "actual_default").orderBy(F.desc("predicted_pd"), "ID").limit(rows)


def by_education(customers: DataFrame) -> DataFrame:
    return customers.groupBy("EDUCATION").agg(_rows(), _rate_pct(), _average_limit()).orderBy(
        "EDUCATION")


def by_age_band(customers: DataFrame) -> DataFrame:
    return customers.groupBy(left_closed_age(F.col("AGE")).alias("age_band")).agg(
        _rows(), _rate_pct()).orderBy("age_band")


def by_stress(customers: DataFrame) -> DataFrame:
    return customers.groupBy("UTILIZATION_STRESS_FLAG").agg(_rows(), _rate_pct())


def exposure_concentration(scored: DataFrame) -> DataFrame:
    """The share uses the total of the band rows, so the table is read once."""
    bands = scored.groupBy("risk_band").agg(_exposure("segment_exposure"))
    total = F.sum("segment_exposure").over(Window.partitionBy())
    return bands.withColumn(
        "pct_of_total_exposure", half_up(F.col("segment_exposure") * 100.0 / total, 2)
    ).orderBy(F.desc("segment_exposure"))


def top_band_outcomes(scored: DataFrame) -> DataFrame:
    def outcomes(value: int) -> Column:
        return F.coalesce(F.sum((F.col("actual_default") == value).cast("long")), F.lit(0))

    return scored.filter(F.col("risk_band").isin(TOP_BANDS)).agg(
        F.count(F.lit(1)).alias("n_high_pd_customers"),
        outcomes(0).alias("false_positives_in_band"), outcomes(1).alias("true_positives_in_band"))


def headline_numbers(customers: DataFrame, scored: DataFrame) -> DataFrame:
    """One row of key figures over both tables."""
    book = customers.agg(F.count(F.lit(1)).alias("total_customers"), _exposure("total_exposure"),
                         (F.avg(TARGET) * 100.0).alias("default_rate_pct"),
                         F.lit(1).alias("_one"))
    in_top = F.coalesce(F.col("risk_band").isin(TOP_BANDS), F.lit(False)).cast("int")
    risk = scored.agg((F.avg("predicted_pd") * 100.0).alias("avg_pd_pct"),
                      (F.avg(in_top) * 100.0).alias("high_risk_pct"),
                      F.lit(1).alias("_one"))
    return book.join(risk, "_one").drop("_one")  # one row on each side


def band_dimension(df: DataFrame) -> DataFrame:
    """The four bands in order."""
    rows = F.array(*[F.struct(F.lit(i).alias("band_no"), F.lit(b).alias("risk_band"))
                     for i, b in enumerate(RISK_BANDS, start=1)])
    return df.sparkSession.range(1).select(F.inline(rows))


def in_band_order(summary: DataFrame) -> DataFrame:
    """All four bands in fixed order; a band without rows keeps NULL figures."""
    return band_dimension(summary).join(summary, "risk_band", "left").orderBy("band_no")


def band_counts(scored: DataFrame) -> DataFrame:
    return in_band_order(scored.groupBy("risk_band").agg(F.count(F.lit(1)).alias("customers")))


def segment_summary(scored: DataFrame) -> DataFrame:
    segments = scored.filter(F.col("risk_band").isNotNull()).groupBy("risk_band").agg(
        F.count("ID").alias("customers"), F.avg("predicted_pd").alias("avg_predicted_pd"),
        F.avg("actual_default").alias("actual_default_rate"), _exposure("total_exposure"))
    share = F.col("total_exposure") / F.sum("total_exposure").over(Window.partitionBy())
    return in_band_order(segments.withColumn("exposure_share", share))


def target_distribution(customers: DataFrame) -> DataFrame:
    counts = customers.filter(F.col(TARGET).isNotNull()).groupBy(TARGET).agg(
        F.count(F.lit(1)).alias("n"))
    return counts.withColumn(
        "share_pct", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy())).orderBy(TARGET)


def _rate_by(df: DataFrame, keys: list[Column], order: str) -> DataFrame:
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                    (F.avg(TARGET) * 100.0).alias("default_rate_pct"))
    return grouped.filter(F.col(order).isNotNull()).orderBy(order)


def rate_by_age_band(customers: DataFrame) -> DataFrame:
    age = F.col("AGE")
    return _rate_by(customers, [bin_number(age, AGE_EDGES).alias("band_no"),
                                bin_label(age, AGE_EDGES).alias("age_band")], "band_no")


def rate_by_utilization_band(customers: DataFrame) -> DataFrame:
    level = F.col("UTIL_AVG")
    return _rate_by(customers, [bin_number(level, UTILIZATION_EDGES).alias("band_no"),
                                bin_label(level, UTILIZATION_EDGES).alias("util_band")], "band_no")


def education_label(code: Column) -> Column:
    pairs = [F.lit(v) for item in EDUCATION_LABELS.items() for v in item]
    return F.element_at(F.create_map(*pairs), code)


def rate_by_education_label(customers: DataFrame) -> DataFrame:
    return _rate_by(customers, [education_label(F.col("EDUCATION")).alias("edu_label")], "edu_label")


def rate_by_delinquent_months(customers: DataFrame) -> DataFrame:
    return _rate_by(customers, [F.col("N_MONTHS_DELINQUENT")], "N_MONTHS_DELINQUENT")


def expected_loss(scored: DataFrame, scenarios: list[float] = LGD_SCENARIOS) -> DataFrame:
    """PD x LGD x limit, total and per account, for each loss-given-default level.

    The accounts are summed once; the scenarios multiply the finished sum.
    """
    base = F.col("predicted_pd") * F.col("LIMIT_BAL")
    summed = scored.agg(F.sum(base).alias("_loss"), F.count(base).alias("_n"))
    return summed.select(
        F.explode(F.array(*[F.lit(x) for x in scenarios])).alias("lgd"), "_loss", "_n"
    ).select("lgd", (F.col("_loss") * F.col("lgd")).alias("total_expected_loss"),
             F.try_divide(F.col("_loss") * F.col("lgd"), F.col("_n")).alias("avg_expected_loss"))


def fairness(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Rates per SEX, age band and EDUCATION; a rate without a denominator is NULL.

    One pass: grouping sets make the three groupings from one scan.
    """
    predicted = (F.col("predicted_pd") >= threshold).cast("int")
    y = F.col("actual_default")

    def cell(p: int, a: int) -> Column:
        return F.sum(((predicted == p) & (y == a)).cast("long"))

    wide = scored.select(
        F.col("SEX").cast("string").alias("SEX"),
        bin_label(F.col("AGE"), FAIRNESS_AGE_EDGES).alias("AGE_BAND"),
        F.col("EDUCATION").cast("string").alias("EDUCATION"), "predicted_pd", "actual_default")
    sex, age, education = F.col("SEX"), F.col("AGE_BAND"), F.col("EDUCATION")
    groups = wide.groupingSets([[sex], [age], [education]], sex, age, education).agg(
        F.grouping("SEX").alias("_no_sex"), F.grouping("AGE_BAND").alias("_no_age"),
        F.count(F.lit(1)).alias("n"), F.avg(y).alias("actual_default_rate"),
        F.avg("predicted_pd").alias("avg_predicted_pd"),
        cell(1, 1).alias("tp"), cell(1, 0).alias("fp"),
        cell(0, 1).alias("fn"), cell(0, 0).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    dimension = F.when(F.col("_no_sex") == 0, "SEX").when(
        F.col("_no_age") == 0, "AGE_BAND").otherwise("EDUCATION")
    return groups.select(
        dimension.alias("dimension"), F.coalesce("SEX", "AGE_BAND", "EDUCATION").alias("group"),
        "n", "actual_default_rate", "avg_predicted_pd",
        F.try_divide(tp, tp + fn).alias("tpr_recall"), F.try_divide(fp, fp + tn).alias("fpr"),
        F.try_divide(fn, fn + tp).alias("fnr"),
    ).filter(F.col("group").isNotNull())


def customer_card(scored: DataFrame, ids: DataFrame) -> DataFrame:
    """Lookup card for a list of accounts."""
    return scored.join(ids.select("ID").distinct(), "ID").select(
        "ID", "predicted_pd", "risk_band", "LIMIT_BAL", "UTIL_LATEST", "N_MONTHS_DELINQUENT",
        "MAX_DELINQUENCY",
        F.when(F.col("actual_default") == 1, "Defaulted").otherwise("No Default").alias("outcome"))
