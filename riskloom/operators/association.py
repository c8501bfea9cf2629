"""Association of columns with the outcome: chi-square, Welch t, correlation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.numbers import metric_rows, to_long
from riskloom.functions.tails import chi_square_tail, student_two_sided
from riskloom.schema import CATEGORICAL, TARGET

# The numeric columns of the standard suite.
SUITE_NUMERIC = [
    "LIMIT_BAL", "AGE", "UTIL_AVG", "UTIL_LATEST", "N_MONTHS_DELINQUENT",
    "MAX_DELINQUENCY", "PAYCOV_AVG", "BILL_AVG", "PAYAMT_AVG",
]


def crosstab(df: DataFrame, variables: list[str], target: str = TARGET) -> DataFrame:
    """Counts of both outcome classes per (variable, code); NULLs are left out."""
    present = [c for c in variables if c in df.columns]
    long = to_long(df, present, keep=[target], name="variable", value="code", kind="long")
    return long.filter(F.col("code").isNotNull() & F.col(target).isNotNull()).groupBy(
        "variable", "code"
    ).agg(F.sum((F.col(target) == 0).cast("long")).alias("n0"),
          F.sum((F.col(target) == 1).cast("long")).alias("n1"))


def _cell(observed: Column, expected: Column, correct: Column) -> Column:
    gap = F.abs(observed - expected)
    moved = F.when(correct, gap - F.least(gap, F.lit(0.5))).otherwise(gap)
    return F.try_divide(moved * moved, expected)


def chi_square(df: DataFrame, variables: list[str] = CATEGORICAL,
               target: str = TARGET) -> DataFrame:
    """Chi-square per variable, continuity-corrected for a 2x2 table, with Cramer's V.

    Windows and sums run over the contingency table, never over the data.
    """
    table = crosstab(df, variables, target)
    per = Window.partitionBy("variable")
    row, all0, all1 = F.col("n0") + F.col("n1"), F.sum("n0").over(per), F.sum("n1").over(per)
    n = (all0 + all1).cast("double")
    sized = table.select(
        "variable", "n0", "n1", n.alias("n"),
        (row * all0 / n).alias("e0"), (row * all1 / n).alias("e1"),
        F.count(F.lit(1)).over(per).alias("levels"),
        ((all0 > 0).cast("int") + (all1 > 0).cast("int")).alias("classes"))
    dof = (F.col("levels") - 1) * (F.col("classes") - 1)
    cells = _cell(F.col("n0"), F.col("e0"), dof == 1) + _cell(F.col("n1"), F.col("e1"), dof == 1)
    result = sized.withColumn("dof", dof).withColumn("cells", cells).groupBy(
        "variable", "dof", "n", "levels", "classes").agg(F.sum("cells").alias("chi2"))
    smaller = F.least(F.col("levels") - 1, F.col("classes") - 1)
    return result.select(
        "variable", "chi2", F.col("dof").cast("long").alias("dof"),
        F.sqrt(F.try_divide(F.col("chi2") / F.col("n"), smaller)).alias("cramers_v"))


def group_means(df: DataFrame, variables: list[str] = SUITE_NUMERIC,
                target: str = TARGET) -> DataFrame:
    """Welch t (class 0 minus class 1), its degrees of freedom, and Cohen's d
    (class 1 minus class 0) per variable, from one aggregation by class."""
    present = [c for c in variables if c in df.columns]
    made = {"n": F.count, "mean": F.avg, "var": F.var_samp}
    wide = df.filter(F.col(target).isin(0, 1)).groupBy().pivot(target, [0, 1]).agg(*[
        make(F.col(c).cast("double")).cast("double").alias(f"{c}__{stat}")
        for c in present for stat, make in made.items()
    ])
    long = wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("variable"), *[
            F.col(f"`{k}_{c}__{stat}`").alias(f"{stat}{k}") for k in (0, 1) for stat in made
        ]) for c in present
    ])))
    se0, se1 = F.col("var0") / F.col("n0"), F.col("var1") / F.col("n1")
    pooled = F.sqrt((F.col("var0") + F.col("var1")) / 2.0)
    freedom = F.try_divide(
        F.pow(se0 + se1, F.lit(2.0)),
        se0 * se0 / (F.col("n0") - 1.0) + se1 * se1 / (F.col("n1") - 1.0))
    effect = F.when(pooled > 0, (F.col("mean1") - F.col("mean0")) / pooled).otherwise(F.lit(0.0))
    return long.select(
        "variable", F.col("mean0").alias("mean_no_default"), F.col("mean1").alias("mean_default"),
        F.try_divide(F.col("mean0") - F.col("mean1"), F.sqrt(se0 + se1)).alias("t_stat"),
        freedom.alias("dof"), effect.alias("cohens_d"))


def correlation(df: DataFrame, variables: list[str] = SUITE_NUMERIC,
                target: str = TARGET) -> DataFrame:
    """Pearson correlation with the outcome over complete pairs, strongest first."""
    wide = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c)
                    for c in variables])
    long = metric_rows(wide, [((c,), c) for c in variables], ["variable"], "r")
    return long.orderBy(F.abs("r").desc_nulls_last(), "variable")


def with_chi_square_p(results: DataFrame) -> DataFrame:
    return results.withColumn("p_value", chi_square_tail(F.col("chi2"), F.col("dof")))


def with_student_p(results: DataFrame) -> DataFrame:
    return results.withColumn("p_value", student_two_sided(F.col("t_stat"), F.col("dof")))


def association_suite(df: DataFrame, target: str = TARGET) -> DataFrame:
    """All tests as (test, variable, metric, value)."""
    return stacked_tests(with_chi_square_p(chi_square(df, target=target)),
                         with_student_p(group_means(df, target=target)), correlation(df, target=target))


def stacked_tests(chi: DataFrame, groups: DataFrame, correlations: DataFrame) -> DataFrame:
    def long(results: DataFrame, test: str, metrics: list[str]) -> DataFrame:
        numbers = results.select("variable", *[F.col(m).cast("double") for m in metrics])
        return numbers.unpivot(["variable"], metrics, "metric", "value").select(
            F.lit(test).alias("test"), "variable", "metric", "value")

    return long(chi, "chi_square", ["chi2", "p_value", "dof", "cramers_v"]).unionByName(
        long(groups, "group_test", ["mean_no_default", "mean_default", "t_stat", "p_value", "cohens_d"])).unionByName(
        long(correlations, "correlation", ["r"]))
