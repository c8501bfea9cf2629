"""Data-quality audit as long tables.

All per-column numbers of a table come from one aggregation over one scan, and
are turned into rows afterwards.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.numbers import metric_rows, to_long
from riskloom.operators.clean import find_target
from riskloom.operators.ranking import exact_quantiles
from riskloom.schema import CATEGORICAL, ID, account_schema

PERCENTILES = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
Metric = tuple[tuple[str, str, str], Column]  # (section, column, metric), aggregate


def _one_scan(df: DataFrame, metrics: list[Metric]) -> DataFrame:
    """(section, column, metric, value) from a single aggregation."""
    named = [(labels, f"m{i}") for i, (labels, _) in enumerate(metrics)]
    wide = df.agg(*[agg.cast("double").alias(f"m{i}") for i, (_, agg) in enumerate(metrics)])
    return metric_rows(wide, named, ["section", "column", "metric"])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _bills(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("BILL_AMT")]


def status_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("PAY_") and not c.startswith("PAY_AMT")]


def _schema_metrics(df: DataFrame) -> list[Metric]:
    return [(("schema", "*", "n_rows"), F.count(F.lit(1))),
            (("schema", "*", "n_cols"), F.max(F.lit(len(df.columns))))]


def _missing_metrics(df: DataFrame) -> list[Metric]:
    metrics = []
    for c in df.columns:
        gone = f"count_if(`{c}` IS NULL)"
        metrics.append((("missing", c, "missing_count"), F.expr(gone)))
        metrics.append((("missing", c, "missing_pct"),
                        F.expr(f"bround(try_divide({gone} * 100D, count(1)), 4)")))
    return metrics


def _numeric_metrics(df: DataFrame) -> list[Metric]:
    makers = {"count": "count", "mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}
    return [(("numeric", c, name), F.expr(f"{maker}(CAST(`{c}` AS DOUBLE))"))
            for c in numeric_columns(df) for name, maker in makers.items()]


def _negative_metrics(df: DataFrame) -> list[Metric]:
    return [(("negative_bills", c, "count"), F.expr(f"count_if(`{c}` < 0)")) for c in _bills(df)]


def audit_schema(df: DataFrame) -> DataFrame:
    """One row per column with its type, and the row count of the table."""
    described = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                 F.lit(f.dataType.simpleString()).alias("dtype"))
        for i, f in enumerate(df.schema.fields, start=1)
    ])
    sized = df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))
    return sized.select("n_rows", "n_cols", F.inline(described))


def audit_missing(df: DataFrame) -> DataFrame:
    long = _one_scan(df, _missing_metrics(df))
    return long.groupBy("column").agg(
        F.max(F.when(F.col("metric") == "missing_count", F.col("value"))).cast("long").alias("missing_count"),
        F.max(F.when(F.col("metric") == "missing_pct", F.col("value"))).alias("missing_pct"))


def _percentile_rows(df: DataFrame) -> DataFrame:
    quantiles = exact_quantiles(df, numeric_columns(df), PERCENTILES)
    return quantiles.select(
        F.lit("numeric").alias("section"), F.col("feature").alias("column"),
        F.concat(F.lit("p"), F.round(F.col("prob") * 100).cast("int")).alias("metric"), "value")


def audit_numeric(df: DataFrame, digits: int | None = None) -> DataFrame:
    """count, mean, std (n-1), min, p1..p99 (exact), max per numeric column."""
    long = _one_scan(df, _numeric_metrics(df)).unionByName(_percentile_rows(df))
    if digits is not None:
        long = long.withColumn("value", F.bround("value", digits))
    return long.select("column", "metric", "value")


def code_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per code, NULL included, for low-cardinality columns."""
    present = [c for c in columns if c in df.columns]
    return to_long(df, present, name="column", value="code", kind="long").groupBy(
        "column", "code").agg(F.count(F.lit(1)).alias("n")).orderBy("column", "code")


def audit_categories(df: DataFrame) -> DataFrame:
    return code_counts(df, CATEGORICAL)


def audit_status(df: DataFrame) -> DataFrame:
    return code_counts(df, status_columns(df))


def audit_target(df: DataFrame) -> DataFrame:
    """Count and share (percent, 3 digits) per outcome value, NULL included."""
    target = F.col(f"`{find_target(df)}`").cast("long")
    counts = df.groupBy(target.alias("code")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # one row per outcome value
    return counts.select("code", "n", F.bround(F.col("n") * 100.0 / total, 3).alias("rate_pct"),
                         total.alias("total"))


def audit_negative_bills(df: DataFrame) -> DataFrame:
    return _one_scan(df, _negative_metrics(df)).select(
        "column", F.col("value").cast("long").alias("negative_count"))


def audit_ids(df: DataFrame) -> DataFrame:
    """Distinct IDs, extremes, and whether the IDs are exactly 1..n; a table without IDs has NULL figures."""
    known = ID in df.columns
    if not known:
        df = df.select(F.lit(None).cast("long").alias(ID))
    stats = df.agg(
        (F.count_distinct(ID) if known else F.max(ID)).alias("n_unique_ids"), F.count(F.lit(1)).alias("n_rows"),
        F.min(ID).cast("long").alias("id_min"), F.max(ID).cast("long").alias("id_max"))
    sequential = ((F.col("n_unique_ids") == F.col("n_rows")) & (F.col("id_min") == 1)
                  & (F.col("id_max") == F.col("n_rows")))
    return stats.withColumn("id_is_sequential", F.coalesce(sequential, F.lit(False)).cast("int"))


def _repeated_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of equal rows.

    A 64-bit row hash is counted first; only rows whose hash repeats are compared
    column by column, so unique rows never travel in full.
    """
    marked = df.withColumn("_hash", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    repeated = marked.groupBy("_hash").count().filter("count > 1").select("_hash")
    return marked.join(repeated, "_hash", "left_semi").groupBy(
        *[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("value"))


def audit_duplicates(df: DataFrame) -> DataFrame:
    """(metric, value): repeated full rows and repeated IDs (a NULL ID counts as a value)."""
    rows = _repeated_rows(df).select(F.lit("duplicate_rows").alias("metric"), "value")
    if ID not in df.columns:
        return rows.unionByName(df.sparkSession.range(1).select(
            F.lit("duplicate_ids").alias("metric"), F.lit(None).cast("long").alias("value")))
    empty = F.sum(F.col(ID).isNull().cast("long"))
    distinct = F.count_distinct(ID) + F.least(F.coalesce(empty, F.lit(0)), F.lit(1))
    ids = df.agg((F.count(F.lit(1)) - distinct).cast("long").alias("value"))
    return rows.unionByName(ids.select(F.lit("duplicate_ids").alias("metric"), "value"))


def full_audit(df: DataFrame) -> DataFrame:
    """Everything above as (section, column, metric, value)."""
    scalar = _one_scan(df, _schema_metrics(df) + _missing_metrics(df) + _numeric_metrics(df)
                       + _negative_metrics(df))

    def rows(table: DataFrame, section: str, column: Column, metric: Column, value: str):
        return table.select(F.lit(section).alias("section"), column.alias("column"),
                            metric.cast("string").alias("metric"),
                            F.col(value).cast("double").alias("value"))

    code = F.coalesce(F.col("code").cast("string"), F.lit("NULL"))
    target = audit_target(df)
    ids = audit_ids(df)
    id_names = ids.columns
    ids = metric_rows(ids, [(("id_uniqueness", ID, n), n) for n in id_names],
                      ["section", "column", "metric"])
    name = F.lit(find_target(df))
    parts = [
        scalar,
        _percentile_rows(df),
        rows(audit_duplicates(df), "duplicates", F.lit("*"), F.col("metric"), "value"),
        rows(audit_categories(df), "categorical", F.col("column"), code, "n"),
        rows(audit_status(df), "status", F.col("column"), code, "n"),
        rows(target, "target", name, F.concat(F.lit("count_"), code), "n"),
        rows(target, "target", name, F.concat(F.lit("rate_pct_"), code), "rate_pct"),
        ids,
    ]
    return reduce(DataFrame.unionByName, parts)


# Allowed ranges of a scoring request.
CODE_RANGES = {"SEX": (1, 2), "EDUCATION": (0, 6), "MARRIAGE": (0, 3), "AGE": (18, 100)}


def record_problems(df: DataFrame) -> DataFrame:
    """Add `problems`: the names of the broken rules of each record, empty if valid."""
    required = account_schema(target=None).fieldNames()
    rules = [F.when(F.col(c).isNull(), F.lit(f"{c} missing")) for c in required]
    money = [f.name for f in account_schema(target=None).fields if f.dataType == T.DoubleType()]
    rules += [F.when(F.isnan(c), F.lit(f"{c} not a number")) for c in money]
    rules.append(F.when(F.col("LIMIT_BAL") <= 0, F.lit("LIMIT_BAL not positive")))
    rules += [F.when(~F.col(c).between(low, high), F.lit(f"{c} out of range"))
              for c, (low, high) in CODE_RANGES.items()]
    rules += [F.when(F.col(c) < 0, F.lit(f"{c} negative"))
              for c in df.columns if c.startswith("PAY_AMT")]
    return df.withColumn("problems", F.array_compact(F.array(*rules)))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records fit for scoring, quarantined records with their problems)."""
    checked = record_problems(df)
    valid = checked.filter(F.size("problems") == 0).drop("problems")
    return valid, checked.filter(F.size("problems") > 0)
