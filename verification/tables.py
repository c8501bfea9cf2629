"""Queries over accounts: input and output, audits, cleaning, bins, features, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import binning as B
from riskloom.operators import audit, clean, explain, portfolio, scoring
from riskloom.plans import warehouse as W
from riskloom.schema import (
    ALL_FEATURES, BALANCE_FEATURES, COVERAGE_FEATURES, DELINQUENCY_FEATURES, EXPOSURE_FEATURES, ID,
    RISK_BANDS, STATUS, TARGET, UTILIZATION_FEATURES,
)
from riskloom.session import scratch_path
from riskloom.sources import accounts
from riskloom.sources.panel import account_panel, read_table
from verification.common import six
from verification.oracle import CLEAN, FEATURES, PANEL, SCORED, digits
from verification.oracle import six as sql_six

RAW_COLUMNS = (["ID", "LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE"] + STATUS
               + [f"BILL_AMT{i}" for i in range(1, 7)] + [f"PAY_AMT{i}" for i in range(1, 7)] + [TARGET])
QUERIES, ORACLE = {}, {}


def register(name, query, sql=None):
    QUERIES[name] = query
    if sql is not None:
        ORACLE[name] = sql


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


# ---- sources and sinks ----

def io1_csv(spark, d):
    path = scratch_path(spark, "accounts") + ".csv"
    W.raw_accounts(spark, d).write.option("header", True).csv(path)
    return accounts.read_accounts(spark, path)


def io3_cleaned(spark, d):
    path = accounts.write_table(clean.clean_accounts(W.raw_accounts(spark, d)), scratch_path(spark, "cleaned"))
    return spark.read.parquet(path)


def io4_featured(spark, d):
    return six(W.customers(spark, d).select(*RAW_COLUMNS, *ALL_FEATURES))


def io5_scored(spark, d):
    return W.scored_customers(spark, d).select(ID, "actual_default", "predicted_pd", "risk_band")


def io6_tables(spark, d):
    accounts.publish(W.customers(spark, d), "customers")
    accounts.publish(W.scored_customers(spark, d), "scored_customers")
    return spark.sql("""
        SELECT s.risk_band, CAST(COUNT(*) AS BIGINT) AS n, CAST(SUM(c.default_next_month) AS BIGINT) AS defaults
        FROM scored_customers s JOIN customers c ON c.ID = s.ID GROUP BY s.risk_band""")


def io9_attributions(spark, d):
    rows = explain.contribution_rows(W.scored_customers(spark, d), scoring.scorecard_terms())
    path = accounts.write_table(rows, scratch_path(spark, "attributions"))
    return six(spark.read.parquet(path))


def io10_records(spark, d):
    path = scratch_path(spark, "records")
    W.raw_accounts(spark, d).drop(TARGET).write.json(path)
    records = accounts.read_records(spark, path)
    return scoring.score_batch(records, scoring.scorecard_predictor(), W.thresholds(spark, d))


def wide_attributions(spark, d):
    rows = explain.contribution_rows(W.scored_customers(spark, d), scoring.scorecard_terms())
    names = list(scoring.scorecard_terms())
    wide = rows.groupBy(ID).pivot("feature", names).agg(F.first("contribution"))
    return six(wide.select(ID, *[F.col(n).alias(f"shap_{n}") for n in names]))


RAW_SELECT = ", ".join(RAW_COLUMNS)
register("panel_accounts", lambda s, d: account_panel(s, d), _with(PANEL, f"SELECT {RAW_SELECT} FROM panel"))
register("io1_read_csv", io1_csv, _with(PANEL, f"SELECT {RAW_SELECT} FROM panel"))
register("io3_write_cleaned", io3_cleaned, _with(CLEAN, f"SELECT {RAW_SELECT} FROM clean"))
_INTEGER_FEATURES = set(DELINQUENCY_FEATURES + ["UTILIZATION_STRESS_FLAG"]) - {"AVG_DELINQUENCY_SEVERITY"}
_MONEY = ["LIMIT_BAL"] + [f"{kind}{i}" for kind in ("BILL_AMT", "PAY_AMT") for i in range(1, 7)]
_ALL_COLUMNS = ", ".join(
    f"{sql_six(c)} AS {c}" if c in _MONEY or c in set(ALL_FEATURES) - _INTEGER_FEATURES else c for c in RAW_COLUMNS + ALL_FEATURES)
register("io4_featured_table", io4_featured, _with(FEATURES, f"SELECT {_ALL_COLUMNS} FROM feat"))
register("io5_scored_table", io5_scored,
         _with(SCORED, "SELECT ID, actual_default, predicted_pd, risk_band FROM scored"))
register("io6_sql_tables", io6_tables, _with(SCORED, """
    SELECT risk_band, COUNT(*) AS n, CAST(SUM(actual_default) AS BIGINT) AS defaults FROM scored GROUP BY risk_band"""))
_TERMS = """(SELECT ID, unnest(['N_MONTHS_DELINQUENT', 'PAY_0_LATE', 'UTIL_AVG']) AS feature,
    unnest([CAST(N_MONTHS_DELINQUENT AS DOUBLE), CAST(greatest(PAY_0, 0) AS DOUBLE), UTIL_AVG]) AS contribution FROM scored)"""
register("io9_attribution_table", io9_attributions,
         _with(SCORED, f"SELECT ID, feature, {sql_six('contribution')} AS contribution FROM {_TERMS}"))
register("io9_attribution_wide", wide_attributions, _with(SCORED, f"""
    SELECT ID, {sql_six("N_MONTHS_DELINQUENT")} AS shap_N_MONTHS_DELINQUENT,
           {sql_six("greatest(PAY_0, 0)")} AS shap_PAY_0_LATE, {sql_six("UTIL_AVG")} AS shap_UTIL_AVG FROM scored"""))
register("io10_score_records", io10_records, _with(SCORED, """
    SELECT ID, predicted_pd, risk_band, CAST(predicted_pd >= 0.5 AS INTEGER) AS predicted_class FROM banded"""))


# ---- audit ----

def _codes(columns: list[str], table: str = "panel") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS BIGINT) AS code, COUNT(*) AS n FROM {table} GROUP BY {c}"
        for c in columns)


def _stat(c: str) -> str:
    parts = {"count": f"COUNT({c})", "mean": f"AVG({c})", "std": f"stddev_samp({c})", "min": f"MIN({c})",
             "max": f"MAX({c})"}
    parts |= {f"p{round(p * 100)}": f"quantile_cont({c}, {p})" for p in audit.PERCENTILES}
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{m}' AS metric, CAST({e} AS DOUBLE) AS value FROM panel"
        for m, e in parts.items())


_NUMERIC_SQL = " UNION ALL ".join(_stat(c) for c in RAW_COLUMNS)
_TYPES = {"ID": "bigint", "LIMIT_BAL": "double"} | {c: "int" for c in RAW_COLUMNS[2:12] + [TARGET]}
_SCHEMA_ROWS = ", ".join(f"({i}, '{c}', '{_TYPES.get(c, 'double')}')" for i, c in enumerate(RAW_COLUMNS, start=1))
register("a2_schema", lambda s, d: audit.audit_schema(W.raw_accounts(s, d)), _with(PANEL, f"""
    SELECT (SELECT COUNT(*) FROM panel) AS n_rows, 25 AS n_cols, "position", "column", dtype
    FROM (VALUES {_SCHEMA_ROWS}) t("position", "column", dtype)"""))
_DISTINCT = f"(SELECT COUNT(*) FROM (SELECT DISTINCT {RAW_SELECT} FROM panel))"
register("a3_duplicates", lambda s, d: audit.audit_duplicates(W.raw_accounts(s, d)), _with(PANEL, f"""
    SELECT 'duplicate_rows' AS metric, COUNT(*) - {_DISTINCT} AS value FROM panel
    UNION ALL SELECT 'duplicate_ids', COUNT(*) - COUNT(DISTINCT ID) FROM panel"""))
register("a3_duplicate_order_lines", lambda s, d: audit.audit_duplicates(
    read_table(s, d, "orders").select(F.col("o_custkey").alias("ID"), "o_orderstatus", "o_orderpriority")), """
    WITH t AS (SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders)
    SELECT 'duplicate_rows' AS metric, COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM t)) AS value FROM t
    UNION ALL SELECT 'duplicate_ids', COUNT(*) - COUNT(DISTINCT o_custkey) FROM t""")
_MISSING_COLUMNS = RAW_COLUMNS + ALL_FEATURES
register("a4_missing", lambda s, d: audit.audit_missing(W.customers(s, d)),
         _with(FEATURES, " UNION ALL ".join(
             f"SELECT '{c}' AS \"column\", COUNT(*) FILTER (WHERE {c} IS NULL) AS missing_count, "
             f"round_even(COUNT(*) FILTER (WHERE {c} IS NULL) * 100.0::DOUBLE / COUNT(*), 4) AS missing_pct FROM feat"
             for c in _MISSING_COLUMNS)))
register("a5_numeric_summary", lambda s, d: six(audit.audit_numeric(W.raw_accounts(s, d))),
         _with(PANEL, f"SELECT \"column\", metric, {sql_six('value')} AS value FROM ({_NUMERIC_SQL})"))
register("a6_categories", lambda s, d: audit.audit_categories(W.raw_accounts(s, d)),
         _with(PANEL, _codes(["SEX", "EDUCATION", "MARRIAGE"])))
register("a7_status_codes", lambda s, d: audit.audit_status(W.raw_accounts(s, d)), _with(PANEL, _codes(STATUS)))
register("a8_target", lambda s, d: audit.audit_target(W.raw_accounts(s, d)), _with(PANEL, """
    SELECT CAST(default_next_month AS BIGINT) AS code, COUNT(*) AS n,
           round_even(COUNT(*) * 100.0::DOUBLE / (SELECT COUNT(*) FROM panel), 3) AS rate_pct,
           (SELECT COUNT(*) FROM panel) AS total FROM panel GROUP BY 1"""))
register("a9_negative_bills", lambda s, d: audit.audit_negative_bills(W.raw_accounts(s, d)), _with(
    PANEL, " UNION ALL ".join(
        f"SELECT 'BILL_AMT{i}' AS \"column\", COUNT(*) FILTER (WHERE BILL_AMT{i} < 0) AS negative_count FROM panel"
        for i in range(1, 7))))
register("a10_id_uniqueness", lambda s, d: audit.audit_ids(W.raw_accounts(s, d)), _with(PANEL, """
    SELECT COUNT(DISTINCT ID) AS n_unique_ids, COUNT(*) AS n_rows, MIN(ID) AS id_min, MAX(ID) AS id_max,
           CAST((SELECT COUNT(*) FROM (SELECT ID FROM panel EXCEPT SELECT * FROM range(1, (SELECT COUNT(*) + 1 FROM panel)))) = 0
                AND COUNT(DISTINCT ID) = COUNT(*) AS INTEGER) AS id_is_sequential FROM panel"""))


def _full_audit_sql() -> str:
    def row(section, column, metric, value):
        return (f"SELECT '{section}' AS section, {column} AS \"column\", {metric} AS metric, "
                f"CAST({value} AS DOUBLE) AS value")

    parts = [row("schema", "'*'", "'n_rows'", "COUNT(*)") + " FROM panel",
             row("schema", "'*'", "'n_cols'", "25"),
             row("duplicates", "'*'", "'duplicate_rows'", f"COUNT(*) - {_DISTINCT}") + " FROM panel",
             row("duplicates", "'*'", "'duplicate_ids'", "COUNT(*) - COUNT(DISTINCT ID)") + " FROM panel",
             row("id_uniqueness", "'ID'", "'n_unique_ids'", "COUNT(DISTINCT ID)") + " FROM panel",
             row("id_uniqueness", "'ID'", "'n_rows'", "COUNT(*)") + " FROM panel",
             row("id_uniqueness", "'ID'", "'id_min'", "MIN(ID)") + " FROM panel",
             row("id_uniqueness", "'ID'", "'id_max'", "MAX(ID)") + " FROM panel",
             row("id_uniqueness", "'ID'", "'id_is_sequential'",
                 "COUNT(DISTINCT ID) = COUNT(*) AND MIN(ID) = 1 AND MAX(ID) = COUNT(*)") + " FROM panel",
             f"SELECT 'numeric', * FROM ({_NUMERIC_SQL})",
             f"SELECT 'categorical', \"column\", CAST(code AS VARCHAR), CAST(n AS DOUBLE) FROM ({_codes(['SEX', 'EDUCATION', 'MARRIAGE'])})",
             f"SELECT 'status', \"column\", CAST(code AS VARCHAR), CAST(n AS DOUBLE) FROM ({_codes(STATUS)})",
             "SELECT 'target', 'default_next_month', 'count_' || default_next_month, CAST(COUNT(*) AS DOUBLE) FROM panel GROUP BY default_next_month",
             "SELECT 'target', 'default_next_month', 'rate_pct_' || default_next_month, round_even(COUNT(*) * 100.0::DOUBLE / (SELECT COUNT(*) FROM panel), 3) FROM panel GROUP BY default_next_month"]
    for c in RAW_COLUMNS:
        gone = f"COUNT(*) FILTER (WHERE {c} IS NULL)"
        parts.append(row("missing", f"'{c}'", "'missing_count'", gone) + " FROM panel")
        parts.append(row("missing", f"'{c}'", "'missing_pct'", f"{gone} * 100.0 / COUNT(*)") + " FROM panel")
    for i in range(1, 7):
        parts.append(row("negative_bills", f"'BILL_AMT{i}'", "'count'",
                         f"COUNT(*) FILTER (WHERE BILL_AMT{i} < 0)") + " FROM panel")
    union = " UNION ALL ".join(parts)
    return _with(PANEL, f"SELECT section, \"column\", metric, {sql_six('value')} AS value FROM ({union})")


register("a11_full_audit", lambda s, d: six(audit.full_audit(W.raw_accounts(s, d))), _full_audit_sql())


def v1_quarantine(spark, d):
    """Panel rows with some fields pushed out of range, by ID."""
    raw = W.raw_accounts(spark, d)
    bent = raw.withColumns({
        "SEX": F.when(F.col(ID) % 11 == 0, 3).otherwise(F.col("SEX")),
        "LIMIT_BAL": F.when(F.col(ID) % 13 == 0, 0.0).otherwise(F.col("LIMIT_BAL")),
        "PAY_AMT2": F.when(F.col(ID) % 17 == 0, -1.0).otherwise(F.col("PAY_AMT2")),
        "AGE": F.when(F.col(ID) % 19 == 0, 17).when(F.col(ID) % 23 == 0, F.lit(None)).otherwise(F.col("AGE")),
    })
    _, quarantined = audit.split_valid(bent)
    return quarantined.select(ID, F.array_join(F.array_sort("problems"), "; ").alias("problems"))


register("v1_record_constraints", v1_quarantine, _with(PANEL, """
    SELECT ID, array_to_string(list_sort(list_filter([
        CASE WHEN ID % 11 = 0 THEN 'SEX out of range' END,
        CASE WHEN ID % 13 = 0 THEN 'LIMIT_BAL not positive' END,
        CASE WHEN ID % 17 = 0 THEN 'PAY_AMT2 negative' END,
        CASE WHEN ID % 19 = 0 THEN 'AGE out of range' WHEN ID % 23 = 0 THEN 'AGE missing' END],
        lambda x: x IS NOT NULL)), '; ') AS problems
    FROM panel WHERE ID % 11 = 0 OR ID % 13 = 0 OR ID % 17 = 0 OR ID % 19 = 0 OR ID % 23 = 0"""))


# ---- cleaning, bins, filters ----

def c1_clean(spark, d):
    renamed = W.raw_accounts(spark, d).withColumnRenamed(TARGET, "default payment next month")
    return clean.clean_accounts(renamed).select(ID, "EDUCATION", "MARRIAGE", TARGET)


def _bins(column, edges, source):
    def query(spark, d):
        value = F.col(column)
        return source(spark, d).select(ID, B.bin_number(value, edges).alias("band_no"),
                                       B.bin_label(value, edges).alias("band"))
    return query


def _bin_sql(column: str, edges: list, lowest: bool = False) -> tuple[str, str]:
    labels = B.interval_labels(edges, lowest)
    number, label = [], []
    for i, (low, high) in enumerate(zip(edges, edges[1:]), start=1):
        above = f"{column} >= {low}" if lowest and i == 1 else f"{column} > {low}"
        number.append(f"WHEN {above} AND {column} <= {high} THEN {i}")
        label.append(f"WHEN {above} AND {column} <= {high} THEN '{labels[i - 1]}'")
    return f"CASE {' '.join(number)} END", f"CASE {' '.join(label)} END"


def _bins_sql(column, edges, ctes, table):
    number, label = _bin_sql(column, edges)
    return _with(ctes, f"SELECT ID, {number} AS band_no, {label} AS band FROM {table}")


def b3_bands(spark, d):
    scored = W.scored_population(spark, d).select(ID, "predicted_pd")
    return scoring.add_band_and_class(scored, W.thresholds(spark, d))


register("c1_c3_clean", c1_clean, _with(CLEAN, "SELECT ID, EDUCATION, MARRIAGE, default_next_month FROM clean"))
register("b3_risk_bands", b3_bands, _with(SCORED, """
    SELECT ID, predicted_pd, risk_band, CAST(predicted_pd >= 0.5 AS INTEGER) AS predicted_class FROM banded"""))
register("b4_fairness_age_bands", _bins("AGE", B.FAIRNESS_AGE_EDGES, W.raw_accounts),
         _bins_sql("AGE", B.FAIRNESS_AGE_EDGES, PANEL, "panel"))
register("b5_age_bands", _bins("AGE", B.AGE_EDGES, W.raw_accounts), _bins_sql("AGE", B.AGE_EDGES, PANEL, "panel"))
register("b6_utilization_bands", _bins("UTIL_AVG", B.UTILIZATION_EDGES, W.customers),
         _bins_sql("UTIL_AVG", B.UTILIZATION_EDGES, FEATURES, "feat"))
register("b8_education_labels", lambda s, d: W.customers(s, d).select(
    ID, portfolio.education_label(F.col("EDUCATION")).alias("edu_label")), _with(CLEAN, """
    SELECT ID, CASE EDUCATION WHEN 1 THEN 'Graduate' WHEN 2 THEN 'University' WHEN 3 THEN 'High School'
           WHEN 4 THEN 'Other/Unknown' END AS edu_label FROM clean"""))
register("f1_filter_bands", lambda s, d: W.scored_customers(s, d).filter(
    F.col("risk_band").isin(RISK_BANDS[2:])).select(ID, "predicted_pd"), _with(SCORED, """
    SELECT ID, predicted_pd FROM scored WHERE risk_band IN ('High Risk', 'Very High Risk')"""))
register("f2_class_at_half", lambda s, d: W.scored_customers(s, d).select(
    ID, scoring.predicted_class().alias("predicted_class")),
    _with(SCORED, "SELECT ID, CAST(predicted_pd >= 0.5 AS INTEGER) AS predicted_class FROM scored"))

# ---- features ----

def _family(names):
    def query(spark, d):
        return six(W.featured(spark, d).select(ID, *names))

    shown = ", ".join(c if c in _INTEGER_FEATURES else f"{sql_six(c)} AS {c}" for c in names)
    return query, _with(FEATURES, f"SELECT ID, {shown} FROM feat")


register("u_utilization", *_family(UTILIZATION_FEATURES))
register("pc_payment_coverage", *_family(COVERAGE_FEATURES))
register("dl_delinquency", *_family(DELINQUENCY_FEATURES))
register("bp_balances_payments", *_family(BALANCE_FEATURES))
register("ex_exposure", *_family(EXPOSURE_FEATURES))
register("fx_all_39_features", *_family(ALL_FEATURES))

# ---- portfolio reports ----

_RATE = digits("100.0 * AVG(default_next_month)", 2) + " AS default_rate_pct"
_LIMIT = digits("AVG(LIMIT_BAL)", 0) + " AS avg_credit_limit"
register("q1_portfolio_size", lambda s, d: portfolio.portfolio_size(W.customers(s, d)), _with(FEATURES, f"""
    SELECT COUNT(*) AS total_customers, CAST(SUM(default_next_month) AS BIGINT) AS total_defaulters, {_RATE} FROM feat"""))
register("q2_limit_by_outcome", lambda s, d: portfolio.limit_by_outcome(W.customers(s, d)), _with(FEATURES, f"""
    SELECT default_next_month, COUNT(*) AS n_customers, {_LIMIT}, {digits("AVG(UTIL_AVG)", 3)} AS avg_utilization
    FROM feat GROUP BY default_next_month"""))
register("q3_risk_by_band", lambda s, d: portfolio.risk_by_band(W.scored_customers(s, d)), _with(SCORED, f"""
    SELECT risk_band, COUNT(*) AS n_customers, {digits("AVG(predicted_pd)", 4)} AS avg_predicted_pd,
           {digits("100.0 * AVG(actual_default)", 2)} AS actual_default_rate_pct, SUM(LIMIT_BAL) AS total_exposure
    FROM scored GROUP BY risk_band"""))
register("q4_rate_by_delinquency", lambda s, d: portfolio.rate_by_delinquency(W.customers(s, d)), _with(FEATURES, f"""
    SELECT N_MONTHS_DELINQUENT, COUNT(*) AS n_customers, {_RATE} FROM feat GROUP BY N_MONTHS_DELINQUENT"""))
register("q5_highest_risk", lambda s, d: six(portfolio.highest_risk(W.scored_customers(s, d))), _with(SCORED, f"""
    SELECT ID, LIMIT_BAL, predicted_pd, risk_band, N_MONTHS_DELINQUENT, {sql_six("UTIL_LATEST")} AS UTIL_LATEST,
           actual_default FROM scored WHERE risk_band = 'Very High Risk' ORDER BY predicted_pd DESC, ID LIMIT 25"""))
register("q6_by_education", lambda s, d: portfolio.by_education(W.customers(s, d)), _with(FEATURES, f"""
    SELECT EDUCATION, COUNT(*) AS n_customers, {_RATE}, {_LIMIT} FROM feat GROUP BY EDUCATION"""))
register("q7_by_age_band", lambda s, d: portfolio.by_age_band(W.customers(s, d)), _with(FEATURES, f"""
    SELECT CASE WHEN AGE < 25 THEN '<25' WHEN AGE < 35 THEN '25-34' WHEN AGE < 45 THEN '35-44'
                WHEN AGE < 55 THEN '45-54' ELSE '55+' END AS age_band, COUNT(*) AS n_customers, {_RATE}
    FROM feat GROUP BY 1"""))
register("q8_by_stress", lambda s, d: portfolio.by_stress(W.customers(s, d)), _with(FEATURES, f"""
    SELECT UTILIZATION_STRESS_FLAG, COUNT(*) AS n_customers, {_RATE} FROM feat GROUP BY 1"""))
register("q9_exposure_concentration", lambda s, d: portfolio.exposure_concentration(W.scored_customers(s, d)),
         _with(SCORED, f"""
    SELECT risk_band, SUM(LIMIT_BAL) AS segment_exposure,
           {digits("100.0 * SUM(LIMIT_BAL) / (SELECT SUM(LIMIT_BAL) FROM scored)", 2)} AS pct_of_total_exposure
    FROM scored GROUP BY risk_band"""))
register("q10_top_band_outcomes", lambda s, d: portfolio.top_band_outcomes(W.scored_customers(s, d)), _with(SCORED, """
    SELECT COUNT(*) AS n_high_pd_customers, COUNT(*) FILTER (WHERE actual_default = 0) AS false_positives_in_band,
           COUNT(*) FILTER (WHERE actual_default = 1) AS true_positives_in_band
    FROM scored WHERE risk_band IN ('High Risk', 'Very High Risk')"""))

_ORDERED = "(VALUES (1, 'Low Risk'), (2, 'Moderate Risk'), (3, 'High Risk'), (4, 'Very High Risk')) b(band_no, risk_band)"
register("g1_headline_numbers", lambda s, d: six(portfolio.headline_numbers(W.customers(s, d), W.scored_customers(s, d))),
         _with(SCORED, f"""
    SELECT (SELECT COUNT(*) FROM feat) AS total_customers, {sql_six("(SELECT SUM(LIMIT_BAL) FROM feat)")} AS total_exposure,
           {sql_six("(SELECT AVG(default_next_month) * 100 FROM feat)")} AS default_rate_pct,
           {sql_six("AVG(predicted_pd) * 100")} AS avg_pd_pct,
           {sql_six("100.0 * COUNT(*) FILTER (WHERE risk_band IN ('High Risk', 'Very High Risk')) / COUNT(*)")} AS high_risk_pct
    FROM scored"""))
register("g2_band_counts", lambda s, d: portfolio.band_counts(W.scored_customers(s, d)), _with(SCORED, f"""
    SELECT risk_band, band_no, customers FROM {_ORDERED}
    LEFT JOIN (SELECT risk_band, COUNT(*) AS customers FROM scored GROUP BY 1) USING (risk_band)"""))
register("g3_segment_summary", lambda s, d: six(portfolio.segment_summary(W.scored_customers(s, d))), _with(SCORED, f"""
    SELECT risk_band, band_no, customers, {sql_six("avg_predicted_pd")} AS avg_predicted_pd,
           {sql_six("actual_default_rate")} AS actual_default_rate, {sql_six("total_exposure")} AS total_exposure,
           {sql_six("total_exposure / (SELECT SUM(LIMIT_BAL) FROM scored)")} AS exposure_share
    FROM {_ORDERED} LEFT JOIN (SELECT risk_band, COUNT(*) AS customers, AVG(predicted_pd) AS avg_predicted_pd,
           AVG(actual_default) AS actual_default_rate, SUM(LIMIT_BAL) AS total_exposure FROM scored GROUP BY 1)
    USING (risk_band)"""))
register("j2_low_bands_only", lambda s, d: portfolio.band_counts(
    W.scored_customers(s, d).filter(~F.col("risk_band").isin(RISK_BANDS[2:]))), _with(SCORED, f"""
    SELECT risk_band, band_no, customers FROM {_ORDERED} LEFT JOIN (SELECT risk_band, COUNT(*) AS customers
    FROM scored WHERE risk_band NOT IN ('High Risk', 'Very High Risk') GROUP BY 1) USING (risk_band)"""))


def j3_lookup(spark, d):
    scored = W.scored_customers(spark, d)
    attributed = explain.contribution_rows(
        scored.filter(F.col("N_MONTHS_DELINQUENT") > 2), scoring.scorecard_terms())
    known, unknown = explain.split_explained(scored.select(ID), attributed)
    return known.withColumn("explained", F.lit(1)).unionByName(unknown.withColumn("explained", F.lit(0)))


register("j3_explained_accounts", j3_lookup, _with(SCORED, """
    SELECT ID, CASE WHEN N_MONTHS_DELINQUENT > 2 THEN 1 ELSE 0 END AS explained FROM scored"""))
register("g4_target_distribution", lambda s, d: six(portfolio.target_distribution(W.customers(s, d))), _with(CLEAN, f"""
    SELECT default_next_month, COUNT(*) AS n, {sql_six("100.0 * COUNT(*) / (SELECT COUNT(*) FROM clean)")} AS share_pct
    FROM clean GROUP BY 1"""))


def _rate_sql(label_name: str, number: str | None, label: str) -> str:
    keys = f"{number} AS band_no, {label} AS {label_name}" if number else f"{label} AS {label_name}"
    return _with(FEATURES, f"""
        SELECT * REPLACE ({sql_six("default_rate_pct")} AS default_rate_pct) FROM (
        SELECT {keys}, COUNT(*) AS n, AVG(default_next_month) * 100 AS default_rate_pct FROM feat
        WHERE {label} IS NOT NULL GROUP BY ALL)""")


register("g5_rate_by_age_band", lambda s, d: six(portfolio.rate_by_age_band(W.customers(s, d))),
         _rate_sql("age_band", *_bin_sql("AGE", B.AGE_EDGES)))
register("g5_rate_by_utilization_band", lambda s, d: six(portfolio.rate_by_utilization_band(W.customers(s, d))),
         _rate_sql("util_band", *_bin_sql("UTIL_AVG", B.UTILIZATION_EDGES)))
register("g5_rate_by_education_label", lambda s, d: six(portfolio.rate_by_education_label(W.customers(s, d))),
         _rate_sql("edu_label", None, "CASE EDUCATION WHEN 1 THEN 'Graduate' WHEN 2 THEN 'University' "
                   "WHEN 3 THEN 'High School' WHEN 4 THEN 'Other/Unknown' END"))
register("g5_rate_by_delinquent_months", lambda s, d: six(portfolio.rate_by_delinquent_months(W.customers(s, d))),
         _rate_sql("N_MONTHS_DELINQUENT", None, "N_MONTHS_DELINQUENT"))


def _fair(dimension: str, key: str) -> str:
    return f"""SELECT '{dimension}' AS dimension, CAST({key} AS VARCHAR) AS "group", COUNT(*) AS n,
        {sql_six("AVG(actual_default)")} AS actual_default_rate, {sql_six("AVG(predicted_pd)")} AS avg_predicted_pd,
        {sql_six("COUNT(*) FILTER (WHERE predicted_pd >= 0.5 AND actual_default = 1) / nullif(COUNT(*) FILTER (WHERE actual_default = 1), 0)")} AS tpr_recall,
        {sql_six("COUNT(*) FILTER (WHERE predicted_pd >= 0.5 AND actual_default = 0) / nullif(COUNT(*) FILTER (WHERE actual_default = 0), 0)")} AS fpr,
        {sql_six("COUNT(*) FILTER (WHERE predicted_pd < 0.5 AND actual_default = 1) / nullif(COUNT(*) FILTER (WHERE actual_default = 1), 0)")} AS fnr
        FROM scored WHERE {key} IS NOT NULL GROUP BY 2"""


register("g8_fairness", lambda s, d: six(portfolio.fairness(W.scored_customers(s, d))), _with(SCORED, " UNION ALL ".join(
    [_fair("SEX", "SEX"), _fair("AGE_BAND", f"({_bin_sql('AGE', B.FAIRNESS_AGE_EDGES)[1]})"),
     _fair("EDUCATION", "EDUCATION")])))
register("g9_expected_loss", lambda s, d: six(portfolio.expected_loss(W.scored_customers(s, d))), _with(SCORED, f"""
    SELECT lgd, {sql_six("SUM(predicted_pd * lgd * LIMIT_BAL)")} AS total_expected_loss,
           {sql_six("AVG(predicted_pd * lgd * LIMIT_BAL)")} AS avg_expected_loss
    FROM scored, (VALUES (0.45::DOUBLE), (0.6::DOUBLE), (0.75::DOUBLE)) l(lgd) GROUP BY lgd"""))


def sc5_card(spark, d):
    scored = W.scored_customers(spark, d)
    ids = read_table(spark, d, "customer").filter("c_acctbal > 0").select((F.col("c_custkey") + 1).alias(ID))
    return six(portfolio.customer_card(scored, ids))


register("sc5_customer_cards", sc5_card, _with(SCORED, f"""
    SELECT ID, predicted_pd, risk_band, LIMIT_BAL, {sql_six("UTIL_LATEST")} AS UTIL_LATEST, N_MONTHS_DELINQUENT,
           MAX_DELINQUENCY, CASE WHEN actual_default = 1 THEN 'Defaulted' ELSE 'No Default' END AS outcome
    FROM scored WHERE ID IN (SELECT c_custkey + 1 FROM customer WHERE c_acctbal > 0)"""))
