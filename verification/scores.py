"""Queries over scores: metrics, association, drift, triggers, contributions, prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import association, drift, explain, isotonic, metrics, portfolio, resample, scoring
from riskloom.operators.neighbours import nearest_neighbours
from riskloom.operators.split import class_weights, split_summary, stratified_split
from riskloom.operators.learning import fit_preprocessor, medians
from riskloom.plans import training, warehouse as W
from riskloom.schema import ID, NUMERIC, TARGET
from riskloom.session import cut_lineage, scratch_path
from riskloom.sources.accounts import as_json, write_results
from riskloom.sources.panel import read_table
from verification.common import monitored, six, six_features, two_models
from verification.oracle import FEATURES, MODELS, SCORED, psi
from verification.oracle import six as sql_six

QUERIES, ORACLE = {}, {}
MODEL_KEY = ["model"]


def register(name, query, sql=None):
    QUERIES[name] = query
    if sql is not None:
        ORACLE[name] = sql


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def _rounded(names: list[str]) -> str:
    return ", ".join(f"{sql_six(n)} AS {n}" for n in names)


# ---- rank and class metrics ----

def _ranks(names):
    return lambda s, d: six(metrics.rank_metrics(two_models(s, d), "p", "y", MODEL_KEY).select("model", *names))


for _key, _name in (("m1_roc_auc", "roc_auc"), ("m2_average_precision", "pr_auc"), ("m3_ks", "ks")):
    register(_key, _ranks([_name]), _with(MODELS, f"SELECT model, {_rounded([_name])} FROM ranks"))
register("m4_brier", lambda s, d: six(metrics.class_metrics(two_models(s, d), "p", "y", MODEL_KEY).select(
    "model", "brier_score")), _with(MODELS, f"SELECT model, {_rounded(['brier_score'])} FROM cells"))
_CLASS = ['"precision"', "recall", "f1"]
register("m5_m6_classification", lambda s, d: six(metrics.class_metrics(two_models(s, d), "p", "y", MODEL_KEY).drop(
    "brier_score")), _with(MODELS, f"SELECT model, tn, fp, fn, tp, {_rounded(_CLASS)} FROM classed"))
register("m7_full_metrics", lambda s, d: six(metrics.full_metrics(two_models(s, d), "p", "y", MODEL_KEY)),
         _with(MODELS, f"""SELECT model, {_rounded(["roc_auc", "pr_auc", "ks", "brier_score", *_CLASS])}, tn, fp, fn, tp,
         0.5::DOUBLE AS threshold FROM classed JOIN ranks USING (model)"""))
register("m8_curve_points", lambda s, d: six(metrics.curve_points(two_models(s, d), "p", "y", MODEL_KEY)),
         _with(MODELS, f"""SELECT model, p AS score, {sql_six("fp / nn")} AS fpr, {sql_six("tp / np")} AS tpr,
         {sql_six("tp / (tp + fp)")} AS "precision", {sql_six("tp / np")} AS recall FROM pts"""))
register("l16_isotonic_blocks", lambda s, d: six(isotonic.pooled(two_models(s, d), "p", "y", MODEL_KEY).withColumn(
    "rate", F.col("hits") / F.col("n"))), _with(MODELS, f"""
    , seen AS (SELECT model, p, COUNT(*) AS n, SUM(y)::BIGINT AS hits, row_number() OVER (PARTITION BY model ORDER BY p) AS i
        FROM two GROUP BY model, p),
    sums AS (SELECT *, SUM(n) OVER w AS cn, SUM(hits) OVER w AS ch FROM seen WINDOW w AS (PARTITION BY model ORDER BY i)),
    -- the fitted value at i: the largest, over beginnings a <= i, of the smallest mean from a to some b >= i
    spans AS (SELECT a.model, a.i AS a, b.i AS b, (b.ch - a.ch + a.hits) / (b.cn - a.cn + a.n)::DOUBLE AS mean FROM sums a JOIN sums b ON a.model = b.model AND a.i <= b.i),
    least AS (SELECT model, a, b AS i, MIN(mean) OVER (PARTITION BY model, a ORDER BY b DESC) AS mean FROM spans),
    fitted AS (SELECT model, i, MAX(mean) AS rate FROM least GROUP BY model, i)
    SELECT model, {sql_six("MIN(p)")} AS low, {sql_six("MAX(p)")} AS high, SUM(n)::BIGINT AS n, SUM(hits)::BIGINT AS hits, {sql_six("MIN(rate)")} AS rate
    FROM fitted JOIN seen USING (model, i) GROUP BY model, round(rate, 12)"""))
register("m9_best_model", lambda s, d: six(metrics.best_model(metrics.rank_metrics(
    two_models(s, d), "p", "y", MODEL_KEY)).select("model", "selection_score")), _with(MODELS, f"""
    SELECT model, {sql_six("(roc_auc + pr_auc) / 2")} AS selection_score FROM ranks
    ORDER BY (roc_auc + pr_auc) / 2 DESC, model LIMIT 1"""))


def m10_comparison(spark, d):
    rows = cut_lineage(metrics.full_metrics(two_models(spark, d), "p", "y", MODEL_KEY))
    return six(metrics.comparison_table(rows, ["roc_auc", "pr_auc", "ks", "brier_score", "f1"]))


_M10 = " UNION ALL ".join(
    f"SELECT '{m}' AS metric, {sql_six(f'MAX({m}) FILTER (WHERE model = {q}first{q})')} AS first, "
    f"{sql_six(f'MAX({m}) FILTER (WHERE model = {q}second{q})')} AS second FROM classed JOIN ranks USING (model)"
    for q in ["'"] for m in ["roc_auc", "pr_auc", "ks", "brier_score", "f1"])
register("m10_model_comparison", m10_comparison, _with(MODELS, _M10))
_BAND_NO = ("CASE WHEN predicted_pd <= 0.05 THEN 1 WHEN predicted_pd <= 0.1 THEN 2 WHEN predicted_pd <= 0.2 THEN 3 "
            "WHEN predicted_pd <= 0.4 THEN 4 ELSE 5 END")
register("g6_calibration_table", lambda s, d: six(metrics.calibration_table(
    W.scored_customers(s, d), "predicted_pd", "actual_default")), _with(SCORED, f"""
    SELECT {_BAND_NO} AS band_no, ['(-0.001, 0.05]', '(0.05, 0.1]', '(0.1, 0.2]', '(0.2, 0.4]', '(0.4, 1.0]'][{_BAND_NO}] AS band,
           COUNT(*) AS customers, {sql_six("AVG(predicted_pd)")} AS avg_predicted_pd,
           {sql_six("AVG(actual_default)")} AS actual_default_rate FROM scored GROUP BY 1, 2"""))
register("g7_reliability_curve", lambda s, d: six(metrics.reliability_curve(
    W.scored_population(s, d), "predicted_pd", "actual_default")), _with(SCORED, f"""
    SELECT bin, COUNT(*) AS customers, {sql_six("AVG(predicted_pd)")} AS mean_predicted,
           {sql_six("AVG(actual_default)")} AS fraction_positive FROM (
    SELECT CAST(len(list_filter(cuts9, lambda c: predicted_pd > c)) AS INTEGER) AS bin, predicted_pd, actual_default
    FROM pop, (SELECT quantile_cont(predicted_pd, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS cuts9 FROM pop))
    GROUP BY bin"""))
register("g11_split_summary", lambda s, d: six(split_summary(W.folds(s, d))), _with(SCORED, f"""
    SELECT fold, COUNT(*) AS n, {sql_six("AVG(actual_default)")} AS default_rate FROM pop GROUP BY fold"""))

# ---- association ----

register("t1_crosstab", lambda s, d: association.crosstab(W.customers(s, d), ["SEX", "EDUCATION", "MARRIAGE"]),
         _with(FEATURES, " UNION ALL ".join(
             f"SELECT '{c}' AS variable, CAST({c} AS BIGINT) AS code, COUNT(*) FILTER (WHERE default_next_month = 0) AS n0, "
             f"COUNT(*) FILTER (WHERE default_next_month = 1) AS n1 FROM feat GROUP BY {c}"
             for c in ["SEX", "EDUCATION", "MARRIAGE"])))


def _chi_sql(source: str, pairs: list[tuple[str, str]]) -> str:
    """Expected counts by joining the margins; every cell of the grid is listed."""
    cells = " UNION ALL ".join(
        f"SELECT '{v}' AS variable, r.v AS rv, c.v AS cv, (SELECT COUNT(*) FROM {source} WHERE {v} = r.v AND {t} = c.v) AS o, "
        f"r.n * c.n / (SELECT COUNT(*) FROM {source} WHERE {v} IS NOT NULL AND {t} IS NOT NULL) AS e "
        f"FROM (SELECT {v} AS v, COUNT(*) AS n FROM {source} WHERE {t} IS NOT NULL AND {v} IS NOT NULL GROUP BY 1) r, "
        f"(SELECT {t} AS v, COUNT(*) AS n FROM {source} WHERE {v} IS NOT NULL AND {t} IS NOT NULL GROUP BY 1) c"
        for v, t in pairs)
    return f"""cells2 AS ({cells}),
    shape AS (SELECT variable, COUNT(DISTINCT rv) AS r, COUNT(DISTINCT cv) AS k, SUM(o) AS n FROM cells2 GROUP BY 1),
    stat AS (SELECT variable, (r - 1) * (k - 1) AS dof, least(r - 1, k - 1) AS small, n,
             SUM(power(CASE WHEN (r - 1) * (k - 1) = 1 THEN greatest(abs(o - e) - 0.5, 0) ELSE abs(o - e) END, 2) / e) AS chi2
             FROM cells2 JOIN shape USING (variable) GROUP BY ALL)
    SELECT variable, {sql_six("chi2")} AS chi2, dof, {sql_six("sqrt(chi2 / n / small)")} AS cramers_v FROM stat"""


register("t2_chi_square", lambda s, d: six(association.chi_square(W.customers(s, d))),
         _with(FEATURES, ", " + _chi_sql("feat", [(c, TARGET) for c in ["SEX", "EDUCATION", "MARRIAGE"]])).replace(",\n, ", ", "))
register("t2_chi_square_labels", lambda s, d: six(association.chi_square(
    read_table(s, d, "labels"), ["quality"], "toxic")), "WITH " + _chi_sql("labels", [("quality", "toxic")]))


def _chi_with_p(spark, d):
    return six(association.with_chi_square_p(six(association.chi_square(W.customers(spark, d)))))


def _means_with_p(spark, d):
    return six(association.with_student_p(six(association.group_means(W.customers(spark, d)))))


# sums of the series of the lower incomplete gamma and beta functions, every term through lgamma
_CHI_P = sql_six("""CASE WHEN chi2 <= 0 THEN 1 ELSE greatest(0, 1 - list_sum(list_transform(range(2000), lambda i:
    exp(-chi2 / 2 + (dof / 2.0 + i) * ln(chi2 / 2) - lgamma(dof / 2.0 + i + 1))))) END""")
_STUDENT_P = sql_six("""CASE WHEN t_stat = 0 THEN 1 ELSE greatest(0, 1 - list_sum(list_transform(range(4000), lambda i:
    exp((i + 0.5) * ln(t_stat * t_stat / (dof + t_stat * t_stat)) + dof / 2 * ln(dof / (dof + t_stat * t_stat))
        + lgamma(dof / 2 + 0.5 + i) - lgamma(dof / 2) - lgamma(1.5 + i))))) END""")
_CHI_P_SQL = f"SELECT *, {_CHI_P} AS p_value FROM ({ORACLE['t2_chi_square']})"
register("t2_p_values", _chi_with_p, _CHI_P_SQL)
_SUITE = association.SUITE_NUMERIC
register("t3_group_means", lambda s, d: six(association.group_means(W.customers(s, d))), _with(FEATURES, " UNION ALL ".join(f"""
    SELECT '{c}' AS variable, {sql_six("m0")} AS mean_no_default, {sql_six("m1")} AS mean_default,
           {sql_six("(m0 - m1) / sqrt(v0 / n0 + v1 / n1)")} AS t_stat,
           {sql_six("power(v0 / n0 + v1 / n1, 2) / (power(v0 / n0, 2) / (n0 - 1) + power(v1 / n1, 2) / (n1 - 1))")} AS dof,
           {sql_six("(m1 - m0) / sqrt((v0 + v1) / 2)")} AS cohens_d
    FROM (SELECT AVG({c}) FILTER (WHERE default_next_month = 0) AS m0, AVG({c}) FILTER (WHERE default_next_month = 1) AS m1,
                 var_samp({c}) FILTER (WHERE default_next_month = 0) AS v0, var_samp({c}) FILTER (WHERE default_next_month = 1) AS v1,
                 COUNT({c}) FILTER (WHERE default_next_month = 0) AS n0, COUNT({c}) FILTER (WHERE default_next_month = 1) AS n1
          FROM feat)""" for c in _SUITE)))
_STUDENT_P_SQL = f"SELECT *, {_STUDENT_P} AS p_value FROM ({ORACLE['t3_group_means']})"
register("t3_p_values", _means_with_p, _STUDENT_P_SQL)
register("t4_correlation", lambda s, d: six(association.correlation(W.customers(s, d))), _with(FEATURES, " UNION ALL ".join(
    f"SELECT '{c}' AS variable, {sql_six(f'corr({c}, default_next_month)')} AS r FROM feat" for c in _SUITE)))


def t5_suite(spark, d):
    return association.stacked_tests(_chi_with_p(spark, d), _means_with_p(spark, d), six(association.correlation(W.customers(spark, d))))


_LONG = " UNION ALL ".join(
    f"SELECT '{test}' AS test, variable, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM ({sql})"
    for test, sql, names in (("chi_square", _CHI_P_SQL, ["chi2", "p_value", "dof", "cramers_v"]),
                             ("group_test", _STUDENT_P_SQL, ["mean_no_default", "mean_default", "t_stat", "p_value", "cohens_d"]),
                             ("correlation", ORACLE["t4_correlation"], ["r"])) for m in names)
register("t5_association_suite", t5_suite, _LONG)

# ---- drift ----

_DRIFT_FEATURES = ["UTIL_AVG", "PAYCOV_AVG", "LIMIT_BAL", "N_MONTHS_DELINQUENT", "AGE"]
_FLAG = ("CASE WHEN psi < 0.10 THEN 'stable' WHEN psi < 0.25 THEN 'moderate_shift_investigate' "
         "ELSE 'major_shift_investigate_urgently' END")


def _event_halves(spark, d):
    events = read_table(spark, d, "events").select("ts", F.col("value").alias("amount"))
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    return events.filter(F.col("ts") < cut), events.filter(F.col("ts") >= cut)


def d1_psi_events(spark, d):
    before, after = _event_halves(spark, d)
    return six(drift.stability_index(before, after, ["amount"]))


def _train_test(spark, d):
    population = W.scored_population(spark, d)
    return population.filter(F.col("fold") == "train"), population.filter(F.col("fold") == "test")


register("d1_psi_events", d1_psi_events, "WITH " + """before AS (SELECT value AS amount FROM events WHERE ts < TIMESTAMP '2024-01-16'),
    later AS (SELECT value AS amount FROM events WHERE ts >= TIMESTAMP '2024-01-16'),""" + psi("before", "later", ["amount"]) + f"""
    SELECT feature, {sql_six("psi")} AS psi FROM psi""")
register("d2_d3_feature_drift", lambda s, d: six(drift.feature_drift(
    *_train_test(s, d), [*_DRIFT_FEATURES, "NOT_A_COLUMN"])),
    _with(SCORED + "," + psi("train", "scored", _DRIFT_FEATURES), f"SELECT feature, {sql_six('psi')} AS psi, {_FLAG} AS flag FROM psi"))
# all columns at six decimals: a trend that is zero but for its last bit would
# otherwise fall on either side of a cut at zero
register("d2_feature_drift_all", lambda s, d: six(drift.feature_drift(
    *[six(side.select(*NUMERIC)) for side in _train_test(s, d)], NUMERIC)),
    _with(SCORED + "," + psi("train", "scored", NUMERIC, value=lambda f: sql_six(f"CAST({f} AS DOUBLE)")), f"SELECT feature, {sql_six('psi')} AS psi, {_FLAG} AS flag FROM psi"))
register("d4_prediction_drift", lambda s, d: six(drift.prediction_drift(*_train_test(s, d), "predicted_pd")),
         _with(SCORED + "," + psi("train", "scored", ["predicted_pd"]), f"""
    SELECT {sql_six("(SELECT AVG(predicted_pd) FROM train)")} AS reference_avg_pd, {sql_six("(SELECT AVG(predicted_pd) FROM scored)")} AS current_avg_pd,
           {sql_six("psi")} AS psi, {sql_six("(SELECT stddev_pop(predicted_pd) FROM train)")} AS reference_pd_std,
           {sql_six("(SELECT stddev_pop(predicted_pd) FROM scored)")} AS current_pd_std FROM psi"""))
register("d5_train_test_psi", lambda s, d: six(drift.stability_index(*_train_test(s, d), ["predicted_pd"])),
         _with(SCORED + "," + psi("train", "scored", ["predicted_pd"]), f"SELECT feature, {sql_six('psi')} AS psi FROM psi"))
_PERIOD_MODELS = MODELS.replace(
    MODELS[MODELS.index("two AS ("):MODELS.index("curve AS (")],
    "two AS (SELECT CAST(1 + ID % 4 AS INTEGER) AS model, predicted_pd AS p, actual_default AS y FROM scored),\n")
register("d6_metrics_by_period", lambda s, d: six(metrics.full_metrics(
    monitored(s, d), "predicted_pd", "actual_default", ["period"]).drop("threshold")), _with(_PERIOD_MODELS, f"""
    SELECT model AS period, {_rounded(["roc_auc", "pr_auc", "ks", "brier_score", *_CLASS])}, tn, fp, fn, tp
    FROM classed JOIN ranks USING (model)"""))


def d7_triggers(spark, d):
    train, _ = _train_test(spark, d)
    current = monitored(spark, d)
    validated = metrics.full_metrics(
        W.scored_customers(spark, d).withColumn("model", F.lit("scorecard")), "predicted_pd", "actual_default", MODEL_KEY)
    periods = metrics.full_metrics(current, "predicted_pd", "actual_default", ["period"])
    return six(drift.retraining_triggers(six_features(train), six_features(current), validated, periods, "period", NUMERIC))


_D7 = SCORED + "," + psi("train", "scored", ["predicted_pd", *NUMERIC], by="1 + ID % 4",
                             value=lambda f: f if f == "predicted_pd" else sql_six(f"CAST({f} AS DOUBLE)")) + ", " + MODELS[
    MODELS.index("two AS ("):].replace(
    MODELS[MODELS.index("two AS ("):MODELS.index("curve AS (")],
    "two AS (SELECT 1 + ID % 4 AS model, predicted_pd AS p, actual_default AS y FROM scored "
    "UNION ALL SELECT 0, predicted_pd, actual_default FROM scored),\n") + """,
    mr AS (SELECT model AS period, roc_auc, brier_score FROM classed JOIN ranks USING (model)),
    rate AS (SELECT risk_band, 1 + ID % 4 AS period, abs(AVG(actual_default) - AVG(predicted_pd)) / AVG(predicted_pd) > 0.3 AS out
             FROM scored GROUP BY ALL),
    twice AS (SELECT period, out AND coalesce(lag(out) OVER (PARTITION BY risk_band ORDER BY period), false) AS t FROM rate),
    rows7 AS (
    SELECT 'predicted_pd_psi' AS "trigger", period, psi AS value, 0.25 AS "limit", psi > 0.25 AS f FROM psi WHERE feature = 'predicted_pd'
    UNION ALL SELECT 'feature_psi', period, MAX(psi), 0.25, MAX(psi) > 0.25 FROM psi WHERE feature <> 'predicted_pd' GROUP BY period
    UNION ALL SELECT 'roc_auc_drop', period, (SELECT roc_auc FROM mr WHERE period = 0) - roc_auc, 0.03,
                     (SELECT roc_auc FROM mr WHERE period = 0) - roc_auc > 0.03 FROM mr WHERE period > 0
    UNION ALL SELECT 'brier_increase', period, brier_score - (SELECT brier_score FROM mr WHERE period = 0), 0.01,
                     brier_score - (SELECT brier_score FROM mr WHERE period = 0) > 0.01 FROM mr WHERE period > 0
    UNION ALL SELECT 'band_divergence_two_periods', period, CAST(bool_or(t) AS INTEGER), 0.30, bool_or(t) FROM twice GROUP BY period)"""
register("d7_retraining_triggers", d7_triggers, _with(_D7, f"""
    SELECT "trigger", CAST(period AS INTEGER) AS period, {sql_six("value")} AS value, {sql_six('"limit"')} AS "limit",
           CAST(f AS INTEGER) AS fired FROM rows7"""))
register("th1_thresholds", lambda s, d: six(scoring.band_thresholds(_train_test(s, d)[0].select("predicted_pd"))),
         _with(SCORED, f"SELECT {_rounded(['low_max', 'moderate_max', 'high_max'])} FROM cuts"))

# ---- learning pieces with closed forms ----

register("l1_stratified_split", lambda s, d: stratified_split(W.customers(s, d)).select(ID, TARGET, "fold"),
         _with(SCORED, "SELECT ID, default_next_month, fold FROM pop"))
register("l2_medians", lambda s, d: six(medians(W.train_fold(s, d))), _with(SCORED, " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {sql_six(f'quantile_cont({c}, 0.5)')} AS median FROM train" for c in NUMERIC)))


def l3_scaled(spark, d):
    """All numeric columns through the scaling stage of the fitted preprocessor."""
    train = W.train_fold(spark, d)
    scaled = fit_preprocessor(train).stages[0].transform(train)
    return six(scaled.select(ID, *[F.col(f"z_{c}").alias(c) for c in NUMERIC]))


_FILLED = ", ".join(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM train)) AS {c}" for c in NUMERIC)
register("l3_standardized", l3_scaled, _with(SCORED + f", filled AS (SELECT ID, {_FILLED} FROM train)", "SELECT ID, " + ", ".join(
    f"{sql_six(f'({c} - AVG({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1)')} AS {c}" for c in NUMERIC) + " FROM filled"))


def l11_nearest(spark, d):
    """The five nearest other defaulters of each defaulter of the training fold, over all scaled columns."""
    train = W.train_fold(spark, d)
    scaled = fit_preprocessor(train).stages[0].transform(train.filter(F.col(TARGET) == 1))
    vectors = scaled.select(ID, F.array(*[f"z_{c}" for c in NUMERIC]).alias("x"))
    return six(nearest_neighbours(vectors, 5))


_VECTOR = ", ".join(f"({c} - AVG({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1)" for c in NUMERIC)
register("l11_neighbours", l11_nearest, _with(SCORED + f""", filled AS (SELECT ID, actual_default, {_FILLED} FROM train),
    vectors AS (SELECT ID, actual_default, [{_VECTOR}] AS x FROM filled), bad AS (SELECT * FROM vectors WHERE actual_default = 1),
    pairs AS (SELECT a.ID, b.ID AS neighbour, list_distance(a.x, b.x) AS distance FROM bad a JOIN bad b ON a.ID <> b.ID)""", f"""
    SELECT ID, CAST(rank AS INTEGER) AS rank, neighbour, {sql_six("distance")} AS distance FROM (
        SELECT *, row_number() OVER (PARTITION BY ID ORDER BY distance, neighbour) AS rank FROM pairs) WHERE rank <= 5"""))
register("l9_class_weights", lambda s, d: six(class_weights(W.train_fold(s, d))), _with(SCORED, f"""
    SELECT actual_default AS class, COUNT(*) AS n, {sql_six("(SELECT COUNT(*) FROM train) / (2.0 * COUNT(*))")} AS balanced_weight,
           {sql_six("CASE actual_default WHEN 1 THEN (SELECT COUNT(*) FROM train WHERE actual_default = 0) / COUNT(*) ELSE 1 END")} AS positive_weight
    FROM train GROUP BY actual_default"""))


def l13_valid(spark, d):
    """Argmax over three utilization months, rounding of two ratios into flags."""
    names = ["UTIL_1", "UTIL_2", "UTIL_3", "UTIL_VOLATILITY", "PAYMENT_CAPACITY"]
    valid = resample.make_valid([F.col(n) for n in names], [[0, 1, 2]], [3, 4])
    return W.customers(spark, d).select(ID, *[c.alias(n) for c, n in zip(valid, names)])


register("l13_valid_rows", l13_valid, _with(FEATURES, """
    SELECT ID, CAST(UTIL_1 >= UTIL_2 AND UTIL_1 >= UTIL_3 AS DOUBLE) AS UTIL_1,
           CAST(UTIL_2 > UTIL_1 AND UTIL_2 >= UTIL_3 AS DOUBLE) AS UTIL_2,
           CAST(UTIL_3 > UTIL_1 AND UTIL_3 > UTIL_2 AS DOUBLE) AS UTIL_3,
           greatest(least(round_even(UTIL_VOLATILITY, 0), 1.0), 0.0) AS UTIL_VOLATILITY,
           greatest(least(round_even(PAYMENT_CAPACITY, 0), 1.0), 0.0) AS PAYMENT_CAPACITY FROM feat"""))
_COMPARED = ["LIMIT_BAL", "AGE", "UTIL_AVG", "BILL_AVG", "PAYAMT_AVG", "N_MONTHS_DELINQUENT"]


def _two_minorities(spark, d):
    return (W.train_fold(spark, d).filter(F.col(TARGET) == 1), W.test_fold(spark, d).filter(F.col(TARGET) == 1))


_SIDES = SCORED + """, ra AS (SELECT * FROM train WHERE actual_default = 1), sa AS (SELECT * FROM scored WHERE actual_default = 1),
    cmp AS (""" + " UNION ALL ".join(f"""
    SELECT '{c}' AS feature, abs(sm - rm) / (abs(rm) + 1e-6) AS mean_pct_diff, abs(ss - rs) / (abs(rs) + 1e-6) AS std_pct_diff,
           abs(sm - rm) / (rs + 1e-8) AS std_mean_diff
    FROM (SELECT AVG({c}) AS rm, stddev_pop({c}) AS rs FROM ra), (SELECT AVG({c}) AS sm, stddev_pop({c}) AS ss FROM sa)"""
    for c in _COMPARED) + ")"
register("l14_moment_differences", lambda s, d: six(resample.compare_moments(*_two_minorities(s, d), _COMPARED)),
         _with(_SIDES, f"SELECT feature, {_rounded(['mean_pct_diff', 'std_pct_diff', 'std_mean_diff'])} FROM cmp"))
_PAIRS = " + ".join(
    f"2 * power(coalesce((SELECT corr({a}, {b}) FROM ra), 0) - coalesce((SELECT corr({a}, {b}) FROM sa), 0), 2)"
    for i, a in enumerate(_COMPARED) for b in _COMPARED[i + 1:])
register("l14_distribution_diagnostics", lambda s, d: six(resample.distribution_diagnostics(
    *_two_minorities(s, d), _COMPARED)), _with(_SIDES, f"""
    SELECT 'mean_abs_pct_diff' AS metric, {sql_six("AVG(mean_pct_diff)")} AS value FROM cmp
    UNION ALL SELECT 'std_abs_pct_diff', {sql_six("AVG(std_pct_diff)")} FROM cmp
    UNION ALL SELECT 'mean_standardized_diff', {sql_six("AVG(std_mean_diff)")} FROM cmp
    UNION ALL SELECT 'corr_frobenius_diff', {sql_six(f"sqrt({_PAIRS})")}"""))
register("l14_worst_features", lambda s, d: six(resample.worst_features(
    resample.compare_moments(*_two_minorities(s, d), _COMPARED), "std_mean_diff", 5)),
    _with(_SIDES, f"SELECT feature, {_rounded(['std_mean_diff'])} FROM cmp ORDER BY cmp.std_mean_diff DESC, feature LIMIT 5"))

# ---- contributions of the scorecard ----


def _scorecard_contributions(spark, d):
    scored = W.scored_customers(spark, d)
    terms = scoring.scorecard_terms()
    row = scored.agg(*[F.avg(c).alias(n) for n, c in terms.items()]).first()  # three means
    return scored, explain.weighted_terms(terms, scoring.SCORECARD, row.asDict())


_CONTRIBUTION = SCORED + """, term AS (SELECT ID, unnest(['N_MONTHS_DELINQUENT', 'PAY_0_LATE', 'UTIL_AVG']) AS feature,
    unnest([0.35 * (N_MONTHS_DELINQUENT - AVG(N_MONTHS_DELINQUENT) OVER ()),
            0.45 * (greatest(PAY_0, 0) - AVG(greatest(PAY_0, 0)) OVER ()),
            0.1 * (UTIL_AVG - AVG(UTIL_AVG) OVER ())]) AS contribution FROM scored)"""
register("x3_global_contributions", lambda s, d: six(explain.mean_absolute(*_scorecard_contributions(s, d))),
         _with(_CONTRIBUTION, f"""SELECT feature, {sql_six("AVG(abs(contribution))")} AS mean_abs_contribution
         FROM term GROUP BY feature"""))
register("x3_sampled_accounts", lambda s, d: explain.sample_accounts(W.customers(s, d).select(ID)),
         _with(SCORED, "SELECT ID FROM pop ORDER BY md5(CAST(ID AS VARCHAR)), ID LIMIT 1000"))
register("x4_local_contributions", lambda s, d: six(explain.strongest_per_account(
    *_scorecard_contributions(s, d), k=2)), _with(_CONTRIBUTION, f"""
    SELECT ID, CAST(r AS INTEGER) AS rank, feature, {sql_six("contribution")} AS contribution FROM (
    SELECT *, row_number() OVER (PARTITION BY ID ORDER BY abs(contribution) DESC, feature) AS r FROM term) WHERE r <= 2"""))

# ---- scoring and prompts ----

register("sc1_score_accounts", lambda s, d: six(scoring.score_accounts(
    W.raw_accounts(s, d), scoring.scorecard_predictor(), W.thresholds(s, d)).select(
    ID, "EDUCATION", "UTIL_AVG", "predicted_pd", "risk_band", "predicted_class")), _with(SCORED, f"""
    SELECT ID, EDUCATION, {sql_six("UTIL_AVG")} AS UTIL_AVG, predicted_pd, risk_band,
           CAST(predicted_pd >= 0.5 AS INTEGER) AS predicted_class FROM banded"""))
register("sc2_scorecard", lambda s, d: scoring.scorecard_predictor()(W.customers(s, d)).select(ID, "predicted_pd"),
         _with(SCORED, "SELECT ID, predicted_pd FROM pop"))
register("sc4_scored_test_table", lambda s, d: W.scored_customers(s, d).select(
    ID, "LIMIT_BAL", "AGE", "actual_default", "predicted_pd", "risk_band"),
    _with(SCORED, "SELECT ID, LIMIT_BAL, AGE, actual_default, predicted_pd, risk_band FROM scored"))


def sc6_prompts(spark, d):
    figures = portfolio.portfolio_size(W.customers(spark, d)).select("total_customers", "total_defaulters")
    return scoring.prompt_rows(read_table(spark, d, "conversations"), as_json(figures, "context"))


register("sc6_prompt_rows", sc6_prompts, _with(FEATURES, r"""
    SELECT conv_id, COUNT(*) AS n_turns, string_agg(role || ': ' || text, chr(10) ORDER BY turn, role, text) AS history,
           (SELECT '{"total_customers":' || COUNT(*) || ',"total_defaulters":' || SUM(default_next_month) || '}' FROM feat) AS context
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS back FROM conversations)
    WHERE back <= 10 GROUP BY conv_id"""))


def io8_results(spark, d):
    """Metric rows written as a JSON bundle and read back."""
    rows = metrics.full_metrics(two_models(spark, d), "p", "y", MODEL_KEY)
    path = write_results(six(rows), scratch_path(spark, "results"))
    return spark.read.schema(rows.schema).json(path).select("model", "roc_auc", "brier_score", "tp")


register("io8_result_bundle", io8_results, _with(MODELS, f"""
    SELECT model, {_rounded(["roc_auc", "brier_score"])}, tp FROM classed JOIN ranks USING (model)"""))


def g10_context(spark, d):
    scored = W.scored_customers(spark, d)
    rows = metrics.full_metrics(scored.withColumn("model", F.lit("scorecard")), "predicted_pd", "actual_default", MODEL_KEY)
    index = drift.stability_index(*_train_test(spark, d), ["predicted_pd"])
    return training.portfolio_context(W.customers(spark, d), scored, rows, index)


register("g10_portfolio_context", g10_context)
