"""Rank metrics, quantiles, stability and tests of association against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.functions.tails import chi_square_tail, student_two_sided
from riskloom.operators import association, drift, metrics
from riskloom.operators.ranking import exact_quantiles, running_totals


def scores(spark, p, y):
    return spark.createDataFrame([("m", float(a), int(b)) for a, b in zip(p, y)], "model string, p double, y int")


def auc_by_pairs(p, y):
    pos, neg = p[y == 1], p[y == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def precision_steps(p, y):
    total, reached, before = 0.0, y.sum(), 0.0
    for cut in sorted(set(p), reverse=True):
        chosen = p >= cut
        recall = y[chosen].sum() / reached
        total += (recall - before) * y[chosen].mean()
        before = recall
    return total


@pytest.fixture(scope="module")
def sample():
    draw = np.random.default_rng(5)
    y = draw.integers(0, 2, 700)
    p = np.round(np.clip(draw.normal(0.4 + 0.2 * y, 0.2), 0, 1), 2)  # many ties
    p[:250] = 0.37  # a third of the rows share one score
    return p, y


def test_rank_metrics_equal_brute_force(spark, sample):
    p, y = sample
    row = metrics.full_metrics(scores(spark, p, y), "p", "y", ["model"]).first()
    assert row["roc_auc"] == pytest.approx(auc_by_pairs(p, y), abs=1e-12)
    assert row["pr_auc"] == pytest.approx(precision_steps(p, y), abs=1e-12)
    gaps = [abs((p[y == 1] >= c).mean() - (p[y == 0] >= c).mean()) for c in set(p)]
    assert row["ks"] == pytest.approx(max(gaps), abs=1e-12)
    assert row["brier_score"] == pytest.approx(((p - y) ** 2).mean(), abs=1e-12)
    assert (row["tp"], row["fp"]) == (((p >= 0.5) & (y == 1)).sum(), ((p >= 0.5) & (y == 0)).sum())


def test_auc_of_reversed_score_is_its_complement(spark, sample):
    p, y = sample
    there = metrics.rank_metrics(scores(spark, p, y), "p", "y", ["model"]).first()["roc_auc"]
    back = metrics.rank_metrics(scores(spark, 1 - p, y), "p", "y", ["model"]).first()["roc_auc"]
    assert there + back == pytest.approx(1.0)


def test_one_class_only_gives_null_and_zero(spark):
    row = metrics.full_metrics(scores(spark, np.array([0.1, 0.2]), np.array([0, 0])), "p", "y", ["model"]).first()
    assert row["roc_auc"] is None and row["precision"] == 0.0 and row["recall"] == 0.0


def test_published_confusion_cells_give_published_rates(spark):
    cells = [(1.0, 1)] * 1069 + [(1.0, 0)] * (2314 - 1069) + [(0.0, 1)] * (1659 - 1069) + [(0.0, 0)] * 4596
    row = metrics.class_metrics(scores(spark, *zip(*cells)), "p", "y", ["model"]).first()
    assert (round(row["precision"], 5), round(row["recall"], 5), round(row["f1"], 5)) == (0.46197, 0.64436, 0.53813)


def test_strict_threshold_excludes_one_half(spark):
    df = scores(spark, [0.5, 0.5, 0.6], [1, 0, 1])
    assert metrics.class_metrics(df, "p", "y", ["model"]).first()["tp"] == 2
    assert metrics.class_metrics(df, "p", "y", ["model"], strict=True).first()["tp"] == 1


def test_running_totals_over_several_ranges(spark):
    counts = spark.range(1000).select(
        (F.col("id") % 3).alias("k"), F.col("id").alias("v"), F.lit(1).alias("n")).repartition(7)
    rows = running_totals(counts, "v", ["n"], ["k"], descending=True).collect()
    for r in rows:
        assert r["cum_n"] == sum(1 for i in range(r["v"], 1000) if i % 3 == r["k"])
        assert r["total_n"] == sum(1 for i in range(1000) if i % 3 == r["k"])


@pytest.mark.parametrize("accuracy", [10000, 50])
def test_quantiles_equal_numpy(spark, accuracy):
    draw = np.random.default_rng(7)
    data = {"a": draw.normal(size=601), "b": np.r_[np.zeros(300), draw.exponential(size=301)], "c": np.full(601, 3.0)}
    rows = [(float(a), float(b), float(c) if i % 4 else None) for i, (a, b, c) in enumerate(zip(*data.values()))]
    data["c"] = data["c"][[i % 4 != 0 for i in range(601)]]
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.8, 0.95, 1.0]
    found = exact_quantiles(spark.createDataFrame(rows, "a double, b double, c double"), list(data), probabilities, accuracy)
    for r in found.collect():
        assert r["value"] == pytest.approx(np.quantile(data[r["feature"]], r["prob"]), abs=1e-12), r


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 30_000])
def test_quantiles_are_exact_at_any_size(spark, rows):
    values = np.random.default_rng(rows).lognormal(size=rows)
    probabilities = [0.0, 0.1, 0.5, 0.9, 1.0]
    found = exact_quantiles(spark.createDataFrame([(float(v),) for v in values], "v double"), ["v"], probabilities).collect()
    assert {r["prob"]: r["value"] for r in found} == pytest.approx(dict(zip(probabilities, np.quantile(values, probabilities))))


def psi_by_numpy(expected, actual):
    points = np.quantile(expected, np.linspace(0, 1, 11))
    points[0], points[-1] = -np.inf, np.inf
    points = np.unique(points)
    e = np.histogram(expected, points)[0] / len(expected)
    a = np.histogram(actual, points)[0] / len(actual)
    e, a = np.where(e == 0, 1e-6, e), np.where(a == 0, 1e-6, a)
    return float(((a - e) * np.log(a / e)).sum())


def test_stability_index_equals_numpy(spark):
    draw = np.random.default_rng(9)
    cases = {
        "shifted": (draw.normal(size=500), draw.normal(0.5, 1, 400)), "same": (np.arange(500.0), np.arange(500.0)),
        "ties": (draw.integers(0, 4, 500).astype(float), draw.integers(0, 6, 400).astype(float)),
        "constant": (np.full(500, 2.0), np.r_[np.full(300, 2.0), np.full(100, 1.0)]),
        "empty_bin": (np.arange(500.0), np.full(400, 450.0)),
    }
    names = list(cases)

    def table(side, size):
        rows = zip(*[np.resize(cases[n][side], size) for n in names])
        return spark.createDataFrame([tuple(map(float, r)) for r in rows], ", ".join(f"{n} double" for n in names))

    cases["same"] = (cases["same"][0], np.resize(cases["same"][1], 400))
    for r in drift.stability_index(table(0, 500), table(1, 400), names).collect():
        assert r["psi"] == pytest.approx(psi_by_numpy(*cases[r["feature"]]), abs=1e-9), r


def test_stability_of_a_table_with_itself_is_zero(spark):
    df = spark.createDataFrame([(float(i % 37),) for i in range(300)] + [(None,)], "x double")
    assert drift.stability_index(df, df, ["x"]).first()["psi"] == pytest.approx(0.0, abs=1e-12)


def test_flags_change_at_their_limits(spark):
    df = spark.createDataFrame([(0.0999,), (0.10,), (0.2499,), (0.25,)], "psi double")
    flags = [r[0] for r in df.select(drift.drift_flag(F.col("psi"))).collect()]
    assert [f.split("_")[0] for f in flags] == ["stable", "moderate", "moderate", "major"]


def test_two_by_two_is_continuity_corrected(spark):
    cells = {(1, 0): 10, (1, 1): 20, (2, 0): 15, (2, 1): 5}
    rows = [(a, b) for (a, b), n in cells.items() for _ in range(n)]
    row = association.chi_square(spark.createDataFrame(rows, "SEX int, default_next_month int"), ["SEX"]).first()
    expected = {(1, 0): 15, (1, 1): 15, (2, 0): 10, (2, 1): 10}
    statistic = sum((abs(cells[c] - e) - 0.5) ** 2 / e for c, e in expected.items())
    assert row["dof"] == 1 and row["chi2"] == pytest.approx(statistic)
    assert row["cramers_v"] == pytest.approx(math.sqrt(statistic / 50))


def test_t_and_effect_size_have_opposite_signs(spark):
    rows = [(0, float(v)) for v in [1, 2, 3, 4]] + [(1, float(v)) for v in [5, 6, 8]] + [(1, None)]
    row = association.group_means(spark.createDataFrame(rows, "default_next_month int, x double"), ["x"]).first()
    a, b = np.array([1.0, 2, 3, 4]), np.array([5.0, 6, 8])
    assert row["t_stat"] == pytest.approx((a.mean() - b.mean()) / math.sqrt(a.var(ddof=1) / 4 + b.var(ddof=1) / 3))
    assert row["cohens_d"] == pytest.approx((b.mean() - a.mean()) / math.sqrt((a.var(ddof=1) + b.var(ddof=1)) / 2))


def test_tail_probabilities(spark):
    chi = [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (0.0, 3, 1.0), (18.307038053275146, 10, 0.05), (1.0, 2, math.exp(-0.5)), (700.0, 2, math.exp(-350))]
    rows = spark.createDataFrame([(float(x), d, float(p)) for x, d, p in chi], "x double, d int, p double")
    for r in rows.select("p", chi_square_tail(F.col("x"), F.col("d")).alias("found")).collect():
        assert r["found"] == pytest.approx(r["p"], abs=1e-12, rel=1e-9)
    student = []
    for t in (0.3, -1.0, 2.5, 9.0):  # closed forms for one, two and four degrees of freedom
        u = abs(t) / math.sqrt(t * t + 4)
        student += [(t, 1.0, 1 - 2 * math.atan(abs(t)) / math.pi), (t, 2.0, 1 - abs(t) / math.sqrt(t * t + 2)), (t, 4.0, 1 - u * (1.5 - 0.5 * u * u))]
    student += [(0.0, 7.0, 1.0), (1.959963984540054, 1e7, 0.05)]
    rows = spark.createDataFrame(student, "t double, d double, p double")
    for r in rows.select("p", student_two_sided(F.col("t"), F.col("d")).alias("found")).collect():
        assert r["found"] == pytest.approx(r["p"], abs=1e-7 if r["p"] == 0.05 else 1e-12)
    nothing = rows.limit(1).select(chi_square_tail(F.lit(1.0), F.lit(0)).alias("a"), student_two_sided(F.lit(1.0), F.lit(None).cast("double")).alias("b"))
    assert nothing.first().asDict() == {"a": None, "b": None}


def test_triggers_need_two_periods_in_a_row(spark):
    rows = []
    for period, rate in [(1, 0.9), (2, 0.9), (3, 0.5), (4, 0.9)]:
        rows += [("Low Risk", period, 0.5, 1 if i < rate * 10 else 0) for i in range(10)]
    df = spark.createDataFrame(rows, "risk_band string, period int, predicted_pd double, actual_default int")
    found = {r["period"]: (r["diverged"], r["twice"]) for r in drift.band_divergence(df, "period").collect()}
    assert found == {1: (1, 0), 2: (1, 1), 3: (0, 0), 4: (1, 0)}
