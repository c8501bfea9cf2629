"""Pooling over ranges against the max-min formula on all spans of scores."""

import numpy as np
import pytest

from riskloom.operators import isotonic


def plain(points):
    """(score, n, hits) sorted by score -> fitted value of each, by the largest of the smallest means."""
    n, hits = np.array([[p[1], p[2]] for p in points], float).T
    cn, ch = np.r_[0, np.cumsum(n)], np.r_[0, np.cumsum(hits)]
    k = len(points)
    mean = np.full((k, k), np.inf)
    for a in range(k):
        mean[a, a:] = (ch[a + 1:] - ch[a]) / (cn[a + 1:] - cn[a])
    least = np.minimum.accumulate(mean[:, ::-1], axis=1)[:, ::-1]
    return [least[: i + 1, i].max() for i in range(k)]


@pytest.mark.parametrize("shape", ["rising", "falling", "noise", "hot"])
def test_blocks_equal_a_plain_fit(spark, shape):
    rng = np.random.default_rng(5)
    score = np.round(rng.random(2500), 3) if shape == "noise" else rng.random(2500)
    if shape == "hot":
        score[:900] = 0.5
    chance = {"rising": score, "falling": 1 - score, "noise": 0.3 + 0 * score, "hot": score**2}[shape]
    hit = (rng.random(2500) < chance).astype(int)
    rows = [("a", float(s), int(h)) for s, h in zip(score, hit)] + [("b", 0.1, 1), ("b", 0.2, 0), ("b", 0.2, 1)]
    odd = [("a", None, 1), ("a", float("nan"), 1), ("a", 0.4, None), (None, 0.4, 1)]
    df = spark.createDataFrame(rows + odd, "model string, s double, y int")
    found = isotonic.pooled(df, "s", "y", ["model"], ranges=16).toPandas().sort_values(["model", "low"])
    points = [(s, (score == s).sum(), hit[score == s].sum()) for s in np.unique(score)]
    own = found[found.model == "a"]
    rate = (own.hits / own.n).to_numpy()
    at = np.searchsorted(own.low.to_numpy(), [p[0] for p in points], side="right") - 1
    assert np.allclose(rate[at], plain(points), atol=1e-12) and (np.diff(rate) > 0).all()
    assert own.n.sum() == 2500 and own.hits.sum() == hit.sum() and (own.high >= [p[0] for p in points if p[0] in set(own.low)]).all()
    assert found[found.model == "b"][["low", "high", "n", "hits"]].values.tolist() == [[0.1, 0.2, 3, 2]]


def test_no_rows_no_blocks(spark):
    assert isotonic.pooled(spark.createDataFrame([], "s double, y int"), "s", "y").count() == 0
