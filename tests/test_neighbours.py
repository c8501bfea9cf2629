"""Exact neighbours against brute force, and synthetic rows."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskloom.operators import neighbours, resample
from riskloom.operators.neighbours import nearest_neighbours


def brute_force(x: np.ndarray, k: int) -> dict[int, list[int]]:
    gap = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    np.fill_diagonal(gap, np.inf)
    ids = np.broadcast_to(np.arange(len(x)), gap.shape)
    return {i: list(np.lexsort((ids[i], gap[i]))[:k]) for i in range(len(x))}


@pytest.mark.parametrize("rows_per_block", [2048, 40])
def test_neighbours_equal_brute_force(spark, rows_per_block):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(300, 3))
    x[:90] = x[0]  # a third of the rows are the same point
    x[200:] += 8.0
    rows = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "ID long, x array<double>")
    found = {}
    for r in nearest_neighbours(rows, 5, rows_per_block).orderBy("ID", "rank").collect():
        found.setdefault(r["ID"], []).append(r["neighbour"])
    assert found == brute_force(x, 5)


def grouped(spark, groups: int, each: int, width: int):
    draw = np.random.default_rng(7)
    x = np.repeat(draw.normal(size=(groups, width)) * 6, each, axis=0) + draw.normal(size=(groups * each, width)) * 0.3
    return x, spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "ID long, x array<double>")


def test_far_blocks_are_not_visited(spark):
    x, rows = grouped(spark, 30, 60, 12)
    found = {}
    for r in neighbours.nearest_neighbours(rows, 5, 60).orderBy("ID", "rank").collect():
        found.setdefault(r["ID"], []).append(r["neighbour"])
    assert found == brute_force(x, 5)
    pivots = neighbours.fit_pivots(rows, 60)
    blocks = neighbours.pack_blocks(rows, 5, 60, pivots).cache()
    n = blocks.count()
    share = neighbours.block_pairs(blocks, pivots, neighbours.ball_radii(blocks, pivots, 5)).count() / (n * (n - 1))
    assert n >= 25 and share < 0.2


def test_copies_and_odd_rows(spark):
    x = [[0.0, 1.0]] * 200 + [[5.0, 5.0]] * 3 + [[1e-9, 1.0]]
    rows = [(i, v) for i, v in enumerate(x)] + [(None, [0.0, 1.0]), (999, None)]
    df = spark.createDataFrame(rows, "ID long, x array<double>")
    found = {}
    for r in neighbours.nearest_neighbours(df, 3, 16).orderBy("ID", "rank").collect():
        found.setdefault(r["ID"], []).append(r["neighbour"])
    assert found == brute_force(np.array(x), 3)
    assert neighbours.nearest_neighbours(df.limit(0), 3).count() == 0
    two = neighbours.nearest_neighbours(df.filter("ID in (0, 200)"), 5).collect()
    assert sorted((r["ID"], r["rank"], r["neighbour"]) for r in two) == [(0, 1, 200), (200, 1, 0)]


def encoded(spark, majority: int, minority: int):
    draw = np.random.default_rng(2)
    rows = [(i, 0.0, list(draw.normal(size=4))) for i in range(majority)]
    rows += [(majority + i, 1.0, list(draw.normal(size=4) + 3)) for i in range(minority)]
    rows = [(i, y, list(map(float, x))) for i, y, x in rows]
    return spark.createDataFrame(rows, "ID long, default_next_month double, x array<double>").select(
        "ID", "default_next_month", array_to_vector("x").alias("features"))


def test_smote_balances_and_stays_between_parents(spark):
    table = encoded(spark, 150, 40)
    made = resample.smote(table).toPandas()
    assert len(made) == 110
    uses = made.groupby("parent").size()
    assert uses.max() - uses.min() <= 1 and len(uses) == 40
    points = {r["ID"]: np.array(r["features"]) for r in table.collect()}
    for row in made.itertuples():
        a, b, x = points[row.parent], points[row.neighbour], np.array(row.x)
        assert (x >= np.minimum(a, b) - 1e-12).all() and (x <= np.maximum(a, b) + 1e-12).all()
    again = resample.smote(table).toPandas()
    order = ["parent", "copy"]
    assert made.sort_values(order).x.tolist() == again.sort_values(order).x.tolist()


def test_smote_needs_more_rows_than_neighbours(spark):
    with pytest.raises(ValueError, match="need more than"):
        resample.smote(encoded(spark, 10, 1))


def test_generator_refuses_few_rows(spark):
    rows = spark.range(20).select(F.col("id").alias("ID"), F.array(F.lit(1.0), F.lit(2.0)).alias("x"))
    summary, synthetic = resample.linear_generator(rows, 2, 10)
    assert summary == {"ran": False, "reason": "insufficient minority samples"} and synthetic is None


def test_generator_keeps_mean_and_spread(spark):
    draw = np.random.default_rng(3)
    base = draw.normal(size=(400, 2))
    x = np.column_stack([base[:, 0] * 3 + 5, base[:, 1] * 2 - 1, base.sum(axis=1)])
    rows = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "ID long, x array<double>")
    summary, synthetic = resample.linear_generator(rows, 3, 4000)
    made = np.array([r["x"] for r in synthetic.collect()])
    assert summary["ran"] and summary["recon_mse"] < 1e-6 and len(made) == 4000
    assert np.allclose(made.mean(axis=0), x.mean(axis=0), atol=0.2)
    assert np.allclose(made.std(axis=0), x.std(axis=0), rtol=0.1)


def test_blocks_travel_once_per_pair_of_tiles(spark):
    """What the cogroup gets is a block per tile it meets, not one per block it meets; results as by brute force."""
    draw = np.random.default_rng(3)
    x = draw.normal(size=(640, 6))
    rows = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "ID long, x array<double>")
    found = {}
    for r in neighbours.nearest_neighbours(rows, 5, 10).orderBy("ID", "rank").collect():
        found.setdefault(r["ID"], []).append(r["neighbour"])
    assert found == brute_force(x, 5)
    blocks = neighbours.pack_blocks(rows, 5, 10, neighbours.fit_pivots(rows, 10))
    tiles = neighbours._tiles(blocks)
    assert blocks.count() > 40 and tiles.select("block").distinct().count() == blocks.count()
    assert tiles.select("tile").distinct().count() <= 9


def test_planes_between_pivots_leave_few_rows():
    """Close groups without gaps between the balls: half the difference of two distances left many more rows to look at."""
    draw = np.random.default_rng(11)
    x = np.repeat(draw.normal(size=(300, 12)), 12, axis=0) + draw.normal(size=(3600, 12)) * 0.1
    centres = neighbours.choose_pivots(x, 60)
    pivots = neighbours.Pivots(centres, np.ones(len(centres)), float(np.sqrt((x ** 2).sum(axis=1)).max()))
    away = neighbours.distances(x, centres)
    ball = away.argmin(axis=1)
    reach = np.partition(neighbours.distances(x, x), 6, axis=1)[:, 6]
    planes = sum((neighbours._planes(away[ball == p], p, pivots) <= reach[ball == p, None]).sum() for p in np.unique(ball))
    spheres = ((away - away.min(axis=1)[:, None]) / 2 <= reach[:, None]).sum()
    assert planes < spheres / 2 and planes < 2 * len(x)


def test_planes_never_lie_beyond_a_row():
    draw = np.random.default_rng(12)
    x = np.concatenate([draw.normal(size=(900, 3)), np.repeat(draw.normal(size=(30, 3)), 5, axis=0)])
    centres = np.concatenate([neighbours.choose_pivots(x, 20), x[:1], x[:1] + 1e-9])
    away = neighbours.distances(x, centres)
    ball = away.argmin(axis=1)
    pivots = neighbours.Pivots(centres, np.ones(len(centres)), float(np.sqrt((x ** 2).sum(axis=1)).max()))
    gap = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    for home in np.unique(ball):
        least = neighbours._planes(away[ball == home], home, pivots)
        assert (least[:, home] <= 0).all()
        for other in np.unique(ball):
            assert (least[:, other] <= gap[ball == home][:, ball == other].min(axis=1) + 1e-12).all()


@pytest.mark.parametrize("scale, offset", [(1.0, 0.0), (1.0, 3e5), (1e-3, 1.0), (1e-20, 0.0), (1e30, 0.0), (1e-9, 1e4)])
def test_products_in_single_precision_lose_no_neighbour(scale, offset):
    """Against distances of all pairs: values of any size, far from zero, in steps that tie, and copies."""
    draw = np.random.default_rng(13)
    x = np.round(draw.normal(size=(700, 6)), 1)
    x[600:] = x[:100]
    x = x * scale + offset
    ids = draw.permutation(len(x)).astype(np.int64)
    targets = neighbours.Targets.of(ids, x)
    gap = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    near, ID, distance = neighbours.closest(x, targets, 5)
    order = np.array([np.lexsort((ids, g))[:5] for g in gap])
    assert (ID.reshape(-1, 5) == ids[order]).all() and (distance.reshape(-1, 5) == np.take_along_axis(gap, order, 1)).all()
    reach = np.quantile(gap, 0.02, axis=1)
    within = neighbours.closest(x, targets, 5, reach)
    for i in range(len(x)):
        best = np.lexsort((ids, gap[i]))[:5]
        assert set(ids[best[gap[i][best] <= reach[i]]]) <= set(within[1][within[0] == i])
    np.fill_diagonal(gap, np.inf)
    alone = neighbours.closest(x, targets, 5, same=True)[1].reshape(-1, 5)
    assert (alone == ids[np.array([np.lexsort((ids, g))[:5] for g in gap])]).all()


def test_few_pairs_leave_a_product():
    """Far from the reach nothing is looked at twice, and many copies do not crowd out the nearest by ID."""
    draw = np.random.default_rng(14)
    x, y = draw.normal(size=(200, 8)), draw.normal(size=(900, 8)) + 30
    assert len(neighbours._candidates(x, neighbours.Targets.of(np.arange(900), y), 5, np.full(200, 2.0), None)[0]) == 0
    y = np.repeat(x[:1], 900, axis=0)
    row, ID, distance = neighbours.closest(x[:3], neighbours.Targets.of(np.arange(900)[::-1].copy(), y), 5)
    assert ID.reshape(3, 5).tolist() == [[0, 1, 2, 3, 4]] * 3 and (distance[:5] == 0).all()
