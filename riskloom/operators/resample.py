"""Synthetic minority rows and checks of how real they look."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.directions import along, correlation_of, main_directions
from riskloom.functions.numbers import uniform
from riskloom.functions.rowwise import number
from riskloom.operators.neighbours import nearest_neighbours
from riskloom.operators.split import split_thresholds
from riskloom.schema import ID, TARGET

SEED = 42
NEIGHBOURS = 5
MIN_ROWS = 50


def class_sizes(df: DataFrame) -> tuple[int, int]:
    """(majority, minority) rows; the minority is class 1."""
    counts = {int(r[0]): r[1] for r in df.groupBy(TARGET).count().collect()}
    return counts.get(0, 0), counts.get(1, 0)


def _quota(minority: DataFrame, wanted: int, rows: int) -> DataFrame:
    """How many synthetic rows start from each minority row: the same number for
    all, plus one for the first `wanted mod rows` in digest order."""
    each, extra = divmod(wanted, rows)
    if extra == 0:
        return minority.withColumn("_copies", F.lit(each))
    cut = split_thresholds(minority, TARGET, (extra + 0.5) / rows).select(
        F.col("_class").alias(TARGET), F.col("_digest").alias("_cut"), F.col("_id").alias("_cut_id"))
    digest = F.md5(F.col(ID).cast("string"))
    first = (digest < F.col("_cut")) | ((digest == F.col("_cut")) & (F.col(ID) <= F.col("_cut_id")))
    return minority.join(F.broadcast(cut), TARGET).withColumn(  # one class, one row
        "_copies", F.lit(each) + first.cast("int")).drop("_cut", "_cut_id")


def smote(encoded: DataFrame, k: int = NEIGHBOURS, seed: int = SEED) -> DataFrame:
    """Synthetic minority rows that balance the classes: (parent, neighbour, copy, x).

    Each lies on the line between a minority row and one of its k nearest
    minority rows, at a place drawn from the hash of the row and the copy.
    """
    majority, rows = class_sizes(encoded)
    if rows <= k:
        raise ValueError(f"{rows} minority rows, need more than {k}")
    minority = encoded.filter(F.col(TARGET) == 1).select(
        ID, TARGET, vector_to_array("features").alias("x"))
    nearest = nearest_neighbours(minority.select(ID, "x"), k)
    copies = _quota(minority, max(majority - rows, 0), rows).filter(F.col("_copies") > 0).select(
        F.col(ID).alias("parent"), F.col("x").alias("_from"),
        F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("copy"))
    drawn = copies.withColumn(
        "rank", (F.floor(uniform(seed, F.col("parent"), F.col("copy")) * k) + 1).cast("int"))
    chosen = drawn.join(nearest.select(F.col(ID).alias("parent"), "rank", "neighbour"), ["parent", "rank"])
    ends = minority.select(F.col(ID).alias("neighbour"), F.col("x").alias("_to"))
    place = uniform(seed + 1, F.col("parent"), F.col("copy"))
    return chosen.join(ends, "neighbour").withColumn("_step", place).select(
        "parent", "neighbour", "copy",
        F.zip_with("_from", "_to", lambda a, b: a + F.col("_step") * (b - a)).alias("x"))


def stack_synthetic(encoded: DataFrame, synthetic: DataFrame) -> DataFrame:
    """Real rows and synthetic class-1 rows as one training table."""
    made = synthetic.select(
        F.lit(None).cast("long").alias(ID), F.lit(1.0).alias(TARGET),
        array_to_vector("x").alias("features"))
    return encoded.select(F.col(ID), TARGET, "features").unionByName(made)


def _moments(df: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and population deviation per position of the vector `v`."""
    row = df.select(Summarizer.metrics("mean", "variance", "count").summary(F.col("v")).alias("m")).select(
        "m.mean", "m.variance", "m.count").first()
    share = (row["count"] - 1) / row["count"]  # the summary divides by n - 1
    return np.array(row["mean"]), np.sqrt(np.array(row["variance"]) * share)


def _latent(j: int, mean: float, deviation: float, seed: int) -> str:
    """Normal draw from two hashed uniforms of the row number."""
    def uniform_text(salt: int) -> str:
        return f"((pmod(xxhash64({salt}, id), {1 << 40}L) + 0.5D) / {float(1 << 40)!r}D)"

    normal = f"sqrt(-2D * ln({uniform_text(seed + j)})) * cos({2 * math.pi!r}D * {uniform_text(seed + 7919 + j)})"
    return f"{normal} * {number(deviation)} + {number(mean)} AS z{j}"


def linear_generator(minority: DataFrame, width: int, wanted: int, seed: int = SEED):
    """(summary, synthetic rows) from a linear-Gaussian latent model of class 1.

    Standardize, keep the first components, draw independent normals with their
    spread, and project back. `minority` has (ID, x). Only moments and the
    component matrix (width x width at most) reach the driver.
    """
    spark = minority.sparkSession
    vectors = minority.select(array_to_vector("x").alias("v"))
    rows = vectors.count()
    if rows < MIN_ROWS:
        return {"ran": False, "reason": "insufficient minority samples"}, None
    centre, spread = _moments(vectors, width)
    spread = spread + 1e-8
    scaled = minority.selectExpr("array(" + ", ".join(
        f"(x[{i}] - {number(c)}) / {number(d)}" for i, (c, d) in enumerate(zip(centre, spread))) + ") AS v")
    latent = min(8, max(2, width // 3))
    basis = main_directions(scaled, "v", latent)
    projected = scaled.selectExpr("v", *[f"{along('v', basis[:, j])} AS z{j}" for j in range(latent)])
    figures = projected.agg(
        F.expr("sum(aggregate(v, 0D, (a, t) -> a + t * t)) AS total"),
        *[F.expr(f"sum(z{j} * z{j}) AS kept{j}") for j in range(latent)],
        *[F.expr(f"avg(z{j}) AS mean{j}") for j in range(latent)],
        *[F.expr(f"stddev_pop(z{j}) AS std{j}") for j in range(latent)]).first()
    lost = max(figures["total"] - sum(figures[f"kept{j}"] for j in range(latent)), 0.0) / (rows * width)
    draws = [_latent(j, figures[f"mean{j}"], figures[f"std{j}"] + 1e-8, seed) for j in range(latent)]
    back = [
        "(" + " + ".join(f"z{j} * {number(w)}" for j, w in enumerate(basis[i]))
        + f") * {number(spread[i])} + {number(centre[i])}"
        for i in range(width)
    ]
    synthetic = spark.range(wanted).selectExpr(
        "id", *draws).selectExpr("id", f"array({', '.join(back)}) AS x")
    summary = {"ran": True, "recon_mse": float(lost), "latent_dim": latent,
               "n_synthetic": wanted, "n_real_minority": rows}
    return summary, synthetic


def make_valid(columns: list[Column], blocks: list[list[int]], flags: list[int]) -> list[Column]:
    """Turn raw generated values into valid encoded ones: the largest value of a
    one-hot block becomes 1 and the rest 0, flags are rounded into {0, 1}."""
    valid = list(columns)
    for block in blocks:
        values = F.array(*[columns[i] for i in block])
        winner = F.array_position(values, F.array_max(values))
        for place, i in enumerate(block, start=1):
            valid[i] = (winner == place).cast("double")
    for i in flags:
        valid[i] = F.greatest(F.least(F.rint(columns[i]), F.lit(1.0)), F.lit(0.0))
    return valid


def make_array_valid(df: DataFrame, width: int, blocks: list[list[int]], flags: list[int]) -> DataFrame:
    columns = make_valid([F.col("x")[i] for i in range(width)], blocks, flags)
    return df.withColumn("x", F.array(*columns))


def feature_moments(df: DataFrame, features: list[str], prefix: str) -> DataFrame:
    """(feature, <prefix>_mean, <prefix>_std) with the population deviation."""
    wide = df.agg(*[F.expr(f"""named_struct('feature', '{f}', '{prefix}_mean', avg(CAST(`{f}` AS DOUBLE)),
                               '{prefix}_std', stddev_pop(CAST(`{f}` AS DOUBLE))) AS `{f}`""")
                    for f in features])
    return wide.selectExpr("inline(array(" + ", ".join(f"`{f}`" for f in features) + "))")


def compare_moments(real: DataFrame, synthetic: DataFrame, features: list[str]) -> DataFrame:
    """Relative and standardized differences per feature."""
    both = feature_moments(real, features, "real").join(
        feature_moments(synthetic, features, "synth"), "feature")
    shift = F.abs(F.col("synth_mean") - F.col("real_mean"))
    widening = F.abs(F.col("synth_std") - F.col("real_std"))
    return both.select(
        "feature", (shift / (F.abs("real_mean") + 1e-6)).alias("mean_pct_diff"),
        (widening / (F.abs("real_std") + 1e-6)).alias("std_pct_diff"),
        (shift / (F.col("real_std") + 1e-8)).alias("std_mean_diff"))


def correlation_matrix(df: DataFrame, features: list[str]) -> np.ndarray:
    """Pearson matrix (features x features); an undefined entry is 0."""
    assembled = VectorAssembler(inputCols=features, outputCol="_v").transform(
        df.selectExpr(*[f"coalesce(CAST(`{f}` AS DOUBLE), 0D) AS `{f}`" for f in features]))
    return correlation_of(assembled, "_v")


def distribution_diagnostics(real: DataFrame, synthetic: DataFrame, features: list[str]) -> DataFrame:
    """Summary of how far the synthetic rows are from the real ones, as (metric, value)."""
    moments = compare_moments(real, synthetic, features).agg(
        F.avg("mean_pct_diff").alias("mean_abs_pct_diff"),
        F.avg("std_pct_diff").alias("std_abs_pct_diff"),
        F.avg("std_mean_diff").alias("mean_standardized_diff"))
    distance = float(np.linalg.norm(
        correlation_matrix(real, features) - correlation_matrix(synthetic, features)))
    wide = moments.withColumn("corr_frobenius_diff", F.lit(distance))
    return wide.unpivot([], wide.columns, "metric", "value")


def worst_features(comparison: DataFrame, by: str, k: int) -> DataFrame:
    return comparison.orderBy(F.desc(by), "feature").limit(k).select("feature", by)
