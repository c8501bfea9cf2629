"""Stratified folds decided by the hash of the ID, exact per class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.schema import ID, TARGET

PREFIX = 4  # 16^4 hash cells per class


def _digest() -> Column:
    return F.md5(F.col(ID).cast("string"))


def split_thresholds(df: DataFrame, target: str = TARGET, test_size: float = 0.25) -> DataFrame:
    """Per class: the digest and ID of the last test row, (class, _digest, _id).

    Cells of the digest are counted first; only the cell that holds the cut is
    ranked row by row, which is 1/65536 of a class.
    """
    rows = df.select(F.col(target).alias("_class"), _digest().alias("_digest"),
                     F.col(ID).alias("_id")).withColumn("_cell", F.substring("_digest", 1, PREFIX))
    before = Window.partitionBy("_class").orderBy("_cell").rowsBetween(
        Window.unboundedPreceding, -1)
    cells = rows.groupBy("_class", "_cell").agg(F.count(F.lit(1)).alias("_n")).select(
        "_class", "_cell", "_n",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.floor(F.sum("_n").over(Window.partitionBy("_class")) * F.lit(test_size)).alias("_wanted"))
    cut = cells.filter((F.col("_before") < F.col("_wanted"))
                       & (F.col("_before") + F.col("_n") >= F.col("_wanted")))
    place = Window.partitionBy("_class").orderBy("_digest", "_id")
    # `cut` has one row per class
    return (
        rows.join(F.broadcast(cut), ["_class", "_cell"])
        .withColumn("_place", F.row_number().over(place) + F.col("_before"))
        .filter(F.col("_place") == F.col("_wanted"))
        .select("_class", "_digest", "_id")
    )


def stratified_split(df: DataFrame, target: str = TARGET, test_size: float = 0.25) -> DataFrame:
    """Add `fold`: the first floor(test_size * n) rows of each class in digest
    order are `test`, the others `train`. No row moves between tasks."""
    cut = split_thresholds(df, target, test_size).select(
        F.col("_class").alias(target), F.col("_digest").alias("_cut"), F.col("_id").alias("_cut_id"))
    digest = _digest()
    is_test = (digest < F.col("_cut")) | ((digest == F.col("_cut")) & (F.col(ID) <= F.col("_cut_id")))
    marked = df.join(F.broadcast(cut), target, "left")
    return marked.withColumn(
        "fold", F.when(is_test, "test").otherwise("train")
    ).select(*df.columns, "fold")


def split_summary(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Size and outcome rate of each fold."""
    return df.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.avg(target).alias("default_rate"))


def part_number(seed: int, parts: int) -> Column:
    """Calibration part 0..parts-1 of a row, from its ID alone."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(ID)), F.lit(parts)).cast("int")


def class_weights(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Balanced weight n/(2 n_c) per class and the positive weight n_neg/n_pos."""
    counts = df.groupBy(F.col(target).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy()  # two rows
    positives = F.sum(F.when(F.col("class") == 1, F.col("n"))).over(whole)
    negatives = F.sum(F.when(F.col("class") == 0, F.col("n"))).over(whole)
    return counts.select(
        "class", "n",
        (F.sum("n").over(whole) / (2.0 * F.col("n"))).alias("balanced_weight"),
        F.when(F.col("class") == 1, negatives / positives).otherwise(F.lit(1.0)).alias("positive_weight"),
    )
