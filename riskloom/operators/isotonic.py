"""Isotonic regression of an outcome on a score: pool-adjacent-violators over ranges of scores.

Rows are counted per distinct score (ties collapse before the shuffle), and every range of
scores pools its own points. Pooling in any order gives the same blocks, so neighbouring ranges
then go together, two at a time, as long as the last block of one is not below the first of the
next. A task holds the blocks of two ranges and nothing is rounded; rates are compared as
fractions of whole numbers. Rounds are as many as a block has ranges to cross, halving.

Defined cases: rows with a null or NaN score, a null outcome or a null key are left out; without
rows there are no blocks; equal rates of neighbours are one block.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import cut_lineage


def pooled(df: DataFrame, score: str, outcome: str, keys: list[str] | None = None, ranges: int | None = None) -> DataFrame:
    """Blocks per key: `low` and `high` score, rows `n` and their `hits`; hits / n rises strictly.

    `outcome` holds whole numbers. `ranges` sets how many ranges there are; Spark chooses if it is not given.
    """
    keys = keys or []
    value = F.col(score).cast("double")
    usable = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys], value.isNotNull() & ~F.isnan(value) & F.col(outcome).isNotNull())
    points = (df.where(usable).groupBy(*keys, value.alias("low"))
              .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(outcome).cast("long")).alias("hits")))
    order = [F.col(c) for c in [*keys, "low"]]
    ranged = points.repartitionByRange(ranges, *order) if ranges else points.repartitionByRange(*order)
    ranged = cut_lineage(ranged.select(*keys, F.spark_partition_id().alias("_range"), "low", F.col("low").alias("high"), "n", "hits"))
    blocks = cut_lineage(_pool(ranged, keys))
    while True:
        pairs = _pairs(blocks, keys)
        if pairs is None:
            return blocks.drop("_range")
        together = blocks.join(pairs, [*keys, "_range"]).select(*keys, F.col("_pair").alias("_range"), "low", "high", "n", "hits")
        blocks = cut_lineage(_pool(together, keys))


def _pool(blocks: DataFrame, keys: list[str]) -> DataFrame:
    names = blocks.columns

    def pool(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("low")
        stack: list[tuple] = []
        for low, high, n, hits in zip(*(rows[c].tolist() for c in ("low", "high", "n", "hits"))):
            while stack and stack[-1][3] * n >= hits * stack[-1][2]:
                low, _, more, hit = stack.pop()
                n, hits = n + more, hits + hit
            stack.append((low, high, n, hits))
        out = pd.DataFrame(stack, columns=["low", "high", "n", "hits"])
        for c in [*keys, "_range"]:
            out[c] = rows[c].iloc[0]
        return out[names]

    return blocks.groupBy(*keys, "_range").applyInPandas(pool, blocks.schema)


def _pairs(blocks: DataFrame, keys: list[str]) -> DataFrame | None:
    """Which ranges go together next, a row per key and range; None where all neighbours rise."""
    block = F.struct(F.col("hits").cast("decimal(19,0)").alias("hits"), F.col("n").cast("decimal(19,0)").alias("n"))
    ends = blocks.groupBy(*keys, "_range").agg(F.min_by(block, "low").alias("first"), F.max_by(block, "low").alias("last"))
    along = Window.partitionBy(*keys).orderBy("_range")  # a row per range
    after = F.lead("first").over(along)
    falls = F.col("last.hits") * after["n"] >= after["hits"] * F.col("last.n")
    placed = ends.select(*keys, "_range", (F.row_number().over(along) - 1).alias("_at"), F.coalesce(falls, F.lit(False)).alias("_falls"))
    odd = placed.where("_falls").agg(F.min(F.col("_at"))).first()[0]
    if odd is None:
        return None
    return placed.select(*keys, "_range", F.floor((F.col("_at") + F.lit(odd % 2)) / 2).cast("int").alias("_pair"))
