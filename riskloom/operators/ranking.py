"""Cumulative totals and exact quantiles over data of any size.

A window ordered over a whole table runs in one task. Here distinct values are
counted first (ties collapse before the shuffle), range-partitioned on the value,
and every range adds the total of the ranges before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.numbers import to_long
from riskloom.session import cut_lineage


def running_totals(counts: DataFrame, value: str, measures: list[str],
                   keys: list[str], descending: bool = False) -> DataFrame:
    """Add `cum_<m>` (up to and including the value) and `total_<m>` per key.

    `counts` holds one row per (keys, value). Its ranges are cut by sampling, so
    they are written once and both branches below read the same cut. The offsets
    have one row per (key, range); how to join them is left to their size at run
    time, and the join's partitioning is the one the window needs.
    """
    by_value = F.col(value).desc() if descending else F.col(value).asc()
    ranged = counts.repartitionByRange(*[F.col(k) for k in keys], by_value)
    ranged = cut_lineage(ranged.withColumn("_range", F.spark_partition_id()))

    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = ranged.groupBy(*keys, "_range").agg(
        *[F.sum(m).cast("double").alias(m) for m in measures]
    ).select(
        *keys, "_range",
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0.0)).alias(f"_before_{m}") for m in measures],
        *[F.sum(m).over(whole).alias(f"total_{m}") for m in measures],
    )
    inside = Window.partitionBy(*keys, "_range").orderBy(by_value).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return ranged.join(offsets, [*keys, "_range"]).select(
        *keys, value, *measures,
        *[(F.col(f"_before_{m}") + F.sum(m).over(inside)).alias(f"cum_{m}") for m in measures],
        *[f"total_{m}" for m in measures],
    )


def _brackets(df: DataFrame, columns: list[str], probabilities: list[float],
              accuracy: int) -> DataFrame:
    """Per column and probability, two values that enclose the exact quantile.

    The sketch errs by at most 1/accuracy in rank; the margin is four times that, and
    the rest is for the two ranks between which a quantile is interpolated. Where a column
    has so few values that two ranks are more than the rest, its least and greatest value
    enclose everything. Count, ends and sketch come from one pass.
    """
    margin = 10.0 / accuracy
    probes = ", ".join([f"{max(p - margin, 0.0)!r}D" for p in probabilities]
                       + [f"{min(p + margin, 1.0)!r}D" for p in probabilities])
    one_row = df.agg(*[
        F.expr(f"""named_struct('feature', '{c}', '_few', count(`{c}`) < {accuracy // 3},
                   '_least', min(CAST(`{c}` AS DOUBLE)), '_most', max(CAST(`{c}` AS DOUBLE)),
                   '_at', percentile_approx(CAST(`{c}` AS DOUBLE), array({probes}), {accuracy})) AS `{c}`""")
        for c in columns
    ])
    listed = ", ".join(f"`{c}`" for c in columns)
    n = len(probabilities)
    return one_row.selectExpr(f"inline(array({listed}))").selectExpr(
        "feature",
        *[f"CASE WHEN _few THEN _least ELSE _at[{i}] END AS _lo{i}" for i in range(n)],
        *[f"CASE WHEN _few THEN _most ELSE _at[{n + i}] END AS _hi{i}" for i in range(n)])


def _folded(values: DataFrame, n: int) -> DataFrame:
    """Values inside any bracket with their counts, and each stretch between brackets as a
    single row, so only a small part of the data is shuffled. `_part` numbers the stretches
    of values between two bracket ends in ascending order."""
    inside = " OR ".join(f"(value >= _lo{i} AND value <= _hi{i})" for i in range(n))
    part = " + ".join(f"CAST(value >= _lo{i} AS INT) + CAST(value > _hi{i} AS INT)" for i in range(n))
    tagged = values.selectExpr("feature", "value", f"{part} AS _part", f"CASE WHEN {inside} THEN value END AS _exact")
    return tagged.groupBy("feature", "_part", "_exact").agg(
        F.min("value").alias("value"), F.count(F.lit(1)).alias("n"))


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float],
                    accuracy: int = 10000) -> DataFrame:
    """Exact quantiles, linearly interpolated, NULLs left out: (feature, prob, value).

    Reads the input twice: for a sketch that encloses each quantile, and to count exactly.
    The brackets also cut the values into ranges whose totals are added up, so the ranks
    inside one bracket are all that a task sees. Give it a stored table rather than a long
    computation.
    """
    n = len(probabilities)
    brackets = _brackets(df, columns, probabilities, accuracy)
    # one row per column of the table
    values = to_long(df, columns).filter(F.col("value").isNotNull()).join(
        F.broadcast(brackets), "feature")
    folded = cut_lineage(_folded(values, n))  # both branches below read it
    # at most two parts per probability and one more
    earlier = Window.partitionBy("feature").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = folded.groupBy("feature", "_part").agg(F.sum("n").alias("_size")).select(
        "feature", "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_size").over(Window.partitionBy("feature")).cast("double").alias("total_n"))
    inside = Window.partitionBy("feature", "_part").orderBy("value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = folded.withColumn("cum_n", F.sum("n").over(inside)).join(offsets, ["feature", "_part"]).withColumn(
        "cum_n", F.col("cum_n") + F.col("_before"))

    # a row holds the ranks cum_n - n .. cum_n - 1; each wanted rank lies in one row
    exact = ("CASE WHEN _exact IS NOT NULL THEN value "
             "ELSE CAST(raise_error('quantile outside its bracket') AS DOUBLE) END")
    wanted = []
    for i, p in enumerate(probabilities):
        rank = f"((total_n - 1D) * {p!r}D)"
        for end in ("floor", "ceil"):
            holds = f"{end}({rank}) BETWEEN cum_n - n AND cum_n - 1"
            wanted.append(f"max(CASE WHEN {holds} THEN {exact} END) AS _{end}{i}")
        wanted.append(f"max({rank} - floor({rank})) AS _part{i}")
    wide = ranked.groupBy("feature").agg(*[F.expr(w) for w in wanted])
    rows = ", ".join(
        f"named_struct('prob', {p!r}D, 'value', _floor{i} + (_ceil{i} - _floor{i}) * _part{i})"
        for i, p in enumerate(probabilities))
    return wide.selectExpr("feature", f"inline(array({rows}))")


def score_counts(df: DataFrame, keys: list[str], score: str, outcome: str) -> DataFrame:
    """Positives and negatives per distinct score: all that rank metrics need."""
    return df.filter(F.col(score).isNotNull()).groupBy(
        *keys, F.col(score).cast("double").alias("score")
    ).agg(
        F.sum((F.col(outcome) == 1).cast("long")).alias("pos"),
        F.sum((F.col(outcome) == 0).cast("long")).alias("neg"),
    )


def ranked_scores(df: DataFrame, keys: list[str], score: str, outcome: str) -> DataFrame:
    """Score counts with running totals from the highest score down."""
    counts = score_counts(df, keys, score, outcome)
    return running_totals(counts, "score", ["pos", "neg"], keys, descending=True)


def edge_columns(quantiles: DataFrame, probabilities: list[float]) -> DataFrame:
    """One row per feature with its cut points `_e0.._ek`; a repeated cut is NULL."""
    wide = quantiles.groupBy("feature").pivot("prob", probabilities).agg(F.first("value"))
    cuts = [F.col(f"`{p}`") for p in probabilities]
    kept = [cuts[0]] + [
        F.when(here != before, here) for before, here in zip(cuts, cuts[1:])
    ]
    return wide.select("feature", *[c.alias(f"_e{i}") for i, c in enumerate(kept)])


def cuts_passed(value: Column, n: int, inclusive: bool) -> Column:
    """Number of cut points below the value (or at it, when inclusive)."""
    passed = F.lit(0)
    for i in range(n):
        beyond = value >= F.col(f"_e{i}") if inclusive else value > F.col(f"_e{i}")
        passed = passed + F.coalesce(beyond.cast("int"), F.lit(0))
    return passed
