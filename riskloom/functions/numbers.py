"""Rounding, seeded per-row randomness and reshaping helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def half_up(column: Column, digits: int) -> Column:
    """Round half up through FLOOR, which is stable across SQL engines."""
    scale = F.lit(float(10**digits))
    return F.floor(column.cast("double") * scale + F.lit(0.5)).cast("double") / scale


def micro(column: Column) -> Column:
    return half_up(column, 6)


def uniform(seed: int, *parts: Column) -> Column:
    """Uniform number in (0, 1) that depends only on the row's own values, so a
    recomputed task gives the same row again."""
    mixed = F.xxhash64(F.lit(seed), *parts)
    return (F.pmod(mixed, F.lit(1 << 40)).cast("double") + F.lit(0.5)) / F.lit(float(1 << 40))


def to_long(df: DataFrame, columns: list[str], keep: list[str] | None = None,
            name: str = "feature", value: str = "value", kind: str = "double") -> DataFrame:
    """One row per (kept columns, column name, value)."""
    keep = keep or []
    narrow = df.selectExpr(*[f"`{k}`" for k in keep],
                           *[f"CAST(`{c}` AS {kind}) AS `{c}`" for c in columns])
    return narrow.unpivot(keep, columns, name, value)


def metric_rows(one_row: DataFrame, layout: list[tuple[tuple[str, ...], str]],
                names: list[str], value: str = "value") -> DataFrame:
    """Turn a single wide row of aggregates into long rows.

    `layout` pairs the label values of a row with the wide column that holds it.
    """
    rows = ", ".join(
        "named_struct(" + ", ".join(f"'{n}', '{v}'" for n, v in zip(names, labels))
        + f", '{value}', CAST(`{column}` AS DOUBLE))"
        for labels, column in layout
    )
    return one_row.selectExpr(f"inline(array({rows}))")
