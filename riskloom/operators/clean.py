"""Cleaning without deleting rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.schema import TARGET, TARGET_SPELLINGS


def find_target(df: DataFrame) -> str:
    """Name of the outcome column, whichever spelling the table uses."""
    for name in TARGET_SPELLINGS + [TARGET]:
        if name in df.columns:
            return name
    raise KeyError(f"no outcome column; expected one of {TARGET_SPELLINGS + [TARGET]}")


def fold_education(code: Column) -> Column:
    return F.when(code.isin(0, 5, 6), F.lit(4)).otherwise(code)


def fold_marriage(code: Column) -> Column:
    return F.when(code == 0, F.lit(3)).otherwise(code)


def clean_accounts(df: DataFrame) -> DataFrame:
    """Canonical outcome name, undocumented codes folded; the outcome may be absent."""
    for name in TARGET_SPELLINGS:
        if name in df.columns:
            df = df.withColumnRenamed(name, TARGET)
            break
    return df.withColumns({
        "EDUCATION": fold_education(F.col("EDUCATION")),
        "MARRIAGE": fold_marriage(F.col("MARRIAGE")),
    })
