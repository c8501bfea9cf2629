"""The 39 behavioural columns, in three projections.

Each projection refers only to columns of the one before, so shared values
(monthly ratios, row means) are computed once and the plan stays small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskloom.functions import rowwise as R
from riskloom.schema import BILLS, COVERAGE, PAYMENTS, STATUS, UTILIZATION


def _of_limit(name: str) -> str:
    return f"try_divide({name}, LIMIT_BAL)"


def _coverage(payment: str, prior_bill: str) -> str:
    """Payment over the bill it was due against; undefined unless that bill is positive."""
    capped = f"least(try_divide({payment}, {prior_bill}), 5D)"
    return f"CASE WHEN {prior_bill} > 0 AND {payment} IS NOT NULL THEN {capped} END"


def monthly_ratios() -> dict[str, str]:
    ratios = {name: R.clip(_of_limit(bill), -2, 3) for name, bill in zip(UTILIZATION, BILLS)}
    ratios |= {name: _coverage(PAYMENTS[i], BILLS[i + 1]) for i, name in enumerate(COVERAGE)}
    return ratios


def delinquency() -> dict[str, str]:
    months = R.total([f"CAST({c} > 0 AS INT)" for c in STATUS])
    worst = R.row_max(STATUS)
    severity = R.total([f"greatest({c}, 0)" for c in STATUS])
    return {
        "N_MONTHS_DELINQUENT": months,
        "MAX_DELINQUENCY": f"greatest({worst}, 0)",
        "AVG_DELINQUENCY_SEVERITY": f"{severity} / {R.number(len(STATUS))}",
        "RECENT_DELINQUENCY": f"CAST({STATUS[0]} > 0 AS INT)",
        "SEVERE_DELINQUENCY_FLAG": f"CAST({worst} >= 3 AS INT)",
        "PERSISTENT_DELINQUENCY_FLAG": f"CAST({months} >= 3 AS INT)",
    }


def _series(prefix: str, newest_first: list[str]) -> dict[str, str]:
    return {
        f"{prefix}_AVG": R.row_mean(newest_first),
        f"{prefix}_LATEST": newest_first[0],
        f"{prefix}_MAX": R.row_max(newest_first),
        f"{prefix}_TREND": R.slope(newest_first[::-1]),
    }


def levels() -> dict[str, str]:
    utilization = _series("UTIL", UTILIZATION) | {"UTIL_MIN": R.row_min(UTILIZATION)}
    coverage = {
        "PAYCOV_AVG": R.mean_of_present(COVERAGE),
        "PAYCOV_LATEST": COVERAGE[0],
        "PAYCOV_TREND": R.slope_of_present(COVERAGE[::-1]),
    }
    exposure = {
        "BALANCE_TO_LIMIT_LATEST": UTILIZATION[0],
        "PAYMENT_CAPACITY": R.clip(_of_limit(PAYMENTS[0]), 0, 2),
        "UTILIZATION_STRESS_FLAG": f"CAST({UTILIZATION[0]} > 0.8D AND {STATUS[0]} > 0 AS INT)",
    }
    return (utilization | coverage | delinquency()
            | _series("BILL", BILLS) | _series("PAYAMT", PAYMENTS) | exposure)


def volatility() -> dict[str, str]:
    return {
        "UTIL_VOLATILITY": R.population_std(UTILIZATION, "UTIL_AVG"),
        "BILL_VOLATILITY": R.population_std(BILLS, "BILL_AVG"),
        "PAYAMT_VOLATILITY": R.population_std(PAYMENTS, "PAYAMT_AVG"),
    }


def engineer_features(df: DataFrame) -> DataFrame:
    """Cleaned accounts plus 39 columns; the input may be a stream."""
    for stage in (monthly_ratios(), levels(), volatility()):
        df = df.selectExpr("*", *[f"{expression} AS {name}" for name, expression in stage.items()])
    return df
