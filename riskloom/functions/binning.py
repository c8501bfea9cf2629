"""Right-closed bins `(low, high]` as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.schema import RISK_BANDS

# The bin edges the reports use.
CALIBRATION_EDGES = [0.0, 0.05, 0.10, 0.20, 0.40, 1.0]
FAIRNESS_AGE_EDGES = [20, 30, 40, 50, 60, 80]
AGE_EDGES = [20, 25, 30, 35, 40, 45, 50, 55, 60, 80]
UTILIZATION_EDGES = [-2.0, 0.0, 0.2, 0.4, 0.6, 0.8, 1.0, 3.0]


def interval_labels(edges: list[float], include_lowest: bool = False) -> list[str]:
    """Labels such as `(0.05, 0.1]`; a closed lowest edge shows as `(-0.001, ...`."""
    shown = list(edges)
    if include_lowest:
        shown[0] = round(shown[0] - 0.001, 3)
    return [f"({a}, {b}]" for a, b in zip(shown, shown[1:])]


def _choose(column: Column, edges: list, results: list, include_lowest: bool) -> Column:
    chosen = None
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        above = column >= low if include_lowest and i == 0 else column > low
        condition = above & (column <= high)
        result = F.lit(results[i])
        chosen = F.when(condition, result) if chosen is None else chosen.when(condition, result)
    return chosen


def bin_label(column: Column, edges: list, labels: list[str] | None = None,
              include_lowest: bool = False) -> Column:
    """Label of the bin that holds the value, NULL outside all bins."""
    return _choose(column, edges, labels or interval_labels(edges, include_lowest), include_lowest)


def bin_number(column: Column, edges: list, include_lowest: bool = False) -> Column:
    """Position 1..k of the bin, for ordering."""
    return _choose(column, edges, list(range(1, len(edges))), include_lowest)


def risk_edges(thresholds: dict[str, float]) -> list[float]:
    return [0.0, thresholds["low_max"], thresholds["moderate_max"], thresholds["high_max"], 1.0]


def risk_band(column: Column, thresholds: dict[str, float]) -> Column:
    return bin_label(column, risk_edges(thresholds), RISK_BANDS, include_lowest=True)


def left_closed_age(column: Column) -> Column:
    """Reporting bands of the portfolio query, closed on the left."""
    return (
        F.when(column < 25, "<25").when(column < 35, "25-34")
        .when(column < 45, "35-44").when(column < 55, "45-54").otherwise("55+")
    )
