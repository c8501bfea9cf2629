"""Arithmetic over a fixed list of columns of one row, as SQL expressions.

Everything is plain arithmetic on columns, which compiles with the scan; array
lambdas would not. Expressions are text so that a wide projection is parsed once
instead of being assembled operator by operator.
"""

from __future__ import annotations


def total(terms: list[str]) -> str:
    return "(" + " + ".join(terms) + ")"


def number(value: float) -> str:
    """Double literal."""
    return f"{float(value)!r}D" if value >= 0 else f"({float(value)!r}D)"


def row_mean(names: list[str]) -> str:
    return f"{total(names)} / {number(len(names))}"


def row_max(names: list[str]) -> str:
    return f"greatest({', '.join(names)})"


def row_min(names: list[str]) -> str:
    return f"least({', '.join(names)})"


def population_std(names: list[str], mean: str) -> str:
    """Two-pass deviation (divisor n) around the already computed column `mean`."""
    squares = [f"(({n} - {mean}) * ({n} - {mean}))" for n in names]
    return f"sqrt({total(squares)} / {number(len(names))})"


def constant(names: list[str]) -> str:
    return f"{row_max(names)} = {row_min(names)}"


def slope(old_to_new: list[str]) -> str:
    """Least-squares slope against 0..n-1; exactly 0 for a constant series."""
    n = len(old_to_new)
    centre = (n - 1) / 2.0
    spread = sum((i - centre) ** 2 for i in range(n))
    fitted = total([f"{number(i - centre)} * {c}" for i, c in enumerate(old_to_new)])
    return f"CASE WHEN {constant(old_to_new)} THEN 0D ELSE {fitted} / {number(spread)} END"


def present(name: str) -> str:
    return f"CAST({name} IS NOT NULL AS DOUBLE)"


def or_zero(name: str) -> str:
    return f"coalesce({name}, 0D)"


def mean_of_present(names: list[str]) -> str:
    """Mean of the non-NULL values, NULL when there is none."""
    return f"try_divide({total([or_zero(n) for n in names])}, {total([present(n) for n in names])})"


def slope_of_present(old_to_new: list[str]) -> str:
    """Slope over the non-NULL values re-indexed 0..k-1; NULL when fewer than two."""
    here = [present(c) for c in old_to_new]
    position = ["0D"] + [total(here[:i]) for i in range(1, len(here))]
    k = total(here)
    sum_x = total([f"{p} * {h}" for p, h in zip(position, here)])
    sum_xx = total([f"{p} * {p} * {h}" for p, h in zip(position, here)])
    sum_xy = total([f"{p} * {or_zero(c)}" for p, c in zip(position, old_to_new)])
    sum_y = total([or_zero(c) for c in old_to_new])
    fitted = f"try_divide({k} * {sum_xy} - {sum_x} * {sum_y}, {k} * {sum_xx} - {sum_x} * {sum_x})"
    return f"CASE WHEN {k} < 2 THEN NULL WHEN {constant(old_to_new)} THEN 0D ELSE {fitted} END"


def clip(expression: str, low: float | None = None, high: float | None = None) -> str:
    """Clip that keeps NULL: `greatest` and `least` alone would skip it."""
    bounded = expression
    if high is not None:
        bounded = f"least({bounded}, {number(high)})"
    if low is not None:
        bounded = f"greatest({bounded}, {number(low)})"
    return f"CASE WHEN {expression} IS NOT NULL THEN {bounded} END"
