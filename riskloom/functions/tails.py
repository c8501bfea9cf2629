"""Tail probabilities as Spark expressions.

Spark SQL has no distribution functions. These are the continued fractions of the incomplete
gamma and beta functions, folded over a fixed number of steps inside the engine: no Python
worker. Beyond convergence a step multiplies by one, so the number of steps is only a bound.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STEPS = 400
# The first terms of Stirling's series, B(2k) / (2k (2k - 1)).
_STIRLING = [1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360]
_SHIFT = 10
_TINY = 1e-300


def log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x > 0: Stirling's series ten steps up, and the way down by the recurrence."""
    up = x + float(_SHIFT)
    series = F.lit(0.0)
    for k, factor in enumerate(_STIRLING):
        series = series + F.lit(factor) / F.pow(up, F.lit(2.0 * k + 1))
    down = F.lit(0.0)
    for i in range(_SHIFT):
        down = down + F.log(x + float(i))
    return (up - 0.5) * F.log(up) - up + 0.918938533204672742 + series - down


def _state(**parts: Column) -> Column:
    return F.struct(*[v.alias(k) for k, v in parts.items()])


def _away_from_zero(x: Column) -> Column:
    return F.when(F.abs(x) < _TINY, F.lit(_TINY)).otherwise(x)


def chi_square_tail(statistic: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution; NULL without degrees of freedom."""
    a, z = dof.cast("double") / 2.0, statistic.cast("double") / 2.0
    front = F.exp(-z + a * F.log(z) - log_gamma(a))
    # below a + 1: the series of the lower tail
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(STEPS)), _state(term=1.0 / a, total=1.0 / a),
        lambda s, i: _state(term=s["term"] * z / (a + i), total=s["total"] + s["term"] * z / (a + i)),
        lambda s: s["total"])

    # above it: the continued fraction of the upper tail
    def step(s: Column, i: Column) -> Column:
        weight = -i * (i - a)
        b = s["b"] + 2.0
        d = 1.0 / _away_from_zero(weight * s["d"] + b)
        c = _away_from_zero(b + weight / s["c"])
        return _state(b=b, c=c, d=d, result=s["result"] * d * c)

    b = z + 1.0 - a
    first = 1.0 / _away_from_zero(b)
    fraction = F.aggregate(
        F.sequence(F.lit(1), F.lit(STEPS)), _state(b=b, c=F.lit(1.0 / _TINY), d=first, result=first), step, lambda s: s["result"])
    return (F.when(dof > 0, F.when(z <= 0, F.lit(1.0)).when(z < a + 1.0, F.greatest(F.lit(0.0), 1.0 - series * front))
                   .otherwise(front * fraction)))


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """I_x(a, b) for x below (a + 1) / (a + b + 2)."""
    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log1p(-x)) / a

    def half(s: Column, weight: Column) -> Column:
        d = 1.0 / _away_from_zero(1.0 + weight * s["d"])
        c = _away_from_zero(1.0 + weight / s["c"])
        return _state(c=c, d=d, result=s["result"] * d * c)

    # The two kinds of steps take turns: step i is the even one of pair i / 2, or the odd one.
    def step(s: Column, i: Column) -> Column:
        m = F.floor(i / 2).cast("double")
        even = m * (b - m) * x / ((a + 2.0 * m - 1.0) * (a + 2.0 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2.0 * m) * (a + 2.0 * m + 1.0))
        return half(s, F.when(i % 2 == 0, even).otherwise(odd))

    first = 1.0 / _away_from_zero(1.0 - (a + b) * x / (a + 1.0))
    return front * F.aggregate(
        F.sequence(F.lit(2), F.lit(2 * STEPS)), _state(c=F.lit(1.0), d=first, result=first), step, lambda s: s["result"])


def student_two_sided(t: Column, dof: Column) -> Column:
    """Both tails of Student's t distribution; NULL without degrees of freedom."""
    t, dof = t.cast("double"), dof.cast("double")
    a, half = dof / 2.0, F.lit(0.5)
    x, rest = dof / (dof + t * t), t * t / (dof + t * t)
    near = x > (a + 1.0) / (a + 2.5)
    return F.when(dof > 0, F.when(t == 0, F.lit(1.0)).when(near, 1.0 - _beta_fraction(half, a, rest))
                  .otherwise(_beta_fraction(a, half, x)))
