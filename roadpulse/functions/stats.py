"""Distribution functions as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Terms of the continued fraction; 200 give 1e-10 for any degrees of freedom up to 1e9.
TERMS = 200
#: Steps by which an argument is raised before the series for large ones is used.
RAISED = 30


def _gamma_ratio(a: Column) -> Column:
    """gamma(a + 1/2) / gamma(a), without the two factors, which overflow."""
    steps = F.sequence(F.lit(0), F.lit(RAISED - 1))
    z = a + RAISED
    # The series of the ratio in powers of 1/z.
    series = 1 - 1 / (8 * z) + 1 / (128 * z**2) + 5 / (1024 * z**3) - 21 / (32768 * z**4) - 399 / (262144 * z**5)
    return F.aggregate(steps, F.lit(1.0), lambda f, j: f * (a + j) / (a + j + 0.5)) * F.sqrt(z) * series


def _beta_fraction(x: Column, a: Column, b: Column) -> Column:
    """Denominator of the incomplete beta function's continued fraction, from the last term to the first."""

    def term(f: Column, k: Column) -> Column:
        m = F.shiftright(k, 1).cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return 1 + F.when(k % 2 == 0, even).otherwise(odd) / f

    return F.aggregate(F.sequence(F.lit(TERMS), F.lit(1), F.lit(-1)), F.lit(1.0), term)


def t_two_sided(t: Column | str, df: Column | str) -> Column:
    """Probability that Student's t with `df` degrees of freedom is at least |t| from zero; NULL without t or below one degree.

    It is the incomplete beta function at df / (df + t^2), taken from the side on which its fraction converges fast.
    """
    t, df = (F.col(c).cast("double") if isinstance(c, str) else c.cast("double") for c in (t, df))
    half = F.lit(0.5)
    a, square = df / 2, t * t
    x, y = df / (df + square), square / (df + square)
    tail = x < (a + 1) / (a + 2.5)
    front = F.exp(-a * F.log1p(square / df)) * F.sqrt(y) * _gamma_ratio(a) / math.sqrt(math.pi)
    fraction = _beta_fraction(F.when(tail, x).otherwise(y), F.when(tail, a).otherwise(half), F.when(tail, half).otherwise(a))
    p = F.when(tail, front / a / fraction).otherwise(1 - front / half / fraction)
    return F.when(df >= 1, p)
