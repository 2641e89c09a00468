"""Student-t p-values for the few rows of an aggregated result."""

import math

import pandas as pd
from pyspark.sql import Column, functions as F, types as T


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, evaluated by Lentz's method."""
    tiny = 1e-300
    c, d = 1.0, 1.0 / ((1.0 - (a + b) * x / (a + 1.0)) or tiny)
    value = d
    for m in range(1, 10_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for step in (even, odd):
            d = 1.0 / ((1.0 + step * d) or tiny)
            c = (1.0 + step / c) or tiny
            value *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return value


def two_sided_p(t: float | None, dof: float | None) -> float | None:
    """P(|T| >= |t|) for `dof` degrees of freedom, accurate far into the tail."""
    if t is None or dof is None or math.isnan(t) or math.isnan(dof) or dof <= 0:
        return None
    if math.isinf(t):
        return 0.0
    a, b, x = dof / 2.0, 0.5, dof / (dof + t * t)
    if x >= 1.0:
        return 1.0
    front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(front + math.log(_beta_fraction(a, b, x)) - math.log(a))
    return 1.0 - math.exp(front) * _beta_fraction(b, a, 1.0 - x) / b


@F.pandas_udf(T.DoubleType())
def _p_udf(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([two_sided_p(a, b) for a, b in zip(t, dof)], dtype="float64")


def t_pvalue(t: Column, dof: Column) -> Column:
    """Two-sided p-value column; meant for result rows, never for data rows."""
    return _p_udf(t.cast("double"), dof.cast("double"))
