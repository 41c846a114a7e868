"""Tail probabilities for small result tables: one row per tested column, never per data row."""
from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10_000):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            h *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return h


def regularised_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def t_tail(t: float, dof: float) -> float:
    """Two-sided tail of Student's t."""
    if t is None or dof is None or math.isnan(t) or math.isnan(dof) or dof <= 0:
        return math.nan
    if math.isinf(t):
        return 0.0
    return regularised_beta(dof / 2.0, 0.5, dof / (dof + t * t))


@F.pandas_udf(T.DoubleType())
def _t_two_sided(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([t_tail(a, b) for a, b in zip(t, dof)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def _normal_two_sided(z: pd.Series) -> pd.Series:
    return z.map(lambda v: math.erfc(abs(v) / math.sqrt(2.0)))


def t_two_sided(t: Column, dof: Column) -> Column:
    return F.nanvl(_t_two_sided(t.cast("double"), dof.cast("double")), F.lit(None))


def normal_two_sided(z: Column) -> Column:
    return F.nanvl(_normal_two_sided(z.cast("double")), F.lit(None))


def chi2_1dof(x: Column) -> Column:
    """Upper tail of chi-squared with one degree of freedom."""
    return normal_two_sided(F.sqrt(x))


def kolmogorov(lam: Column) -> Column:
    """Upper tail of the Kolmogorov distribution; tends to 1 as ``lam`` tends to 0."""
    terms = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
                        lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0)
                        * F.exp(-2.0 * k * k * lam * lam))
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * terms)))
