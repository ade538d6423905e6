"""Distribution tails.

p-values are column expressions: the normal tail by a Chebyshev fit of ``erfc``, the chi-square tail by its
finite series. The plain functions beside them (``math.erfc``, ``lgamma``) are what tests compare them with.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def normal_two_sided_p(z: float) -> float:
    if z is None or (isinstance(z, float) and math.isnan(z)):
        return float("nan")
    return math.erfc(abs(z) / math.sqrt(2.0))


def chi2_sf(x: float, dof: int) -> float:
    """Upper tail of the chi-square distribution with integer ``dof``."""
    if x is None or dof is None or dof <= 0 or (isinstance(x, float) and math.isnan(x)):
        return float("nan")
    if x <= 0:
        return 1.0
    half = x / 2.0
    # even dof: exp(-x/2) * sum_{i < k/2} (x/2)^i / i!
    # odd dof: erfc(sqrt(x/2)) + exp(-x/2) * sum_{i=1}^{(k-1)/2} (x/2)^(i-1/2) / Gamma(i+1/2)
    # each term as its logarithm, so that neither large x nor large dof overflows
    first, tail = (0.0, 0.0) if dof % 2 == 0 else (0.5, math.erfc(math.sqrt(half)))
    logs = [(i + first) * math.log(half) - math.lgamma(i + first + 1) - half for i in range(dof // 2)]
    return min(1.0, tail + math.fsum(math.exp(v) for v in logs if v > -745))


# fixed values: coefficients of the rational Chebyshev fit of erfc (relative error below 1.2e-7 everywhere)
ERFC_FIT = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)


def erfc(x: Column) -> Column:
    """Complementary error function of a number >= 0."""
    t = 1.0 / (1.0 + 0.5 * x)
    power = F.lit(ERFC_FIT[-1])
    for c in reversed(ERFC_FIT[:-1]):
        power = power * t + F.lit(c)
    return t * F.exp(power - x * x)


def normal_p(z: Column) -> Column:
    """Two-sided p-value of a standard normal statistic; NULL for NULL or NaN."""
    z = F.when(~F.isnan(z), F.abs(z))
    return erfc(z / F.lit(math.sqrt(2.0)))


def chi2_p(x: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution with whole degrees of freedom: the finite series, term by term in logarithms;
    NULL for NULL, NaN or no degrees."""
    half, odd = F.when(x > 0, x / 2.0), dof % 2 == 1
    # the first term: half ** first / gamma(first + 1) * exp(-half), first being 0 or 1/2
    first = F.when(odd, 0.5 * F.log(half) - F.lit(math.lgamma(1.5))).otherwise(0.0) - half
    step = F.when(odd, 0.5).otherwise(0.0)
    zero = lambda v: v.cast("double")
    series = F.aggregate(
        F.when(dof >= 2, F.sequence(F.lit(1), F.floor(dof / 2).cast("int"))).otherwise(F.array().cast("array<int>")),
        F.struct(zero(F.lit(0.0)).alias("sum"), zero(first).alias("term")),
        lambda s, i: F.struct((s["sum"] + F.exp(s["term"])).alias("sum"), (s["term"] + F.log(half) - F.log(i + step)).alias("term")))["sum"]
    tail = F.when(odd, erfc(F.sqrt(half))).otherwise(0.0)
    return F.when((dof > 0) & x.isNotNull() & ~F.isnan(x), F.when(x <= 0, 1.0).otherwise(F.least(F.lit(1.0), tail + series)))
