"""Column helpers: null-safe arithmetic and the closed-form statistics built-ins lack."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(c: Column) -> Column:
    """NaN and the infinities as null, so that they take part in no statistic."""
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None)).otherwise(c)


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is zero (ANSI mode would raise)."""
    return F.try_divide(a, b)


def clip(c: Column, low, high) -> Column:
    """Bound a column; a null stays null, and a null bound does not bind."""
    low = low if isinstance(low, Column) else F.lit(float(low))
    high = high if isinstance(high, Column) else F.lit(float(high))
    return F.when(c < low, low).when(c > high, high).otherwise(c)


def pearson(a: Column, b: Column) -> Column:
    """Pearson correlation; null, not an error, where either side does not vary."""
    spread = F.stddev_pop(F.when(b.isNotNull(), a)) * F.stddev_pop(F.when(a.isNotNull(), b))
    return ratio(F.covar_pop(a, b), spread)


def correlation_t(r2: Column, n: Column) -> Column:
    """t statistic of a simple regression, without its sign; null for a perfect fit or n < 3."""
    return F.when(n > 2, F.sqrt(ratio(r2 * (n - 2), 1 - r2)))


def student_t_tail(t: Column, dof: Column) -> Column:
    """Two-sided tail probability of Student's t for whole degrees of freedom.

    Uses the finite series of Abramowitz & Stegun 26.7.3 (odd) and 26.7.4 (even), so it stays an
    expression. Absolute accuracy is about 1e-15; a perfect fit has a null t and is given p = 0 by
    the caller.
    """
    theta = F.atan(t / F.sqrt(dof))
    cos2 = F.pow(F.cos(theta), F.lit(2))
    odd = dof % 2 == 1
    terms = F.when(odd, F.floor((dof - 1) / 2)).otherwise(F.floor(dof / 2)).cast("int")
    # Odd: term_j = term_{j-1} * 2j/(2j+1) * cos^2, term_0 = cos. Even: * (2j-1)/(2j), term_0 = 1.
    start = F.when(odd, F.cos(theta)).otherwise(F.lit(1.0))

    def step(acc, j):
        factor = F.when(odd, (2.0 * j) / (2.0 * j + 1.0)).otherwise((2.0 * j - 1.0) / (2.0 * j))
        term = acc["term"] * factor * cos2
        return F.struct((acc["total"] + term).alias("total"), term.alias("term"))

    zero_terms = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("term"))
    first = F.struct(start.alias("total"), start.alias("term"))
    series = F.when(
        terms > 0,
        F.aggregate(
            F.when(terms > 1, F.sequence(F.lit(1), terms - 1)).otherwise(F.array().cast("array<int>")),
            first,
            step,
            lambda acc: acc["total"],
        ),
    ).otherwise(zero_terms["total"])
    inside = F.when(odd, (2.0 / math.pi) * (theta + F.sin(theta) * series)).otherwise(F.sin(theta) * series)
    return F.when(dof >= 1, F.greatest(F.lit(0.0), 1.0 - inside))


def omnibus_k2(n: Column, skew: Column, excess_kurtosis: Column) -> Column:
    """D'Agostino-Pearson K^2 from the sample size and the population moments; null below 8 values."""
    n = n.cast("double")
    y = skew * F.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    beta = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2.0 * (beta - 1)) - 1
    delta = 1.0 / F.sqrt(0.5 * F.log(w2))
    alpha = F.sqrt(2.0 / (w2 - 1))
    z_skew = delta * F.asinh(y / alpha)

    mean = 3.0 * (n - 1) / (n + 1)
    var = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (excess_kurtosis + 3.0 - mean) / F.sqrt(var)
    s = (
        6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9))
        * F.sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    )
    a = 6.0 + 8.0 / s * (2.0 / s + F.sqrt(1.0 + 4.0 / (s * s)))
    d = 1.0 + x * F.sqrt(2.0 / (a - 4.0))
    root = F.cbrt(F.try_divide(1.0 - 2.0 / a, F.abs(d)))
    z_kurt = (1.0 - 2.0 / (9.0 * a) - F.signum(d) * root) / F.sqrt(2.0 / (9.0 * a))
    return F.when(n >= 8, z_skew * z_skew + z_kurt * z_kurt)


def chi2_two_tail(k2: Column) -> Column:
    """Upper tail of a chi-square with two degrees of freedom."""
    return F.exp(-k2 / 2.0)
