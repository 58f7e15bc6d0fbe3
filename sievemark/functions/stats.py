"""Aggregate expressions that the built-ins do not give directly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dbl(c: Column) -> Column:
    return c.cast("double")


def stable_round(c: Column, places: int) -> Column:
    """Half-even rounding that does not depend on the order in which tasks were summed.

    The noise of a distributed sum is cut off first, or a value on a rounding edge would
    fall to either side from run to run.
    """
    return F.bround(F.round(c, 10), places)


def skew_adjusted(c: Column) -> Column:
    """Bias-corrected skewness: null under 3 values, 0 for a constant."""
    n = dbl(F.count(c))
    g1 = F.skewness(dbl(c))
    return (
        F.when(n < 3, None)
        .when(F.min(c) == F.max(c), F.lit(0.0))
        .otherwise(g1 * F.try_divide(F.sqrt(n * (n - 1)), n - 2))
    )


def kurt_adjusted(c: Column) -> Column:
    """Bias-corrected excess kurtosis: null under 4 values, 0 for a constant."""
    n = dbl(F.count(c))
    g2 = F.kurtosis(dbl(c))
    return (
        F.when(n < 4, None)
        .when(F.min(c) == F.max(c), F.lit(0.0))
        .otherwise(F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
    )


def coef_variation(c: Column) -> Column:
    """|std / mean| up to 100, null where the mean is almost zero."""
    mean = F.avg(dbl(c))
    return F.when(
        F.abs(mean) > 1e-10,
        F.least(F.abs(F.try_divide(F.stddev_samp(dbl(c)), mean)), F.lit(100.0)),
    )
