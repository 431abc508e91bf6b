"""Aggregate builders: (value, condition) -> Column.

All of them combine on the map side, so a heavy user costs one partial row per task.
Median, mean deviation and distinct count are not here: they go through value counts
(`operators.distribution`), which keeps a heavy user's group small.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pick(value: Column, cond: Column | None) -> Column:
    return value if cond is None else F.when(cond, value)


def count_of(value: Column, cond: Column | None = None) -> Column:
    return F.count(pick(value, cond))


def sum_of(value: Column, cond: Column | None = None) -> Column:
    return F.sum(pick(value, cond))


def mean_of(value: Column, cond: Column | None = None) -> Column:
    return F.avg(pick(value, cond))


def max_of(value: Column, cond: Column | None = None) -> Column:
    return F.max(pick(value, cond))


def min_of(value: Column, cond: Column | None = None) -> Column:
    return F.min(pick(value, cond))


def var_of(value: Column, cond: Column | None = None) -> Column:
    return F.var_samp(pick(value, cond))


def std_of(value: Column, cond: Column | None = None) -> Column:
    return F.stddev_samp(pick(value, cond))


def range_of(value: Column, cond: Column | None = None) -> Column:
    return max_of(value, cond) - min_of(value, cond)


def skew_of(value: Column, cond: Column | None = None) -> Column:
    """Bias-corrected skewness: NULL below 3 values, 0 for equal values."""
    x = pick(value, cond)
    n = F.count(x).cast("double")
    g1 = F.skewness(x)
    return (
        F.when(F.count(x) < 3, None)
        .when(F.max(x) == F.min(x), 0.0)
        .otherwise(F.try_divide(g1 * F.sqrt(n * (n - 1)), n - 2))
    )


def kurt_of(value: Column, cond: Column | None = None) -> Column:
    """Bias-corrected excess kurtosis: NULL below 4 values, 0 for equal values."""
    x = pick(value, cond)
    n = F.count(x).cast("double")
    g2 = F.kurtosis(x)
    return (
        F.when(F.count(x) < 4, None)
        .when(F.max(x) == F.min(x), 0.0)
        .otherwise(F.try_divide(((n + 1) * g2 + 6) * (n - 1), (n - 2) * (n - 3)))
    )


def skew_from_sums(n: Column, s2: Column, s3: Column, constant: Column) -> Column:
    """As `skew_of`, from sums of squared and cubed deviations from the mean."""
    n = n.cast("double")
    g1 = F.try_divide(F.sqrt(n) * s3, F.pow(s2, 1.5))
    return (
        F.when(n < 3, None)
        .when(constant, 0.0)
        .otherwise(F.try_divide(g1 * F.sqrt(n * (n - 1)), n - 2))
    )


def kurt_from_sums(n: Column, s2: Column, s4: Column, constant: Column) -> Column:
    """As `kurt_of`, from sums of second and fourth powers of deviations from the mean."""
    n = n.cast("double")
    g2 = F.try_divide(n * s4, s2 * s2) - 3
    return (
        F.when(n < 4, None)
        .when(constant, 0.0)
        .otherwise(F.try_divide(((n + 1) * g2 + 6) * (n - 1), (n - 2) * (n - 3)))
    )
