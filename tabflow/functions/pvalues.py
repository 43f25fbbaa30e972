"""Tail probabilities as column expressions, for the few result rows of a test."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SERIES_TERMS = 100
ERFC_TERMS = 200
ERFC_SWITCH = 30.0
SUMMED_FREEDOM = 2000  # degrees of freedom up to which the tail is summed term by term


def kolmogorov_tail(statistic: Column, n: Column, m: Column) -> Column:
    """Asymptotic p-value of the two-sample Kolmogorov-Smirnov statistic."""
    size = n.cast("double") * m / (n + m)
    square = size * statistic * statistic
    series = F.reduce(
        F.sequence(F.lit(1), F.lit(SERIES_TERMS)),
        F.lit(0.0),
        lambda total, k: total + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * square),
    )
    # the alternating series needs more terms as the argument nears 0, where the tail is 1
    return F.when(square < 0.01, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2.0 * series)))


def _erfc_root(y: Column) -> Column:
    """erfc(sqrt(y)) for y >= 0."""
    start = F.struct(F.lit(2.0 / math.sqrt(math.pi)).alias("term"), F.lit(0.0).alias("total"))
    series = F.reduce(
        F.sequence(F.lit(1), F.lit(ERFC_TERMS)),
        start,
        lambda a, k: F.struct((a["term"] * y / (k + 0.5)).alias("term"), (a["total"] + a["term"]).alias("total")),
        lambda a: a["total"],
    )
    small = 1.0 - F.exp(-y) * F.sqrt(y) * series
    large = F.exp(-y) / F.sqrt(math.pi * y) * (1.0 - 0.5 / y + 0.75 / (y * y) - 1.875 / (y * y * y))
    return F.when(y < ERFC_SWITCH, small).otherwise(large)


def _uniform_tail(y: Column, a: Column) -> Column:
    """Upper incomplete gamma ratio Q(a, y) for a large a: the uniform expansion to first order.

    Its error is of the order of a ** -1.5, whatever the statistic.
    """
    ratio = y / a
    distance = F.greatest(ratio - 1.0 - F.log(ratio), F.lit(0.0))
    half = _erfc_root(F.greatest(a * distance, F.lit(1e-12))) / 2.0
    eta = F.signum(ratio - 1.0) * F.sqrt(2.0 * distance)
    near = F.abs(ratio - 1.0) < 1e-4
    first = F.when(near, F.lit(-1.0 / 3.0)).otherwise(1.0 / (ratio - 1.0) - 1.0 / eta)
    return F.when(ratio >= 1.0, half).otherwise(1.0 - half) + F.exp(-a * distance) / F.sqrt(2.0 * math.pi * a) * first


def chi_square_tail(statistic: Column, freedom: Column) -> Column:
    """P(X > statistic) for a chi-square variable with whole degrees of freedom.

    Up to SUMMED_FREEDOM the closed finite sum: Poisson terms for even degrees, erfc plus half-integer
    terms for odd ones, carried as logarithms, so large statistics do not underflow. Beyond that
    the uniform expansion, so a column of very many categories makes no long array.
    """
    y = F.greatest(statistic, F.lit(1e-300)) / 2.0
    even = freedom % 2 == 0
    count = F.when(freedom <= SUMMED_FREEDOM, F.floor(freedom / 2.0)).otherwise(0).cast("int")
    # log of the first term: y^0/0! for even degrees, y^(1/2)/Gamma(3/2) for odd ones
    first = F.when(even, -y).otherwise(-y + 0.5 * F.log(y) - math.lgamma(1.5))
    half = F.when(even, F.lit(0.0)).otherwise(F.lit(0.5))
    begin = F.struct(first.alias("log"), F.lit(0.0).alias("total"))
    finite = F.reduce(
        F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>")),
        begin,
        lambda a, k: F.struct(
            (a["log"] + F.log(y) - F.log(k + half)).alias("log"), (a["total"] + F.exp(a["log"])).alias("total")
        ),
        lambda a: a["total"],
    )
    summed = F.when(even, finite).otherwise(_erfc_root(y) + finite)
    tail = F.when(freedom <= SUMMED_FREEDOM, summed).otherwise(_uniform_tail(y, freedom / 2.0))
    bounded = F.least(F.lit(1.0), F.greatest(F.lit(0.0), tail))
    return (
        F.when(freedom < 1, F.lit(1.0))
        .when(statistic <= 0, F.lit(1.0))
        .when(statistic == float("inf"), F.lit(0.0))
        .otherwise(bounded)
    )
