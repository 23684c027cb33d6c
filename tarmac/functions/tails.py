"""Tail probabilities for test statistics, as column expressions over one-row or few-row results."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_STEPS = 100


def _steps(first: int, last: int) -> Column:
    return F.sequence(F.lit(first), F.lit(last), F.lit(1 if last >= first else -1))


def erfc(t: Column) -> Column:
    """Complementary error function of ``t >= 0``: a power series up to 2, a continued fraction beyond."""
    start = F.struct(t.alias("term"), t.alias("total"))

    def add(acc, k):
        term = acc["term"] * 2 * t * t / (2 * k + 1)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    front = F.exp(-t * t) / math.sqrt(math.pi)
    series = 1 - 2 * front * F.aggregate(_steps(1, _STEPS), start, add)["total"]
    fraction = front / F.aggregate(_steps(_STEPS, 1), t, lambda f, k: t + k / 2 / f)
    return F.when(t < 2, series).otherwise(fraction)


def chi2_tail(statistic: Column, dof: Column) -> Column:
    """Upper tail of chi-square with a whole number of degrees of freedom; NULL for none or an unknown statistic.

    The regularised incomplete gamma of a whole or half argument is a finite sum; its
    terms are followed by their logarithms, so neither ends of the range overflow.
    """
    z = statistic.cast("double") / 2
    half = F.floor(dof / 2).cast("int")
    odd = dof % 2 == 1
    # even: e^-z z^k / k! for k = 0 ..; odd: e^-z z^(k-1/2) / Gamma(k+1/2) for k = 1 .., after erfc
    offset = F.when(odd, F.lit(0.5)).otherwise(F.lit(0.0))
    first = F.when(odd, 0.5 * F.log(z) - z - math.lgamma(1.5)).otherwise(-z)
    start = F.struct(first.alias("log"), F.lit(0.0).cast("double").alias("total"))

    def add(acc, k):
        following = acc["log"] + F.log(z) - F.log(k + offset)
        return F.struct(following.alias("log"), (acc["total"] + F.exp(acc["log"])).alias("total"))

    counted = F.when(half > 0, F.sequence(F.lit(1), half)).otherwise(F.array().cast("array<int>"))
    total = F.aggregate(counted, start, add)["total"]
    tail = total + F.when(odd, erfc(F.sqrt(z))).otherwise(F.lit(0.0))
    known = statistic.isNotNull() & ~F.isnan(statistic.cast("double")) & (dof > 0)
    return F.when(known, F.when(z <= 0, F.lit(1.0)).otherwise(F.least(tail, F.lit(1.0))))


def two_sided_normal(z: Column) -> Column:
    return F.when(z.isNotNull() & ~F.isnan(z), erfc(F.abs(z) / math.sqrt(2)))
