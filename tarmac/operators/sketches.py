"""Quantiles from KLL sketches that merge: the form for data whose distinct values are too many to rank.

``ranks.quantiles`` is exact and the default everywhere; it shuffles each distinct value once. Here a task
sends one sketch of bounded size per group. Stored per year, sketches give any union of years without a scan.
Which values a sketch keeps is drawn at random, so results may differ between runs, within ``rank_bound``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.session import materialise

# Items a sketch keeps per level; rank error about 0.14 %.
SIZE = 2048
# Published single-sided error of a KLL sketch of size k, met with 99 % confidence: 2.296 / k ** 0.9723.
_FACTOR, _POWER = 2.296, 0.9723


def rank_bound(size: int = SIZE) -> float:
    """The share of the rows that a quantile's rank may be off by."""
    return _FACTOR / size**_POWER


def _known(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Groups and finite values; nulls, NaN and infinities do not count."""
    number = F.col(value).cast("double")
    return df.select(*by, number.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v") & (F.abs("_v") < float("inf")))


def value_sketches(df: DataFrame, value: str, by: Sequence[str] = (), size: int = SIZE) -> DataFrame:
    """(by, n, sketch), a stored table: one sketch of the known values of each group; a null group is a group.

    A group without known values has no row. A value or group with most rows costs its tasks nothing more.
    """
    return materialise(_known(df, value, by).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("_v", F.lit(size)).alias("sketch")).filter("n > 0"))


def sketched_quantiles(stored: DataFrame, probabilities: Sequence[float], names: Sequence[str],
                       by: Sequence[str] = ()) -> DataFrame:
    """One row per group of ``by``, any of the stored groups or none of them, with values that occur in the data."""
    merged = stored.groupBy(*by).agg(F.sum("n").alias("_n"), F.kll_merge_agg_double("sketch").alias("_sketch")).filter("_n > 0")
    return merged.select(*by, *[F.kll_sketch_get_quantile_double("_sketch", F.lit(float(p))).alias(name)
                                for p, name in zip(probabilities, names)])


def quantiles(df: DataFrame, value: str, probabilities: Sequence[float], names: Sequence[str],
              by: Sequence[str] = (), size: int = SIZE) -> DataFrame:
    """``ranks.quantiles`` within ``rank_bound(size)``, for the operators that take either."""
    return sketched_quantiles(value_sketches(df, value, by, size), probabilities, names, by)


def rank_errors(df: DataFrame, value: str, found: DataFrame, probabilities: Sequence[float], names: Sequence[str],
                by: Sequence[str] = ()) -> DataFrame:
    """(by, n, names): how far each found quantile's rank is from the asked one, as a share of the group's rows.

    Zero if the asked rank falls among rows equal to the found value. ``found`` has one row per group.
    """
    by = list(by)
    asked = found.select(*[F.col(c).alias(f"_by_{c}") for c in by], *[F.col(x).alias(f"_q_{x}") for x in names])
    rows = _known(df, value, by)
    same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
    # Values are counted first, so that the join meets each distinct one once per group.
    counts = rows.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n"))
    joined = counts.join(asked, reduce(lambda a, b: a & b, same) if same else F.lit(True))
    shares = [F.sum("_n").alias("n")]
    for x in names:
        shares += [F.coalesce(F.sum(F.when(F.col("_v") < F.col(f"_q_{x}"), F.col("_n"))), F.lit(0)).alias(f"_below_{x}"),
                   F.coalesce(F.sum(F.when(F.col("_v") <= F.col(f"_q_{x}"), F.col("_n"))), F.lit(0)).alias(f"_upto_{x}")]
    total = joined.groupBy(*by).agg(*shares)
    return total.select(*by, "n", *[
        F.greatest(F.lit(0.0), F.col(f"_below_{x}") / F.col("n") - F.lit(float(p)), F.lit(float(p)) - F.col(f"_upto_{x}") / F.col("n")).alias(x)
        for p, x in zip(probabilities, names)])


def describe(df: DataFrame, columns: Sequence[str] | None = None, size: int = SIZE) -> DataFrame:
    """``quality.describe`` with quartiles from sketches: one scan, one partial row per column and task."""
    columns = list(columns or [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)])
    long = _known(df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column", "value"), "value", ["column"])
    summary = long.groupBy("column").agg(
        F.count(F.lit(1)).alias("count"), F.avg("_v").alias("mean"), F.stddev_samp("_v").alias("std"), F.min("_v").alias("min"),
        F.max("_v").alias("max"), F.kll_sketch_agg_double("_v", F.lit(size)).alias("_sketch"))
    return summary.select("column", "count", "mean", "std", "min", *[
        F.kll_sketch_get_quantile_double("_sketch", F.lit(p)).alias(q) for q, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))], "max")
